"""Secondary sort and per-group first row.

The reference sorts composite keys so that a reducer sees each group in a
chosen order.  Spark expresses the two uses directly: the ordered layout
(hash partition on the group key, sort inside partitions) and the first row
of each group (``row_number() = 1``, which Spark plans as a
``WindowGroupLimit`` applied before the exchange, so a hot group is cut to
one row per map partition before it is shuffled).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def secondary_sorted(df: DataFrame, group_cols: list[str], order: list[Column | str],
                     partitions: int | None = None) -> DataFrame:
    """W1-W3 + O5: rows of a group in one partition, sorted by (group key, order)."""
    d = df.repartition(partitions, *group_cols) if partitions else df.repartition(*group_cols)
    return d.sortWithinPartitions(*group_cols, *order)


def first_in_group(df: DataFrame, group_cols: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group under ``order``."""
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
