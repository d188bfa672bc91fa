"""Joins of a large side with many rows a key to a side with one row a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_PARTITION = 4_000_000  # a key with more rows is spread where the planner can't split it


def salts_per_key(big: DataFrame, key: str, rows_per_partition: int) -> DataFrame:
    """(key, _salts): keys of more than ``rows_per_partition`` rows and the parts each is dealt into.

    Each such key fills a partition of its own, so there are fewer of them than
    ``rows / rows_per_partition``; counting is an aggregate with a map-side part.
    """
    n = big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows_per_partition)
    return n.select(key, F.ceil(F.col("_n") / rows_per_partition).cast("int").alias("_salts"))


def skew_safe_join(big: DataFrame, small: DataFrame, key: str, how: str = "left", salted: bool | None = None,
                   rows_per_partition: int = ROWS_PER_PARTITION) -> DataFrame:
    """Equi-join ``big`` (many rows per key) to ``small`` (one row per key).

    With adaptive execution the plain join is enough: the planner sees the size of each side
    when it is shuffled, broadcasts a small one and splits a key that fills a partition, and
    nothing is read twice to measure it.  Where that is off (or ``salted``), rows of keys with
    more than ``rows_per_partition`` rows get a salt and the matching ``small`` rows are copied
    once per salt; other keys keep salt 0.
    """
    conf = big.sparkSession.conf
    adaptive = all(conf.get(k, "true") == "true" for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"))
    if salted is False or (salted is None and adaptive):
        return big.join(small, key, how)
    hot = salts_per_key(big, key, rows_per_partition)
    b = (big.join(hot, key, "left")
         .withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts"))
    s = (small.join(hot, key, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts"))
    return b.join(s, [key, "_salt"], how).drop("_salt")
