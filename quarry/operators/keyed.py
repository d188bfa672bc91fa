"""Keyed (wide) table operations: point read, upsert, cell delete, first row per key.

A keyed table is a DataFrame with a unique ``row_key`` and nullable columns
(an absent cell is NULL).  Updates never mutate files: the merge produces the
next version, which a sink writes to a new directory and publishes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PUT, DELETE = "put", "delete"


def point_read(table: DataFrame, key, key_col: str = "row_key") -> DataFrame:
    """The row with this key (Parquet min/max statistics skip other row groups)."""
    return table.filter(F.col(key_col) == F.lit(key))


def latest_change(changes: DataFrame, key_col: str = "row_key", ts_col: str = "ts") -> DataFrame:
    """Several changes for one key: the latest by ``ts_col`` wins (as with versioned cells)."""
    c = changes.groupBy(key_col).agg(F.max_by(F.struct("op", "value"), F.col(ts_col)).alias("c"))
    return c.select(key_col, "c.op", "c.value")


def merge_cells(base: DataFrame, changes: DataFrame, column: str, key_col: str = "row_key") -> DataFrame:
    """K3 + K4: apply (key, op, value) to one column of a keyed table.

    ``put`` sets the cell (creating the row when the key is new), ``delete``
    clears it and never creates a row; keys without a change keep their row.
    Several changes for one key: the latest by ``ts`` counts if ``changes`` has
    that column; without it equal ones count once, and the job fails if they differ.
    One full outer sort-merge join; the changes are one row a key there, and every
    row of a key that ``base`` repeats gets its change.
    """
    if "ts" in changes.columns:
        one = latest_change(changes, key_col)
    else:
        cell = F.struct("op", "value")
        one = changes.groupBy(key_col).agg(F.min(cell).alias("c"), F.max(cell).alias("_other"))
        one = one.select(key_col, F.when(F.col("c") != F.col("_other"), F.raise_error(F.concat(
            F.lit("several changes without ts for key "), F.col(key_col).cast("string"))))
            .otherwise(F.col("c.op")).alias("op"), "c.value")
    ch = one.select(F.col(key_col), F.col("op").alias("_op"), F.col("value").alias("_new"))
    j = (base.withColumn("_there", F.lit(True)).join(ch, key_col, "full_outer")
         .filter(F.col("_there") | (F.col("_op") == PUT)))
    new = (F.when(F.col("_op") == PUT, F.col("_new"))
           .when(F.col("_op") == DELETE, F.lit(None))
           .otherwise(F.col(column)))
    others = [c for c in base.columns if c not in (key_col, column)]
    return j.select(key_col, *others, new.cast(base.schema[column].dataType).alias(column))


def first_per_key(df: DataFrame, key_col: str, value_col: str, order_col: str | None = None) -> DataFrame:
    """A15 (D6): one value per key, the first by ``order_col`` or else the smallest -> (key, value).

    ``min_by``/``min`` aggregate partially before the shuffle.
    """
    agg = F.min_by(value_col, order_col) if order_col else F.min(value_col)
    return df.groupBy(key_col).agg(agg.alias(value_col))


def upsert_rows(base: DataFrame, rows: DataFrame, key_col: str = "row_key") -> DataFrame:
    """K3 for whole rows: put every non-NULL cell of ``rows``, keep the other cells, insert
    new keys.  Columns missing from ``rows`` are kept as they are.  Several rows for one key
    fail the job: nothing says which counts."""
    new_cols = [c for c in rows.columns if c != key_col]
    r = rows.groupBy(key_col).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(f"_new_{c}") for c in new_cols])
    guard = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("several rows for key "), F.col(key_col).cast("string"))))
    r = r.select(guard.otherwise(F.col(key_col)).alias(key_col), *[f"_new_{c}" for c in new_cols])
    j = base.join(r, key_col, "full_outer")
    out = []
    for c in base.columns:
        if c == key_col:
            continue
        if c in new_cols:
            out.append(F.coalesce(F.col(f"_new_{c}"), F.col(c)).cast(base.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return j.select(key_col, *out)
