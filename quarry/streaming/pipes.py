"""Run an external line-oriented program over each partition (stdin/stdout pipes).

Kept for jobs written as mapper/reducer scripts.  The lines go from Spark's executor to the
program and back (``SELECT TRANSFORM``), without Python workers.  Spark's native operators
(``quarry.operators.text.word_count``) do the same work without a process per partition and
should be preferred.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# characters that end a field and stand for null: none that a text line holds, so a line is one field
FIELD_END, NO_VALUE = "\\u0001", "\\u0001\\u0002"


def _literal(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def pipe_lines(df: DataFrame, command: str, line_col: str = "value") -> DataFrame:
    """Feed each partition's lines to ``command`` (run by bash) and return its output lines as ``value``.

    A null line goes in as an empty one.  A program that ends with another status than 0 fails the job."""
    spark = df.sparkSession
    view = f"piped_{uuid.uuid4().hex}"
    df.select(F.coalesce(F.col(line_col), F.lit("")).alias("value")).createOrReplaceTempView(view)
    rows = f"ROW FORMAT DELIMITED FIELDS TERMINATED BY '{FIELD_END}' LINES TERMINATED BY '\\n' NULL DEFINED AS '{NO_VALUE}'"
    try:
        return spark.sql(f"SELECT TRANSFORM(value) {rows} USING {_literal(command)} AS (value STRING) {rows} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def pipe_map_reduce(df: DataFrame, mapper: str, reducer: str, line_col: str = "value",
                    combiner: str | None = None) -> DataFrame:
    """Mapper -> (optional combiner per partition) -> shuffle on the key before the first TAB
    with sorting -> reducer, like a streaming job.  Output: ``key``, ``value`` columns.

    A combiner gets its partition's lines sorted by key, as the reducer does: with one, a key
    that a third of all lines hold is one line a partition in the shuffle."""
    mapped = pipe_lines(df, mapper, line_col)
    key = F.substring_index("value", "\t", 1)
    if combiner:
        mapped = pipe_lines(mapped.sortWithinPartitions(key), combiner)
    reduced = pipe_lines(mapped.repartition(key).sortWithinPartitions(key), reducer)
    parts = F.split(F.col("value"), "\t", 2)
    return reduced.select(parts[0].alias("key"), F.try_element_at(parts, F.lit(2)).alias("value"))
