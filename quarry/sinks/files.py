"""Sinks (K1-K11) and writers for the custom layouts read by ``quarry.sources``.

Binary layouts are written through the formats that read them, in two phases: see
``quarry.sinks.binary``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sinks.keyed_table import read_current, write_version  # noqa: F401  (K3, K5)


def _write_binary(df: DataFrame, register, fmt: str, out_dir: str, mode: str, **options) -> dict:
    """Write through a registered format; the totals of the write (rows, bytes, files)."""
    from quarry.session import scratch_path
    from quarry.sinks.binary import written

    register(df.sparkSession)
    report = scratch_path(df.sparkSession, "written")
    df.write.format(fmt).mode(mode).option("path", out_dir).option("report", report).options(**options).save()
    return written(report)


def write_fixed_records(df: DataFrame, col: str, out_dir: str, record_bytes: int, mode: str = "overwrite") -> dict:
    """Concatenate equal-length binary records, one file per partition (input of S4)."""
    from quarry.sources.fixed_records import register

    return _write_binary(df.select(F.col(col).cast("binary").alias("record")), register, "quarry_fixed_records",
                         out_dir, mode, record_bytes=str(record_bytes))


def write_indexed_chunks(df: DataFrame, text_col: str, out_dir: str, level: int = 6, mode: str = "overwrite") -> dict:
    """One zlib chunk per row plus the int32 size index (input of S5)."""
    from quarry.sources.indexed_chunks import register

    return _write_binary(df.select(F.col(text_col).alias("text")), register, "quarry_indexed_chunks", out_dir, mode,
                         level=str(level))


def write_docstream(df: DataFrame, out_dir: str, url_col: str = "url", body_col: str | None = "body",
                    text_col: str | None = "text", compress: bool = False, mode: str = "overwrite") -> dict:
    """Length-prefixed ``document`` messages, plain (with an index of starts) or gzip (input of S10)."""
    from quarry.sources.docstream import register

    none = F.lit(None).cast("string")
    cols = [(F.col(c) if c else none).alias(n) for c, n in ((url_col, "url"), (body_col, "body"), (text_col, "text"))]
    return _write_binary(df.select(*cols), register, "quarry_docstream", out_dir, mode,
                         compress="true" if compress else "false")


# ---------------------------------------------------------------- text sinks

def tsv_line(*cols) -> Column:
    """K1: ``key<TAB>value...``."""
    return F.concat_ws("\t", *[F.col(c) if isinstance(c, str) else c for c in cols])


def write_tsv(df: DataFrame, path: str, *cols, compression: str | None = None) -> None:
    """K1 + K10: TSV text part files, replacing the output directory."""
    w = df.select(tsv_line(*(cols or df.columns)).alias("value")).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_sorted(df: DataFrame, path: str, *order, partitions: int | None = None) -> None:
    """K2 + O3: output globally ordered across part files (range partitioned, sorted inside).

    ``partitions=1`` gives the single ordered file of the reference; any
    larger number keeps the order when the part files are read in name order.
    """
    cols = list(order) or df.columns
    d = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    d.sortWithinPartitions(*cols).write.mode("overwrite").parquet(path)


def base64_lines(col) -> Column:
    """K6: base64 text of a binary column (one line per record)."""
    from quarry.functions.codec import base64_text

    return base64_text(F.col(col) if isinstance(col, str) else col)


def url_base64_line(url_col: str, text_col: str) -> Column:
    """``url<TAB>base64(utf8(text))``; apply to rows with text only."""
    from quarry.functions.codec import base64_text

    return F.concat_ws("\t", F.col(url_col), base64_text(F.encode(F.col(text_col), "UTF-8")))


def tuple_line(first, second) -> Column:
    """K8: ``(first,second)`` as the RDD text sink prints a pair."""
    return F.format_string("(%s,%s)", first, second)


def write_scalar(spark, value: float, path: str) -> None:
    """K7: a scalar state between steps as a one-row Parquet file."""
    spark.createDataFrame([(float(value),)], "value double").coalesce(1).write.mode("overwrite").parquet(path)


def read_scalar(spark, path: str) -> float:
    return float(spark.read.parquet(path).first()["value"])
