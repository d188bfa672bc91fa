"""Text-line layouts (S1-S3, S6, S11, S12, S14, S15); edge lines (S13) live in ``operators.graph``.

All readers use Spark's own text/CSV sources with explicit schemas, so
splitting, compression codecs and small-file packing are Spark's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.codec import from_base64_text, utf8_lenient
from quarry.functions.weather import FIELDS, parse_gsod

SMALL_FILE_SPLIT = 32 * 1024 * 1024
OPEN_COST = 64 * 1024  # what opening a file counts as, in bytes, when small files are packed


def read_lines(spark: SparkSession, paths, resplit: int | None = None) -> DataFrame:
    """S1 (+S3): text lines as ``value``; gzip input is one task per file, so ``resplit``
    spreads the rows over that many partitions right after the scan."""
    df = spark.read.text(paths)
    return df.repartition(resplit) if resplit else df


def read_small_files(spark: SparkSession, paths, max_split_bytes: int = SMALL_FILE_SPLIT) -> DataFrame:
    """Many small files packed into splits of at most ``max_split_bytes``.

    The packing is a setting of the session that plans the read, so the read gets a session
    of its own (same application, same catalog); the caller's settings stay as they are."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(max_split_bytes))
    own.conf.set("spark.sql.files.openCostInBytes", str(min(max_split_bytes, OPEN_COST)))
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own.read.text(paths)


def split_kv(lines: DataFrame, key: str = "key", value: str = "value", line_col: str = "value") -> DataFrame:
    """Split at the first TAB; no TAB -> empty value."""
    parts = F.split(F.col(line_col), "\t", 2)
    return lines.select(parts[0].alias(key), F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")).alias(value))


def read_kv(spark: SparkSession, paths, key: str = "key", value: str = "value") -> DataFrame:
    return split_kv(spark.read.text(paths), key, value)


def url_base64_fields(line_col: str):
    """The TAB-separated fields of a line, empty ones at its end left out."""
    return F.split(F.regexp_replace(F.col(line_col), "\t+$", ""), "\t")


def parse_url_base64(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """S11 + P4 + F10/F11: ``url<TAB>base64(text)`` -> (url, text); lines without exactly
    two fields are dropped (count them with :func:`bad_url_base64_lines`).  Empty fields at
    the end of a line don't count."""
    parts = url_base64_fields(line_col)
    ok = lines.filter(F.size(parts) == 2)
    return ok.select(parts[0].alias("url"), utf8_lenient(from_base64_text(parts[1])).alias("text"))


def bad_url_base64_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """A18 ``bad_input`` counter: one row (lines, bad_lines)."""
    n = F.size(url_base64_fields(line_col))
    return lines.agg(F.count(F.lit(1)).alias("lines"), F.count_if(n != 2).alias("bad_lines"))


def _dated(columns=("station", "year", "month", "day")):
    ok = F.lit(True)
    for c in columns:
        ok = ok & F.col(c).isNotNull()
    return ok


def parse_weather_lines(lines: DataFrame, line_col: str = "value", fields: dict = FIELDS) -> DataFrame:
    """Fixed-width daily records -> (station, year, month, day, max_c, min_c).

    Lines too short or not numeric give NULL fields and are dropped (D18); count them with
    :func:`rejected_weather_lines`."""
    return lines.select(*parse_gsod(line_col, fields)).filter(_dated())


def rejected_weather_lines(lines: DataFrame, line_col: str = "value", fields: dict = FIELDS) -> DataFrame:
    """One row (lines, rejected_lines) for :func:`parse_weather_lines`."""
    return lines.select(*parse_gsod(line_col, fields)).agg(
        F.count(F.lit(1)).alias("lines"), F.count_if(~_dated()).alias("rejected_lines"))


def read_stations(spark: SparkSession, paths) -> DataFrame:
    """Station CSV, columns found by their header names, all strings -> (usaf, lat, lon, name, ord).

    ``ord`` is the place in the files: file, offset of the split, row of the split."""
    df = spark.read.csv(paths, header=True)
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                  F.monotonically_increasing_id().alias("row"))
    name = {c: F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in ("USAF", "LAT", "LON", "STATION NAME")}
    return df.select(name["USAF"].alias("usaf"), name["LAT"].alias("lat"), name["LON"].alias("lon"),
                     name["STATION NAME"].alias("name"), at.alias("ord"))


def parse_rank_state(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``id,PR<TAB>to,to,...`` -> (id, pr, dst ARRAY<BIGINT>); empty value = no out-links.

    Lines with a part that is no number are dropped; count them with :func:`bad_rank_lines`."""
    return _rank_state(lines, line_col).filter("ok").select("id", "pr", "dst")


def bad_rank_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """One row (lines, bad_lines) for :func:`parse_rank_state`."""
    return _rank_state(lines, line_col).agg(F.count(F.lit(1)).alias("lines"), F.count_if(~F.col("ok")).alias("bad_lines"))


def _rank_state(lines: DataFrame, line_col: str) -> DataFrame:
    kv = split_kv(lines, "k", "v", line_col)
    head = F.split(F.col("k"), ",")
    dst = F.when(F.col("v") == "", F.array().cast("array<bigint>")).otherwise(
        F.transform(F.split(F.col("v"), ","), lambda x: x.try_cast("bigint")))
    out = kv.select(F.try_element_at(head, F.lit(1)).try_cast("bigint").alias("id"),
                    F.try_element_at(head, F.lit(2)).try_cast("double").alias("pr"), dst.alias("dst"))
    return out.withColumn("ok", F.col("id").isNotNull() & F.col("pr").isNotNull()
                          & F.forall("dst", lambda x: x.isNotNull()))


def rank_state_line(id_col, pr_col, dst_col):
    """inverse of :func:`parse_rank_state` for one row's fields and (bounded) array of targets."""
    return F.concat(F.col(id_col).cast("string"), F.lit(","), F.col(pr_col).cast("string"), F.lit("\t"),
                    F.array_join(F.col(dst_col).cast("array<string>"), ","))
