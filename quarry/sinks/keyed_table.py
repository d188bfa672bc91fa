"""Keyed tables on Parquet: versions with a manifest of key ranges.

A table is a folder.  A version's rows lie in Parquet files of disjoint key ranges, sorted by
key; its manifest ``manifest-<version>`` (Parquet, a row a file) holds each file's name, least
and greatest key and number of rows, and ``_CURRENT`` names the published version.  A change
rewrites the files whose ranges hold a changed key; the next version takes the others over by
name.  Reads of a key or a range of keys open the files that the manifest names only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_FILES = 1_000_000  # files of a version; the driver holds a name and a key of each, as when it plans a scan
GROWN = 2  # a file that grows past this multiple of the largest one is split


def _base(table_dir: str) -> str:
    return table_dir.rstrip("/")


def current_version(table_dir: str) -> str:
    """Name of the published version."""
    from quarry.sources.fsutil import resolve

    fs, p = resolve(f"{_base(table_dir)}/_CURRENT")
    with fs.open_input_stream(p, compression=None) as f:
        return f.read().decode().strip()


def manifest(spark: SparkSession, table_dir: str, version: str | None = None) -> DataFrame:
    """(file, least, greatest, rows) of a version, the published one unless named."""
    return spark.read.parquet(f"{_base(table_dir)}/manifest-{version or current_version(table_dir)}")


def _write_files(rows: DataFrame, target: str, key_col: str, max_rows: int | None = None) -> None:
    """Rows already dealt and sorted -> Parquet files with a bloom filter on the key."""
    w = (rows.write.option(f"parquet.bloom.filter.enabled#{key_col}", "true")
         .option("parquet.bloom.filter.adaptive.enabled", "true"))
    if max_rows:
        w = w.option("maxRecordsPerFile", max_rows)
    w.parquet(target)


def _ranges(spark: SparkSession, table_dir: str, version: str, key_col: str) -> DataFrame:
    """Manifest rows of the files that were written for ``version`` (its key column is read once)."""
    own = spark.read.parquet(f"{_base(table_dir)}/{version}")
    return (own.groupBy(F.concat(F.lit(version + "/"), F.col("_metadata.file_name")).alias("file"))
            .agg(F.min(key_col).alias("least"), F.max(key_col).alias("greatest"), F.count(F.lit(1)).alias("rows")))


def _publish(table_dir: str, version: str, was: str | None) -> None:
    """The last step of a change: readers see the old version before it and the new one after.

    ``was``: the version that the change started from; another one published since then fails it.
    """
    from quarry.sources.fsutil import write_atomic

    if was is not None and current_version(table_dir) != was:
        raise RuntimeError(f"{table_dir}: version {was} was replaced while it was changed")
    write_atomic(f"{_base(table_dir)}/_CURRENT", [version.encode()])


def _new_version() -> str:
    return f"v-{uuid.uuid4().hex[:12]}"


def write_version(df: DataFrame, table_dir: str, key_col: str = "row_key", partitions: int | None = None) -> str:
    """K5: write all rows as the next version, range-partitioned and sorted by key; the folder of its files.

    Keys are unique and not null.  A table without rows keeps one file, for its columns.
    """
    version = _new_version()
    target = f"{_base(table_dir)}/{version}"
    dealt = df.repartitionByRange(partitions, key_col) if partitions else df.repartitionByRange(key_col)
    _write_files(dealt.sortWithinPartitions(key_col), target, key_col)
    _ranges(df.sparkSession, table_dir, version, key_col).coalesce(1).write.parquet(f"{_base(table_dir)}/manifest-{version}")
    _publish(table_dir, version, None)
    return target


def _read_files(spark: SparkSession, table_dir: str, version: str, files: list[str]) -> DataFrame:
    if not files:
        return spark.read.parquet(f"{_base(table_dir)}/{version}").filter(F.lit(False))
    return spark.read.parquet(*[f"{_base(table_dir)}/{f}" for f in files])


def read_current(spark: SparkSession, table_dir: str) -> DataFrame:
    """The published version of a keyed table, all rows."""
    version = current_version(table_dir)
    files = [r["file"] for r in manifest(spark, table_dir, version).select("file").collect()]
    if all(f.startswith(version + "/") for f in files):  # nothing taken over: the folder is the version
        return spark.read.parquet(f"{_base(table_dir)}/{version}")
    return _read_files(spark, table_dir, version, files)


def key_range(spark: SparkSession, table_dir: str, least, greatest, key_col: str = "row_key") -> DataFrame:
    """Rows with ``least <= key <= greatest``; only files whose ranges meet the interval are opened."""
    version = current_version(table_dir)
    hit = manifest(spark, table_dir, version).filter((F.col("least") <= F.lit(greatest)) & (F.col("greatest") >= F.lit(least)))
    files = [r["file"] for r in hit.select("file").collect()]
    return _read_files(spark, table_dir, version, files).filter(F.col(key_col).between(F.lit(least), F.lit(greatest)))


def point_lookup(spark: SparkSession, table_dir: str, key, key_col: str = "row_key") -> DataFrame:
    """The row of a key: one file at most, whose row groups its bloom filters and statistics skip."""
    version = current_version(table_dir)
    hit = manifest(spark, table_dir, version).filter(F.lit(key).between(F.col("least"), F.col("greatest")))
    files = [r["file"] for r in hit.select("file").collect()]
    return _read_files(spark, table_dir, version, files).filter(F.col(key_col) == F.lit(key))


def _slot_of(bounds: list):
    """The file that a key belongs to: the last one whose least key is not greater, else the first."""
    from bisect import bisect_right

    def slot(keys: pd.Series) -> pd.Series:
        return pd.Series([max(bisect_right(bounds, k) - 1, 0) for k in keys], dtype="int32")

    return F.pandas_udf(slot, "int")


def change_version(spark: SparkSession, table_dir: str, changes: DataFrame,
                   merge: Callable[[DataFrame, DataFrame], DataFrame], key_col: str = "row_key") -> dict:
    """K3/K4: publish the version that ``merge(rows, changes)`` makes, rewriting only touched files.

    ``merge`` gets the rows of the touched files with their changes and returns these files'
    next rows; it keeps each key (``merge_cells`` and ``upsert_rows`` do).  A file is touched
    if a change's key falls into its range (a key between two files belongs to the one before
    it).  Files keep disjoint ranges, one that has grown is split.  Returns the version and
    how many files were rewritten and taken over.  A failure before the end leaves the
    published version as it is.
    """
    from quarry.session import ensure_importable, scratch_path

    ensure_importable(spark)
    was = current_version(table_dir)
    files_of = manifest(spark, table_dir, was)
    if files_of.count() > MAX_FILES:
        raise ValueError(f"{table_dir}: more than {MAX_FILES} files; write a whole version with larger ones")
    held = files_of.orderBy("least").collect()
    if not held:
        write_version(merge(read_current(spark, table_dir), changes), table_dir, key_col)
        return {"version": current_version(table_dir), "rewritten": 0, "kept": 0}
    slot = _slot_of([r["least"] for r in held])
    # the changes are evaluated once
    path = scratch_path(spark, "changes")
    changes.withColumn("_slot", slot(F.col(key_col))).write.parquet(path)
    routed = spark.read.parquet(path)
    touched = sorted(r["_slot"] for r in routed.select("_slot").distinct().collect())
    if not touched:
        return {"version": was, "rewritten": 0, "kept": len(held)}
    files = [held[s]["file"] for s in touched]
    merged = merge(_read_files(spark, table_dir, was, files), routed.drop("_slot"))
    # a task a touched file: its number among the touched ones
    place = _slot_of([held[s]["least"] for s in touched])
    rows = (merged.withColumn("_slot", place(F.col(key_col))).repartitionById(len(touched), F.col("_slot"))
            .sortWithinPartitions(key_col).drop("_slot"))
    version = _new_version()
    _write_files(rows, f"{_base(table_dir)}/{version}", key_col, GROWN * max(r["rows"] for r in held))
    gone = spark.createDataFrame([(f,) for f in files], "file string")
    kept = manifest(spark, table_dir, was).join(gone, "file", "left_anti")
    (kept.unionByName(_ranges(spark, table_dir, version, key_col)).coalesce(1)
     .write.parquet(f"{_base(table_dir)}/manifest-{version}"))
    _publish(table_dir, version, was)
    return {"version": version, "rewritten": len(files), "kept": len(held) - len(files)}
