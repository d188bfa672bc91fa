"""Fixed-length binary records (one row per record), as a Python Data Source.

Files are cut on record boundaries: each input partition is a byte range of
one file holding a whole number of records (``split_bytes`` rounded down to
records, at least one record); a trailing partial record is dropped.
Registered as format ``quarry_fixed_records``:

    spark.read.format("quarry_fixed_records").option("path", p)
         .option("record_bytes", 264).load()
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarry.sources.selection import Selection, options

# The reference's default record size (one bitmap) and split size.
DEFAULT_RECORD_BYTES = 537_654
DEFAULT_SPLIT_BYTES = 128 * 1024 * 1024
SCHEMA = "path string, record_no long, record binary"


@dataclass
class RecordRange(InputPartition):
    path: str
    first: int     # first record number
    count: int     # records in this range
    record_bytes: int


def plan_ranges(files: list[tuple[str, int]], record_bytes: int, split_bytes: int,
                wanted: Selection | None = None) -> list[RecordRange]:
    """Ranges of whole records of about ``split_bytes``; of the ``wanted`` numbers only, if given."""
    per_split = max(1, split_bytes // record_bytes)
    out = []
    for path, size in files:
        for lo, hi in (wanted or Selection({})).runs(size // record_bytes):
            for first in range(lo, hi, per_split):
                out.append(RecordRange(path, first, min(per_split, hi - first), record_bytes))
    return out


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.record_bytes = int(options.get("record_bytes", DEFAULT_RECORD_BYTES))
        self.split_bytes = int(options.get("split_bytes", DEFAULT_SPLIT_BYTES))
        self.wanted = Selection(options)

    def partitions(self):
        from quarry.sources.fsutil import list_files

        files = [(p, n) for p, n in list_files(self.path) if self.wanted.has_path(p)]
        ranges = plan_ranges(files, self.record_bytes, self.split_bytes, self.wanted)
        return ranges or [RecordRange(self.path, 0, 0, self.record_bytes)]

    def read(self, part: RecordRange):
        import pyarrow as pa

        from quarry.sources.fsutil import resolve

        if part.count == 0:
            return
        fs, p = resolve(part.path)
        batch = max(1, (8 << 20) // part.record_bytes)   # ~8 MiB per Arrow batch
        with fs.open_input_file(p) as f:
            f.seek(part.first * part.record_bytes)
            done = 0
            while done < part.count:
                k = min(batch, part.count - done)
                buf = f.read(k * part.record_bytes)
                # the buffer viewed as k fixed-size values (no per-record copies), then as BINARY
                recs = pa.FixedSizeBinaryArray.from_buffers(pa.binary(part.record_bytes), k,
                                                            [None, pa.py_buffer(buf)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.path] * k, pa.string()),
                     pa.array(range(part.first + done, part.first + done + k), pa.int64()),
                     recs],
                    names=["path", "record_no", "record"])
                done += k


class FixedRecordsSource(DataSource):
    @classmethod
    def name(cls):
        return "quarry_fixed_records"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        from quarry.sinks.binary import FixedRecordsWriter

        return FixedRecordsWriter(self.options, overwrite)


def register(spark) -> None:
    from quarry.session import ensure_importable

    ensure_importable(spark)
    spark.dataSource.register(FixedRecordsSource)


def read_fixed_records(spark, path: str, record_bytes: int = DEFAULT_RECORD_BYTES,
                       split_bytes: int = DEFAULT_SPLIT_BYTES, paths=None, records=None):
    """Records of the files under ``path``; only those of ``paths`` (as in the ``path`` column) and of the
    numbers ``records`` (a ``range`` or integers), if given: nothing else is read."""
    register(spark)
    return (spark.read.format("quarry_fixed_records").option("path", path).options(**options(paths, records))
            .option("record_bytes", str(record_bytes)).option("split_bytes", str(split_bytes)).load())
