"""Archives of zlib-compressed chunks located by a side index of little-endian int32 sizes, as a Python Data Source.

For every data file ``X`` a file ``X.idx`` lists the compressed size of each chunk.  The scan is
planned from file names and sizes alone: the bytes of all archives are cut into ranges, packed
into partitions of ``bytes_per_split``; a task reads the index of its archive (4 bytes a chunk),
takes the chunks that start in its range, and inflates them.  One row per chunk:
(path, chunk_no, offset, text, error).  Archives and chunks can be chosen by path and number
before any of their bytes is read.

A chunk that does not inflate gives a row with ``error`` set and NULL text; the scan goes on
(D13).  Offsets are start offsets in the file (D14).  Index files are never read as data, and
no partition is empty (D15).  Registered as format ``quarry_indexed_chunks``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from quarry.sources.selection import Selection, options

# Index suffix, packing limit per split (64 MiB) and the size entry type.
IDX_SUFFIX = ".idx"
DEFAULT_BYTES_PER_SPLIT = 64 * 1024 * 1024
LEAST_SPLIT = 1024 * 1024  # ranges are not cut below this to give every task slot one
SIZE_DTYPE = "<i4"

TEXT_SCHEMA = "path string, chunk_no int, offset long, text string, error string"
FLUSH_BYTES = 32 * 1024 * 1024   # emit a batch once this much text is buffered
FLUSH_ROWS = 4096


@dataclass
class Ranges(InputPartition):
    """Byte ranges [from, to) of archives; the last range of an archive has no end."""

    parts: list  # of (path, from, to or None)


def plan_ranges(archives: list[tuple[str, int]], bytes_per_split: int) -> list[Ranges]:
    """Archives (path, bytes) cut into ranges of at most ``bytes_per_split``, small ones packed together."""
    out: list[Ranges] = []
    room = 0
    for path, size in archives:
        lo = 0
        while lo < max(size, 1):
            hi = min(size, lo + bytes_per_split)
            part = (path, lo, hi if hi < size else None)
            if hi - lo > room:
                out.append(Ranges([]))
                room = bytes_per_split
            out[-1].parts.append(part)
            room -= hi - lo
            lo = max(hi, lo + 1)
    return out


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.bytes_per_split = int(options.get("bytes_per_split", DEFAULT_BYTES_PER_SPLIT))
        self.at_most = int(options.get("partitions", 0))
        self.slots = int(options.get("slots", 0))
        self.wanted = Selection(options)

    def partitions(self):
        from quarry.sources.fsutil import list_files

        files = dict(list_files(self.path))
        archives = sorted((p, n) for p, n in files.items() if p + IDX_SUFFIX in files and self.wanted.has_path(p))
        split, total = self.bytes_per_split, sum(n for _, n in archives)
        if self.slots:
            split = min(split, max(LEAST_SPLIT, -(-total // self.slots)))
        if self.at_most:
            split = max(split, -(-total // self.at_most))
        return plan_ranges(archives, split) or [Ranges([])]

    def read(self, part: Ranges):
        import pyarrow as pa

        rows: tuple[list, ...] = ([], [], [], [], [])
        buffered = 0
        for path, lo, hi in part.parts:
            for row in self._chunks(path, lo, hi):
                for column, value in zip(rows, row):
                    column.append(value)
                buffered += len(row[3] or "")
                if buffered >= FLUSH_BYTES or len(rows[0]) >= FLUSH_ROWS:
                    yield _batch(pa, rows)
                    buffered = 0
        if rows[0]:
            yield _batch(pa, rows)

    def _chunks(self, path: str, lo: int, hi: int | None):
        """Rows of the wanted chunks that start in [lo, hi)."""
        import zlib

        import numpy as np

        from quarry.sources.fsutil import resolve

        fs, p = resolve(path + IDX_SUFFIX)
        with fs.open_input_stream(p, compression=None) as f:
            sizes = np.frombuffer(f.read(), dtype=SIZE_DTYPE).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        end = len(sizes) if hi is None else int(np.searchsorted(starts, hi))
        runs = self.wanted.runs(end, int(np.searchsorted(starts, lo)))
        if not runs:
            return
        fs, p = resolve(path)
        with fs.open_input_file(p) as f:
            for k in (k for run in runs for k in range(*run)):
                text, err = None, None
                try:
                    f.seek(int(starts[k]))
                    raw = f.read(int(sizes[k]))
                    if len(raw) != sizes[k]:
                        raise ValueError("truncated chunk")
                    text = zlib.decompress(raw).decode("utf-8")
                except (zlib.error, ValueError, UnicodeDecodeError) as exc:
                    err = f"{type(exc).__name__}: {exc}"
                yield path, k, int(starts[k]), text, err


def _batch(pa, rows):
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string())
    out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, kinds)],
                                     names=["path", "chunk_no", "offset", "text", "error"])
    for c in rows:
        c.clear()
    return out


class IndexedChunksSource(DataSource):
    @classmethod
    def name(cls):
        return "quarry_indexed_chunks"

    def schema(self):
        return TEXT_SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        from quarry.sinks.binary import IndexedChunksWriter

        return IndexedChunksWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    from quarry.session import ensure_importable

    ensure_importable(spark)
    spark.dataSource.register(IndexedChunksSource)


def read_indexed_chunks(spark: SparkSession, path: str, bytes_per_split: int = DEFAULT_BYTES_PER_SPLIT,
                        partitions: int | None = None, paths=None, chunks=None) -> DataFrame:
    """Every chunk of every archive under ``path`` (a directory of ``X`` + ``X.idx``), inflated.

    Ranges are smaller than ``bytes_per_split`` where there are task slots for more of them.
    ``partitions``: no more ranges than about so many, whatever their size.  Only the archives
    ``paths`` (as in the ``path`` column) and the chunk numbers ``chunks`` (a ``range`` or
    integers), if given: of the other chunks no byte is read."""
    from quarry.session import parallelism

    register(spark)
    r = spark.read.format("quarry_indexed_chunks").option("path", path).option("bytes_per_split", str(bytes_per_split))
    r = r.options(**options(paths, chunks)).option("slots", str(parallelism(spark)))
    return (r.option("partitions", str(partitions)) if partitions else r).load()


def chunk_errors(chunks: DataFrame) -> DataFrame:
    """A18 counter: one row (chunks, bad_chunks)."""
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count("error").alias("bad_chunks"))
