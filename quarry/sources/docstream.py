"""Streams of length-prefixed protobuf ``document`` messages (plain or gzip).

Message: ``url`` (field 1, required), ``body`` (2, optional), ``text`` (3,
optional), each a length-delimited UTF-8 string; every message is preceded
by its size as a 4-byte native-order int.  A gzip stream can only be read from
its start: one task, read incrementally, never as one value; ``resplit``
spreads the rows afterwards (S3).  A plain stream is read in ranges that begin
at messages: their starts come from the side index ``X.starts`` that the
writer leaves, or from a walk over the length prefixes (one task a stream,
which skips the messages' bytes).
Registered as format ``quarry_docstream`` (one task a stream there).
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Length prefix layout and the message's field numbers.
LENGTH_PREFIX = struct.Struct("=i")
URL_FIELD, BODY_FIELD, TEXT_FIELD = 1, 2, 3
LEN_DELIMITED = 2
SCHEMA = "url string, body string, text string"
MAX_BATCH_ROWS = 4096
STARTS_SUFFIX, START_DTYPE = ".starts", "<i8"
INDEX_BYTES = 1024 * 1024  # bytes between the starts of a written index
RANGE_BYTES = 64 * 1024 * 1024  # of a plain stream that a task reads
WALK_BYTES = 1024 * 1024  # read at a time by the walk; longer messages are passed by a seek
RANGE = "path string, start long, stop long, id int"
MAX_BATCH_BYTES = 32 * 1024 * 1024


def _varint(buf: bytes, i: int) -> tuple[int, int]:
    shift = result = 0
    while True:
        if i >= len(buf):
            raise ValueError("message ends inside a number")
        b = buf[i]
        i += 1
        result |= (b & 0x7F) << shift
        if b < 0x80:
            return result, i
        shift += 7


def _put_varint(n: int) -> bytes:
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def decode_document(msg: bytes) -> tuple[str | None, str | None, str | None]:
    """Fields 1-3 of one message; unknown fields are skipped."""
    vals = {URL_FIELD: None, BODY_FIELD: None, TEXT_FIELD: None}
    i = 0
    while i < len(msg):
        key, i = _varint(msg, i)
        field, wire = key >> 3, key & 7
        if wire == LEN_DELIMITED:
            n, i = _varint(msg, i)
            if i + n > len(msg):
                raise ValueError("message ends inside a field")
            if field in vals:
                vals[field] = msg[i:i + n].decode("utf-8")
            i += n
        elif wire == 0:
            _, i = _varint(msg, i)
        elif wire == 1:
            i += 8
        elif wire == 5:
            i += 4
        else:
            raise ValueError(f"unsupported wire type {wire}")
    if i > len(msg):
        raise ValueError("message ends inside a field")
    return vals[URL_FIELD], vals[BODY_FIELD], vals[TEXT_FIELD]


def encode_document(url: str, body: str | None = None, text: str | None = None) -> bytes:
    """One message with its length prefix."""
    out = bytearray()
    for field, val in ((URL_FIELD, url), (BODY_FIELD, body), (TEXT_FIELD, text)):
        if val is None:
            continue
        b = val.encode("utf-8")
        out += _put_varint((field << 3) | LEN_DELIMITED) + _put_varint(len(b)) + b
    return LENGTH_PREFIX.pack(len(out)) + bytes(out)


def _exactly(stream, n: int, path: str) -> bytes:
    """The next ``n`` bytes; nothing at the end of the stream; an error in between (also for cut gzip data)."""
    out = b""
    while len(out) < n:
        try:
            more = stream.read(n - len(out))
        except EOFError as exc:
            raise ValueError(f"{path}: the compressed stream is cut") from exc
        if not more:
            if out:
                raise ValueError(f"{path}: the stream ends after {len(out)} of {n} bytes")
            return b""
        out += more
    return out


def documents(path: str, start: int = 0, stop: int | None = None):
    """Arrow batches of the messages that begin in [start, stop) of a stream (all of a gzip one)."""
    import gzip

    import pyarrow as pa

    from quarry.sources.fsutil import resolve

    fs, p = resolve(path)
    if p.endswith(".gz"):
        stream = gzip.GzipFile(fileobj=fs.open_input_stream(p, compression=None))
    else:
        stream = fs.open_input_file(p)
        stream.seek(start)
    rows = ([], [], [])
    buffered, at = 0, start

    def flush():
        batch = pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in rows],
                                           names=["url", "body", "text"])
        for c in rows:
            c.clear()
        return batch

    try:
        while stop is None or at < stop:
            head = _exactly(stream, LENGTH_PREFIX.size, path)
            if not head:
                break
            size = _size(head, path)
            msg = _exactly(stream, size, path) if size else b""
            if len(msg) < size:
                raise ValueError(f"{path}: the stream ends before a message of {size} bytes")
            for c, v in zip(rows, decode_document(msg)):
                c.append(v)
            at += LENGTH_PREFIX.size + size
            buffered += size
            if len(rows[0]) >= MAX_BATCH_ROWS or buffered >= MAX_BATCH_BYTES:
                yield flush()
                buffered = 0
        if rows[0]:
            yield flush()
    finally:
        stream.close()


def _size(head: bytes, path: str) -> int:
    (size,) = LENGTH_PREFIX.unpack(head)
    if size < 0:
        raise ValueError(f"{path}: a message of {size} bytes")
    return size


def _walk(path: str, length: int, range_bytes: int):
    """Starts of the first message at or after every ``range_bytes`` of a plain stream."""
    from quarry.sources.fsutil import resolve

    fs, p = resolve(path)
    at, due, prefix = 0, 0, LENGTH_PREFIX.size
    with fs.open_input_file(p) as f:
        lo, block = 0, b""
        while at < length:
            if at >= due:
                yield at
                due = at + range_bytes
            if not lo <= at <= lo + len(block) - prefix:
                f.seek(at)
                lo, block = at, f.read(WALK_BYTES)
                if len(block) < prefix:
                    raise ValueError(f"{path}: the stream ends after {len(block)} of {prefix} bytes")
            at += prefix + _size(block[at - lo:at - lo + prefix], path)
    if at > length:
        raise ValueError(f"{path}: the stream ends before the end of its last message")


def _starts(path: str, length: int, indexed: bool, range_bytes: int) -> list[int]:
    """Where the ranges of a stream begin."""
    import numpy as np

    from quarry.sources.fsutil import resolve

    if not length:
        return []
    if path.endswith(".gz") or length <= range_bytes:
        return [0]
    if not indexed:
        return list(_walk(path, length, range_bytes))
    fs, p = resolve(path + STARTS_SUFFIX)
    with fs.open_input_stream(p, compression=None) as f:
        starts = np.frombuffer(f.read(), START_DTYPE)
    # the first known start at or after every range_bytes
    out, due = [], 0
    for s in starts.tolist():
        if s >= due:
            out.append(s)
            due = s + range_bytes
    return out


def _files(path: str) -> list[tuple[str, int, bool]]:
    """(stream, bytes, has an index) of a folder, a glob or one file."""
    from quarry.sources.fsutil import is_file, list_files

    found = dict(list_files(path))
    streams = {p: n for p, n in found.items() if not p.endswith(STARTS_SUFFIX)}
    return sorted((p, n, p + STARTS_SUFFIX in found or (len(found) == 1 and is_file(p + STARTS_SUFFIX)))
                  for p, n in streams.items())


def stream_ranges(spark, path: str, range_bytes: int = RANGE_BYTES):
    """(path, start, stop, id) of about ``range_bytes`` each; a gzip stream is one range without a stop.

    The ids number the ranges of all streams.  Streams are looked at by tasks, the driver only
    lists them; one row per stream goes through one task to number the ranges.
    """
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from quarry.session import ensure_importable

    ensure_importable(spark)
    files = _files(path)
    rows = spark.createDataFrame(files, "path string, length long, indexed boolean")

    def starts(batches):
        import pyarrow as pa

        for batch in batches:
            got = [_starts(*row, range_bytes) for row in zip(*[c.to_pylist() for c in batch.columns])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.int64()))], names=["path", "starts"])

    found = rows.repartition(max(1, len(files))).mapInArrow(starts, "path string, starts array<long>")
    before = F.sum(F.size("starts")).over(Window.orderBy("path")) - F.size("starts")
    each = found.select("path", "starts", before.alias("first")).select("path", "starts", "first", F.posexplode("starts").alias("k", "start"))
    stop = F.try_element_at("starts", F.col("k") + 2)
    return each.select("path", "start", stop.alias("stop"), (F.col("first") + F.col("k")).cast("int").alias("id"))


@dataclass
class StreamFile(InputPartition):
    path: str


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]

    def partitions(self):
        return [StreamFile(p) for p, _, _ in _files(self.path)] or [StreamFile("")]

    def read(self, part: StreamFile):
        if part.path:
            yield from documents(part.path)


class DocStreamSource(DataSource):
    @classmethod
    def name(cls):
        return "quarry_docstream"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        from quarry.sinks.binary import DocStreamWriter

        return DocStreamWriter(self.options, overwrite)


def register(spark) -> None:
    from quarry.session import ensure_importable

    ensure_importable(spark)
    spark.dataSource.register(DocStreamSource)


def _read_ranges(batches):
    for batch in batches:
        for path, start, stop in zip(*[c.to_pylist() for c in batch.columns[:3]]):
            yield from documents(path, start, stop)


def read_docstream(spark, path: str, resplit: int | None = None, range_bytes: int = RANGE_BYTES):
    """Documents under ``path``: a task for every ``range_bytes`` of a plain stream, one for a gzip stream;
    ``resplit`` spreads the rows over so many partitions right after the scan (S3)."""
    ranges = stream_ranges(spark, path, range_bytes)
    kept = ranges.collect()  # a row a task, as a file scan's plan
    if not kept:
        return spark.createDataFrame([], SCHEMA)
    rows = spark.createDataFrame([tuple(r) for r in kept], RANGE)
    docs = rows.repartitionById(len(kept), "id").mapInArrow(_read_ranges, SCHEMA)
    return docs.repartition(resplit) if resplit else docs


def parts_for(spark, path: str, bytes_each: int = 64 * 1024 * 1024) -> int:
    """Partitions for the streams under ``path``, by their size; gzip counts as four times its bytes."""
    from quarry.session import parallelism

    total = sum(size * (4 if p.endswith(".gz") else 1) for p, size, _ in _files(path))
    return max(parallelism(spark), -(-total // bytes_each))
