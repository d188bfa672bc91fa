"""Two-phase writers for the binary layouts (K10): tasks write aside, the driver publishes.

A task writes its file into ``<folder>/_attempt-<id>``; only when every task has ended does
``commit`` take the earlier files away (overwrite) and move the new ones in.  ``abort`` deletes
what was written aside, so a failed job leaves the earlier files as they were; what a task that
is still running then writes stays aside, where no reader looks, until the next overwrite.
Retried and speculative tasks have files of their own, and only the reported ones are moved.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

PREFIX = "part-"


@dataclass
class Written(WriterCommitMessage):
    """Files of one task: (name aside, final name without the write's own prefix)."""

    files: list
    rows: int
    bytes: int


class BinaryWriter(DataSourceArrowWriter):
    """One file a task; ``pieces`` turns Arrow batches into the file's bytes.

    Without ``overwrite`` the files are added to those of the folder under names of their own.
    """

    suffix = ".bin"

    def __init__(self, options, overwrite: bool):
        self.folder = options["path"].rstrip("/")
        self.report = options.get("report")
        self.overwrite = overwrite
        self.attempt = uuid.uuid4().hex[:12]

    def pieces(self, batches, count: list) -> Iterator[bytes]:
        """Bytes of the batches' rows in order; adds the rows to ``count[0]``."""
        raise NotImplementedError

    def beside(self) -> list[tuple[str, bytes]]:
        """(suffix, bytes) of further files of the task, published with its own."""
        return []

    def write(self, iterator) -> Written:
        from pyspark import TaskContext

        from quarry.sources.fsutil import write_atomic

        ctx = TaskContext.get()
        aside = f"{self.folder}/_attempt-{self.attempt}/{ctx.partitionId():05d}-{ctx.taskAttemptId()}{self.suffix}"
        final = f"{ctx.partitionId():05d}{self.suffix}"
        count = [0]
        n = write_atomic(aside, self.pieces(iterator, count), skip_empty=True)
        files = [(aside, final)] if n else []
        if n:
            for suffix, data in self.beside():
                write_atomic(aside + suffix, [data])
                files.append((aside + suffix, final + suffix))
        return Written(files, count[0], n)

    def commit(self, messages) -> None:
        from quarry.sources.fsutil import list_folders, move_file, remove_files, remove_folder, write_atomic

        done = [m for m in messages if m is not None]
        prefix = PREFIX if self.overwrite else f"{PREFIX}{self.attempt}-"
        if self.overwrite:
            remove_files(self.folder, PREFIX)
        for m in done:
            # a file that is read through another one (an archive by its index) comes before it
            for aside, final in m.files:
                move_file(aside, f"{self.folder}/{prefix}{final}")
        # an overwrite is alone in its folder: what killed tasks of failed writes left aside goes, too
        for left in list_folders(self.folder, "_attempt-") if self.overwrite else [f"{self.folder}/_attempt-{self.attempt}"]:
            remove_folder(left)
        if self.report:
            totals = {"rows": sum(m.rows for m in done), "bytes": sum(m.bytes for m in done), "files": len(done)}
            write_atomic(self.report, [json.dumps(totals).encode()])

    def abort(self, messages) -> None:
        from quarry.sources.fsutil import remove_folder

        remove_folder(f"{self.folder}/_attempt-{self.attempt}")


class FixedRecordsWriter(BinaryWriter):
    """Binary values of one length, end to end (S4's layout)."""

    def __init__(self, options, overwrite):
        super().__init__(options, overwrite)
        self.record_bytes = int(options["record_bytes"])

    def pieces(self, batches, count):
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                recs = batch.column(0).slice(lo, 4096).to_pylist()
                bad = [r for r in recs if r is None or len(r) != self.record_bytes]
                if bad:
                    raise ValueError(f"record of {'no' if bad[0] is None else len(bad[0])} bytes, expected {self.record_bytes}")
                count[0] += len(recs)
                yield b"".join(recs)


class IndexedChunksWriter(BinaryWriter):
    """A zlib chunk for each text, sizes in a side index (S5's layout); null counts as empty."""

    suffix = ".z"

    def __init__(self, options, overwrite):
        super().__init__(options, overwrite)
        self.level = int(options.get("level", 6))
        self.sizes: list[int] = []

    def pieces(self, batches, count):
        import zlib

        self.sizes = []
        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunk = zlib.compress((text or "").encode("utf-8"), self.level)
                self.sizes.append(len(chunk))
                count[0] += 1
                yield chunk

    def beside(self):
        import numpy as np

        from quarry.sources.indexed_chunks import IDX_SUFFIX, SIZE_DTYPE

        return [(IDX_SUFFIX, np.asarray(self.sizes, dtype=SIZE_DTYPE).tobytes())]


class DocStreamWriter(BinaryWriter):
    """Length-prefixed ``document`` messages of (url, body, text) rows, plain or gzip (S10's layout).

    A plain stream longer than ``index_bytes`` gets a side index with the start of a message about
    every so many bytes.
    """

    def __init__(self, options, overwrite):
        from quarry.sources.docstream import INDEX_BYTES

        super().__init__(options, overwrite)
        self.compress = options.get("compress", "false") == "true"
        self.suffix = ".pb.gz" if self.compress else ".pb"
        self.index_bytes = int(options.get("index_bytes", INDEX_BYTES))
        self.starts: list[int] = []

    def pieces(self, batches, count):
        plain = self._messages(batches, count)
        if not self.compress:
            yield from plain
            return
        import zlib

        squeeze = None
        for piece in plain:
            squeeze = squeeze or zlib.compressobj(wbits=31)
            if out := squeeze.compress(piece):
                yield out
        if squeeze:
            yield squeeze.flush()

    def _messages(self, batches, count):
        from quarry.sources.docstream import encode_document

        self.starts, at = [0], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for row in zip(*[c.to_pylist() for c in batch.slice(lo, 512).columns]):
                    if at - self.starts[-1] >= self.index_bytes:
                        self.starts.append(at)
                    message = encode_document(*row)
                    at += len(message)
                    count[0] += 1
                    yield message

    def beside(self):
        import numpy as np

        from quarry.sources.docstream import START_DTYPE, STARTS_SUFFIX

        return [] if self.compress or len(self.starts) == 1 else [(STARTS_SUFFIX, np.asarray(self.starts, START_DTYPE).tobytes())]


def written(report: str) -> dict:
    """What a write with this ``report`` option made: rows, bytes, files (tasks)."""
    from quarry.sources.fsutil import resolve

    fs, p = resolve(report)
    with fs.open_input_stream(p, compression=None) as f:
        return json.loads(f.read())
