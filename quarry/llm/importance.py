"""Target-distribution importance resampling over hashed word runs.

Every run of one to three words falls into one of 10,000 buckets; a bucket's gain is the log
ratio of its share in the target texts to its share in the corpus.  A task scores documents by
an array of gains.  The cutoff of the draw is found exactly by a weighted median of the
partitions' medians, which discards a fixed fraction of the remaining keys each time; only the
winners are sorted.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import appended, map_arrow, pick, staged, table

BUCKETS = 10_000
LONGEST = 3  # words in a feature
MIN_WORDS = 20
SHARE = 5  # per cent of the documents with MIN_WORDS words
SEED = 42
PIECE = 4 << 20  # bytes of text handled at a time; a longer text is cut between words
SHIFTS = 64  # word lengths with shift tables; longer words go through zlib
LAST_KEYS = 4096  # remaining keys that are sorted at once to read the cutoff off

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 by byte, and ``shift[n][k][b]``: byte b at place k of a checksum, moved by n zero bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, np.uint32(0xEDB88320) ^ (one >> 1), one >> 1).astype(np.uint32)
    shift = np.empty((SHIFTS + 1, 4, 256), np.uint32)
    shift[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(SHIFTS):
        shift[n + 1] = one[shift[n] & 0xFF] ^ (shift[n] >> 8)
    return one, shift


class Hasher:
    """Buckets of all word runs of texts, whole arrays at a time.

    A checksum of joined parts is the first part's, moved by the second's length, xor the
    second's: so runs of two and three words come from the words' own checksums.
    """

    def __init__(self, buckets: int = BUCKETS):
        self.one, self.shift = _crc_tables()
        self.buckets = buckets

    def _words(self, buf: np.ndarray, raw: bytes):
        word = _WORD[buf]
        edge = np.diff(np.concatenate([[False], word, [False]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        size = ends - starts
        order = np.argsort(-np.minimum(size, SHIFTS + 1).astype(np.int16), kind="stable")
        place, limit = starts[order], size[order]
        crc = np.full(len(starts), 0xFFFFFFFF, np.uint32)
        far = int(np.searchsorted(-limit, -SHIFTS, "left"))  # words longer than the tables
        live = len(limit)
        for p in range(int(min(limit[0], SHIFTS)) if len(limit) else 0):
            live = int(np.searchsorted(-limit[:live], -p, "left"))
            c = crc[far:live]
            crc[far:live] = self.one[(c ^ buf[place[far:live] + p]) & 0xFF] ^ (c >> 8)
        out = np.empty(len(starts), np.uint32)
        out[order] = ~crc
        long = order[:far]
        for i in long.tolist():
            out[i] = zlib.crc32(raw[starts[i]:ends[i]])
        return starts, ends, size, out, np.sort(long)

    def _joined(self, before: np.ndarray, at: np.ndarray, words) -> np.ndarray:
        """Checksums of ``before``, a blank and word ``at``."""
        starts, ends, size, crc, long, raw = words
        c = ~before
        c = ~(self.one[(c ^ np.uint32(32)) & 0xFF] ^ (c >> 8))
        n = np.minimum(size[at], SHIFTS)
        flat = self.shift.reshape(-1)
        row = n.astype(np.int64) * 1024
        out = (flat[row + (c & 0xFF)] ^ flat[row + 256 + ((c >> 8) & 0xFF)]
               ^ flat[row + 512 + ((c >> 16) & 0xFF)] ^ flat[row + 768 + (c >> 24)]) ^ crc[at]
        if len(long):
            for k in np.flatnonzero(np.isin(at, long)).tolist():
                out[k] = zlib.crc32(raw[starts[at[k]]:ends[at[k]]], int(c[k]))
        return out

    def runs(self, pieces: list[tuple[bytes, int]]):
        """For (text, skip) pieces: word counts, and per run length (positions of last words, buckets, piece).

        The first ``skip`` words of a piece were counted with an earlier one and only lead into runs.
        """
        raw = b"\0".join(p.lower() for p, _ in pieces)
        buf = np.frombuffer(raw, np.uint8)
        starts, ends, size, crc, long = self._words(buf, raw)
        first = np.cumsum([0, *[len(p) + 1 for p, _ in pieces]])[:-1]
        piece = np.searchsorted(first, starts, "right") - 1
        head = np.searchsorted(starts, first)  # a piece's first word
        index = np.arange(len(starts)) - head[piece]
        skip = np.array([s for _, s in pieces])[piece]
        counted = index >= skip
        words = (starts, ends, size, crc, long, raw)
        out, at, sums = [], np.arange(len(starts)), crc
        for n in range(LONGEST):
            if n:
                keep = index[at] >= n
                at = at[keep]
                # ``sums`` of the run that ends one word earlier
                sums = self._joined(whole[at - 1], at, words)
            whole = np.zeros(len(starts), np.uint32)
            whole[at] = sums
            own = at[counted[at]]
            out.append((piece[own], (whole[own] % np.uint32(self.buckets)).astype(np.int64)))
        return np.bincount(piece[counted], minlength=len(pieces)), out


def cut(text: bytes, size: int = PIECE) -> list[tuple[bytes, int]]:
    """A text as pieces of about ``size`` bytes, cut after words; each begins with the two words before it."""
    out, lo, lead = [], 0, b""
    while len(text) - lo > size:
        hi = lo + size
        while hi < len(text) and _WORD[ord(text[hi:hi + 1].lower())]:
            hi += 1
        part = text[lo:hi]
        out.append((lead + part, _count(lead)))
        lead, lo = _tail(lead + part), hi
    out.append((lead + text[lo:], _count(lead)))
    return out


def _count(lead: bytes) -> int:
    return len(lead.split())


def _tail(text: bytes) -> bytes:
    """The last ``LONGEST - 1`` words and a blank."""
    words, hi = [], len(text)
    is_word = _WORD.tolist()
    while len(words) < LONGEST - 1:
        while hi and not is_word[text[hi - 1:hi].lower()[0]]:
            hi -= 1
        if not hi:
            break
        lo = hi
        while lo and is_word[text[lo - 1:lo].lower()[0]]:
            lo -= 1
        words.append(text[lo:hi])
        hi = lo
    return b"".join(w + b" " for w in reversed(words))


def _groups(texts):
    """(rows, pieces) of an Arrow text column, about ``PIECE`` bytes a time."""
    rows, pieces, size = [], [], 0
    for i, t in enumerate(texts):
        for p in cut(t or b""):
            rows.append(i)
            pieces.append(p)
            size += len(p[0])
            if size >= PIECE:
                yield rows, pieces
                rows, pieces, size = [], [], 0
    if pieces:
        yield rows, pieces


def _counter(buckets: int):
    def run(batches):
        hasher, total = Hasher(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 512):
                for _, pieces in _groups(batch.column(0).slice(lo, 512).to_pylist()):
                    for _, found in hasher.runs(pieces)[1]:
                        total += np.bincount(found, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """Features of all texts by bucket; a task sends each bucket once, the driver gets one number a bucket."""
    src = pick(texts, text=text_col).select(F.col("text").cast("binary").alias("text"))
    out = [0] * buckets
    for r in map_arrow(src, _counter(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> list[int]:
    """A bucket's gain: a thousand times the log ratio of smoothed shares, floored."""
    own, aim, k = sum(corpus), sum(target), len(corpus)
    return [math.floor(1000 * math.log(float(t + 1) * float(own + k) / (float(s + 1) * float(aim + k))))
            for s, t in zip(corpus, target)]


def weighed(docs: DataFrame, gain: list[int], text_col: str = "text") -> DataFrame:
    """``docs`` with (_words, _features, _weight) of the text."""
    array = np.array(gain, np.int64)

    def setup():
        hasher = Hasher(len(array))

        def of(texts: pa.Array) -> list[pa.Array]:
            n = len(texts)
            words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
            for rows, pieces in _groups(texts.to_pylist()):
                at = np.array(rows)
                each, runs = hasher.runs(pieces)
                np.add.at(words, at, each)
                for piece, found in runs:
                    size = np.bincount(piece, minlength=len(rows))
                    ends = np.cumsum(size)
                    total = np.concatenate([[0], np.cumsum(array[found])])
                    np.add.at(features, at, size)
                    np.add.at(weight, at, total[ends] - total[ends - size])
            return [pa.array(words), pa.array(features), pa.array(weight)]

        return of

    return appended(docs, text_col, [("_words", "long"), ("_features", "long"), ("_weight", "long")], setup)


KEY = ("k0 long", "k1 long", "k2 long", "k3 long")  # -score, no id, id, features: the order of the draw


def _median(batches):
    """The lower median key of a partition and the number of its keys."""
    parts = [np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns]) for b in batches if b.num_rows]
    if parts:
        keys = np.concatenate(parts, axis=1)
        mid = keys[:, np.lexsort(keys[::-1])[(keys.shape[1] - 1) // 2]]
        yield pa.RecordBatch.from_arrays([*[pa.array([int(m)]) for m in mid], pa.array([keys.shape[1]])],
                                         names=["k0", "k1", "k2", "k3", "n"])


def _against(key: tuple, less: bool) -> Column:
    """Rows whose key is less (or greater) than ``key``."""
    own = F.struct("k0", "k1", "k2", "k3")
    other = F.struct(*[F.lit(int(k)).cast("long").alias(f"k{i}") for i, k in enumerate(key)])
    return own < other if less else own > other


def cutoff(keys: DataFrame, want: int, last_keys: int = LAST_KEYS) -> tuple | None:
    """The ``want``-th smallest key (from 1), exactly.

    A partition's median has half of its keys on either side, and half of the remaining
    keys lie in partitions whose median is at most the weighted median of the medians: so
    at least a quarter of the remaining keys goes each time.  The driver gets one key a
    partition, and at the end at most ``last_keys`` keys.
    """
    if want < 1:
        return None
    left = keys.select("k0", "k1", "k2", "k3")
    while True:
        mids = sorted((tuple(r)[:4], r["n"]) for r in map_arrow(left, _median, ", ".join(KEY) + ", n long").collect())
        total = sum(n for _, n in mids)
        if total < want:
            raise ValueError("fewer keys than wanted")
        if total <= last_keys:
            return tuple(sorted(tuple(r) for r in left.collect())[want - 1])
        seen = 0
        for pivot, n in mids:
            seen += n
            if 2 * seen >= total:
                break
        less, more = left.filter(_against(pivot, True)), left.filter(_against(pivot, False))
        counts = left.agg(F.count_if(_against(pivot, True)).alias("less"), F.count_if(_against(pivot, False)).alias("more")).first()
        if want <= counts["less"]:
            left = less
        elif want <= total - counts["more"]:
            return pivot
        else:
            left, want = more, want - (total - counts["more"])


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_col: str = "text", share: int = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
              buckets: int = BUCKETS) -> DataFrame:
    """(id, n_features, weight, score, rank): every document, ranks on the drawn ones only.

    Null, empty and wordless texts have no features and weight 0; a null id hashes as an
    empty one and comes last among ties; repeated rows are weighed and drawn one by one, and
    those alike in score and id are taken by fewer features (rows alike in all of it are
    interchangeable).  Empty tables give no rows; an empty target has no features.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    src = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"),
                                                      F.col("text").cast("binary").alias("text"))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = staged(weighed(src, gain).drop("text")
                    .select("id", F.col("_words").alias("words"), F.col("_features").alias("n_features"),
                            F.col("_weight").alias("weight"), (F.col("_weight") + noise).alias("score")), "weighed")
    keyed = scored.withColumns({"k0": -F.col("score"), "k1": F.col("id").isNull().cast("long"),
                                "k2": F.coalesce("id", F.lit(0)).cast("long"), "k3": F.col("n_features")})
    fit = F.col("words") >= min_words
    drawn = keyed.filter(fit).count() * share // 100
    last = cutoff(keyed.filter(fit), drawn)
    columns = ["id", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    won = fit & ~_against(last, False)
    winners = numbered(keyed.filter(won), ["k0", "k1", "k2", "k3"])
    # keys equal to the cutoff's may outnumber the places left
    rank = F.when(F.col("_number") <= drawn, F.col("_number"))
    return (keyed.filter(~won).select(*columns, F.lit(None).cast("long").alias("rank"))
            .unionByName(winners.select(*columns, rank.alias("rank"))))


def numbered(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``_number``: the place in the order of ``keys``, from 1.

    Sorted by ranges and written once; a range's rows are counted on from the ranges before
    it (one count a range).
    """
    at = staged(rows.sort(*keys).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    at = at.withColumn("_range", F.shiftright("_at", 33))
    sizes = at.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (at.join(F.broadcast(before), "_range")  # a row a partition
            .withColumn("_number", F.col("_before") + inside + 1).drop("_at", "_range", "_before"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op13: weights of the whole ``documents`` table towards ``benchmark``, and the draw of five per cent."""
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.withColumnRenamed("id", "doc_id")
