"""Substring deduplication by sliding spans of consecutive sentences."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import appended, map_arrow, pages_of, pick, staged, table

RUN = 4  # consecutive sentences in a span,
ENOUGH_WORDS = 16  # fewer (two at least) where they reach so many words,
MIN_WORDS = 16  # more where it takes them to reach so many
LONG = 12  # a sentence of more words is parted after each word that has the least hash of EVERY words in a row
EVERY = 8  # (the last of equal ones), so no piece is longer and 2 * EVERY - 1 words from a passage's edge all cuts are its own

# Sentences end at . ! ? , ; : and line breaks; other ASCII punctuation and blanks only part words.
ENDS = b".!?,;:\n\r"
PARTED = bytes(10 if c in ENDS else c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 2**64)


def sentences(text: str | None) -> tuple[bytes, np.ndarray, np.ndarray, list[bytes]]:
    """(UTF-8 bytes, byte offset where each sentence starts, words of each, normal form of each).

    Only sentences with a word count; what stands between two belongs to the first.
    Every boundary depends on the EVERY - 1 words before and after it only, and on whether the
    sentence is longer than LONG.  So a passage is cut alike wherever it stands, but for 15
    words at most at either edge: any passage of 50 words holds a span, whatever its words.
    """
    raw = (text or "").encode("utf-8", "replace")
    parts = raw.lower().translate(PARTED).split(b"\n")
    words = [p.split() for p in parts]
    starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
    counts = np.fromiter(map(len, words), np.int64, len(words))
    if len(counts) and counts.max() > LONG:
        starts, counts, words = _parted(parts, starts.tolist(), words)
    kept = np.flatnonzero(counts)
    return raw, starts[kept], counts[kept], [b" ".join(words[i]) for i in kept.tolist()]


def _parted(parts: list[bytes], starts: list[int], words: list[list[bytes]]):
    """The sentences with the long ones parted, again at places that depend on the words there only."""
    from xxhash import xxh64_intdigest

    long = [own for own in words if len(own) > LONG]
    h = np.fromiter((xxh64_intdigest(w) for own in long for w in own), np.uint64)
    part = np.repeat(np.arange(len(long)), [len(own) for own in long])
    windows = np.flatnonzero(part[:len(h) - EVERY + 1] == part[EVERY - 1:]) + EVERY - 1  # the last word of each
    cut = np.zeros(len(h), bool)
    least = windows
    for back in range(1, EVERY):
        least = np.where(h[windows - back] < h[least], windows - back, least)
    cut[least] = True
    cuts, seen = cut.tolist(), 0
    new_starts, new_words = [], []
    for part, start, own in zip(parts, starts, words):
        if len(own) <= LONG:
            new_starts.append(start)
            new_words.append(own)
            continue
        lo, at = 0, 0
        for i, w in enumerate(own):
            here = part.index(w, at)
            at = here + len(w)
            if i == lo:
                new_starts.append(start + (here if lo else 0))
            if i + 1 == len(own) or cuts[seen + i]:
                new_words.append(own[lo:i + 1])
                lo = i + 1
        seen += len(own)
    return np.array(new_starts), np.array([len(w) for w in new_words]), new_words


def powers(base: int, n: int) -> np.ndarray:
    """base**0 to base**(n - 1) modulo 2**64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def spans(counts: np.ndarray, normal: list[bytes], run: int = RUN, enough: int = ENOUGH_WORDS,
          least: int = MIN_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, number of sentences) of every run of consecutive sentences."""
    from xxhash import xxh64_digest

    n = len(counts)
    if n < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.frombuffer(b"".join(map(xxh64_digest, normal)), ">u8").astype(np.uint64)
    total = np.concatenate(([0], np.cumsum(counts)))
    first = np.arange(n)
    reach = lambda words: np.searchsorted(total, total[:-1] + words, side="left")
    stop = np.maximum(np.minimum(first + run, np.maximum(first + 2, reach(enough))), reach(least))
    first, stop = first[stop <= n], stop[stop <= n]
    # prefix sums of h[i] / BASE**i; a difference times BASE**first depends on the run's own sentences only
    down, up = powers(INVERSE, n), powers(BASE, n)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * down, dtype=np.uint64)))
    out = (prefix[stop] - prefix[first]) * up[first]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out += (stop - first).astype(np.uint64)
    return out ^ (out >> np.uint64(29)), first, stop - first


def span_rows(docs: DataFrame, run: int, enough: int, least: int) -> DataFrame:
    """(hash, id, of, first, size, again): every span of every text (``of``: its hash); ``again``: seen before in the same text."""
    def each(batches):
        for ids, of, texts in pages_of(batches, "id", "of", "text"):
            cols: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for i, o, t in zip(ids, of, texts):
                _, _, counts, normal = sentences(t)
                h, first, size = spans(counts, normal, run, enough, least)
                if not len(h):
                    continue
                again = np.ones(len(h), bool)
                again[np.unique(h, return_index=True)[1]] = False
                for c, v in zip(cols, (h.view(np.int64), np.full(len(h), i), np.full(len(h), o), first.astype(np.int32),
                                       size.astype(np.int32), again)):
                    c.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c), k) if c else pa.array([], k) for c, k in zip(cols, kinds)],
                names=["hash", "id", "of", "first", "size", "again"])

    return map_arrow(docs, each, "hash long, id long, of long, first int, size int, again boolean")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN,
                 enough: int = ENOUGH_WORDS, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with the sentences of repeated spans removed from ``text_col``, and ``n_removed`` (sentences).

    A span repeats if its hash occurs twice anywhere; the occurrence in the document of
    smallest id (the first one in it) stays, sentences under any other are removed.  Null
    texts stay null, texts without a span stay as they are.  Rows without an id keep their
    text; rows that repeat an id and its text count as one document, different texts under
    one id as documents in the order of their hashes.

    The hashes are counted by an aggregate with a map-side part, so a span that many
    documents share sends one row a task; only hashes that repeat are joined back, from a
    written table, which lets adaptive execution split a hot one.
    """
    src = pick(docs, id=id_col, text=text_col).filter("id is not null")
    src = src.select(F.col("id").cast("long").alias("id"), F.xxhash64("text").alias("of"), "text")
    clash = not src.groupBy("id").agg(F.min("of").alias("a"), F.max("of").alias("b")).filter("a <> b").isEmpty()
    of = F.xxhash64 if clash else lambda _: F.lit(0).cast("long")
    # a least struct takes a sorting aggregate, so only where ids need it
    owner, later = ((F.min(F.struct("id", "of")), "again or struct(id, of) > owner") if clash
                    else (F.min("id"), "again or id > owner"))
    every = span_rows(src.withColumn("of", of("text")), run, enough, least)
    repeated = staged(every.groupBy("hash").agg(F.count(F.lit(1)).alias("n"), owner.alias("owner"))
                      .filter("n > 1").select("hash", "owner"), "substring-repeated")
    covered = (every.join(repeated, "hash").filter(later)
               .groupBy("id", "of").agg(F.collect_list(F.struct("first", "size")).alias("_cover")))
    names = docs.columns
    plain = docs.toDF(*[f"_d{i}" for i in range(len(names))])
    key, text = f"_d{names.index(id_col)}", f"_d{names.index(text_col)}"
    joined = plain.join(covered.withColumnsRenamed({"id": "_id", "of": "_of"}),
                        (F.col(key) == F.col("_id")) & (of(text) == F.col("_of")), "left").drop("_id", "_of")
    both = joined.withColumn("_in", F.struct(F.col(text).alias("text"), F.col("_cover").alias("cover"))).drop("_cover")
    cut = appended(both, "_in", [("_text", "string"), ("n_removed", "int")], _cutter)
    return cut.select(*[F.col("_text" if f"_d{i}" == text else f"_d{i}").alias(n) for i, n in enumerate(names)
                        if n != "n_removed"], "n_removed")


def _cutter():
    def of(column):
        texts, removed = [], []
        for row in column.to_pylist():
            text, cover = row["text"], row["cover"]
            if not cover:
                texts.append(text)
                removed.append(0)
                continue
            raw, starts, counts, _ = sentences(text)
            gone = np.zeros(len(counts) + 1, np.int64)
            for c in cover:
                gone[c["first"]] += 1
                gone[c["first"] + c["size"]] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            edges = np.concatenate((starts, [len(raw)]))
            edges[0] = 0
            texts.append(b"".join(raw[a:b] for a, b, g in zip(edges, edges[1:], gone) if not g).decode("utf-8", "replace"))
            removed.append(int(gone.sum()))
        return [pa.array(texts, pa.string()), pa.array(removed, pa.int32())]

    return of


def op5_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op5 over the whole ``documents`` table: each text without the sentences of repeated spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return deduplicated(docs).withColumn("n_chars", F.length("text").cast("long"))
