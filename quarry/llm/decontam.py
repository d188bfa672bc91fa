"""Benchmark decontamination: SimHash windows, multi-index Hamming blocks, exact weighted-shingle check."""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import map_arrow, pages_of, pick, staged, table

SHINGLE_WORDS = 5
MIN_SIMILARITY = 0.8
RADIUS = 24  # bits; shingle weights 0.8 alike differ in about 10 of 64 bits, 24 is over four standard deviations away
BLOCKS = 8  # of 8 bits: within the radius, some block differs in at most RADIUS // BLOCKS bits
ITEMS_AT_A_TIME = 20_000  # benchmark items of one length held against windows in one group,
WINDOWS_AT_A_TIME = 4_096  # windows in one group;
GROUP_WORDS = 4_000_000  # fewer of either where their words reach so many
FILTER_BITS = 20, 27  # least and most (16 MB) binary digits of the filter's size, 64 bits or more a shingle between them
# every ASCII byte but letters and digits becomes a blank; bytes of other characters stay
BLANKED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8: what is left between ASCII white space and punctuation."""
    return (text or "").lower().encode("utf-8", "replace").translate(BLANKED).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    """XXH64 of each word."""
    from xxhash import xxh64_digest

    return np.frombuffer(b"".join(map(xxh64_digest, words)), ">u8").astype(np.uint64)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hash of every run of ``size`` words, from the words' hashes; of all words if there are fewer."""
    if not len(words):
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out *= np.uint64(0x9E3779B97F4A7C15)  # odd: a polynomial in the words' hashes modulo 2**64
        out += words[k:k + n]
        out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def shingle_weights(words: list[bytes], size: int) -> Counter:
    """Every run of ``size`` words with its count, as text."""
    size = min(size, len(words))
    return Counter(b" ".join(words[i:i + size]) for i in range(len(words) - size + 1))


def simhash(hashes: np.ndarray) -> int:
    """64-bit fingerprint of a window's shingles, repeats counted (the shingles' weights)."""
    bits = (hashes[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    up = bits.sum(axis=0) * 2 > len(hashes)
    return int((up.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum()) if len(hashes) else 0


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard of shingles: shared weight over joint weight, a shingle weighing its count."""
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both) if both else 0.0


class BlockIndex:
    """Item fingerprints by each of ``blocks`` parts of 64 bits.

    A probe looks up its own value of a block with up to ``radius // blocks`` bits flipped;
    by the pigeonhole principle it meets every fingerprint within ``radius``.
    """

    def __init__(self, prints: list[int], radius: int = RADIUS, blocks: int = BLOCKS):
        self.prints, self.radius, self.blocks = prints, radius, blocks
        self.width = 64 // blocks
        if 64 % blocks:
            raise ValueError("blocks must divide 64")
        self.flips = [sum(1 << b for b in c) for n in range(radius // blocks + 1)
                      for c in combinations(range(self.width), n)]
        self.tables: list[dict[int, list[int]]] = [{} for _ in range(blocks)]
        for i, p in enumerate(prints):
            for k in range(blocks):
                self.tables[k].setdefault(self._part(p, k), []).append(i)

    def _part(self, p: int, k: int) -> int:
        return (p >> (k * self.width)) & ((1 << self.width) - 1)

    def within(self, p: int) -> list[int]:
        """Positions of all fingerprints at ``radius`` or less from ``p``."""
        met: set[int] = set()
        for k, tab in enumerate(self.tables):
            own = self._part(p, k)
            for flip in self.flips:
                met.update(tab.get(own ^ flip, ()))
        return sorted(i for i in met if (self.prints[i] ^ p).bit_count() <= self.radius)


def places(hashes: np.ndarray, digits: int, length: int = 0) -> np.ndarray:
    """Bit of each shingle hash in a filter of ``2**digits`` bits, for items of ``length`` words (0: of any)."""
    mixed = (hashes ^ np.uint64(length * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - digits)).astype(np.int64)


def is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def item_rows(benchmark: DataFrame, name: str = "decontam-items") -> DataFrame:
    """(item_id, n, words, item): a row for each item with a word; its words in normal form, their number and digest."""
    def each(batches):
        for ids, texts in pages_of(batches, "id", "text"):
            words = [words_of(t) for t in texts]
            rows = [(i, len(w), b" ".join(w)) for i, w in zip(ids, words) if w]
            yield _batch(rows, (pa.int64(), pa.int64(), pa.binary()), ("item_id", "n", "words"))

    src = pick(benchmark, id="item_id", text="text").filter("text is not null").selectExpr("cast(id as long) id", "text")
    rows = map_arrow(src, each, "item_id long, n long, words binary")
    return staged(rows.withColumn("item", F.md5("words")), name)


def shingle_filter(items: DataFrame, size: int, digits: int) -> bytes:
    """Bitmap of the items' shingles, alone and with the item's length: ``2**digits`` bits, whatever the items."""
    def each(batches):
        for ns, words in pages_of(batches, "n", "words"):
            found = [np.zeros(0, np.int64)]
            for n, w in zip(ns, words):
                h = shingle_hashes(word_hashes(w.split()), size)
                found += [places(h, digits), places(h, digits, n)]
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)), pa.int64())], names=["at"])

    at = map_arrow(items, each, "at long")
    parts = (at.groupBy(F.expr("at div 32768").alias("part"))
             .agg(F.bitmap_construct_agg(F.expr("at % 32768")).alias("bits")).collect())
    out = bytearray(2**digits // 8)
    for r in parts:
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = r["bits"]
    return bytes(out)


def _batch(rows, kinds, names):
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], names=list(names))


def windows_of(text: str | None, lengths: list[int], bits: np.ndarray, digits: int, size: int, least: float):
    """(n, words) of every different window of the text that may be ``least`` alike to an item of n words.

    Such a window shares ``need`` shingles or more with one item of that length, and the filter
    passes every shingle of such items.  A text shorter than an item is one window.
    """
    from xxhash import xxh3_128_digest

    words = words_of(text)
    each = word_hashes(words)
    for own in sorted({min(size, n) for n in lengths}):
        if len(words) < own:
            continue
        hashes = shingle_hashes(each, own)
        at = np.flatnonzero(is_set(bits, places(hashes, digits)))
        for n in lengths if len(at) else ():
            if min(size, n) != own:
                continue
            span = n - own + 1
            width = min(span, len(hashes))
            # weights m and m' that are s alike share s(m + m') / (1 + s) or more
            need = max(1, int(np.ceil(least * (span + width) / (1 + least) - 1e-9)))
            if len(at) < need:
                break  # longer items need more
            shared = at[is_set(bits, places(hashes[at], digits, n))]
            if len(shared) < need:
                continue
            count = np.zeros(len(hashes) + 1, np.int64)
            count[shared + 1] = 1
            count = np.cumsum(count)
            done = set()
            for s in np.flatnonzero(count[width:] - count[:len(count) - width] >= need).tolist():
                key = xxh3_128_digest(hashes[s:s + width])
                if key not in done:
                    done.add(key)
                    yield n, b" ".join(words[s:s + n])


def document_windows(texts: DataFrame, lengths: list[int], bits: bytes, digits: int, size: int, least: float) -> DataFrame:
    """(digest, n, words): the windows of every text (columns ``digest``, ``text``), in one pass."""
    kinds, names = (pa.string(), pa.int64(), pa.binary()), ("digest", "n", "words")

    def each(batches):
        table, rows, held = np.frombuffer(bits, np.uint8), [], 0
        for digests, texts in pages_of(batches, "digest", "text"):
            for d, t in zip(digests, texts):
                for n, words in windows_of(t, lengths, table, digits, size, least):
                    rows.append((d, n, words))
                    held += len(words)
                    if held > 1 << 22:
                        yield _batch(rows, kinds, names)
                        rows, held = [], 0
        yield _batch(rows, kinds, names)

    return map_arrow(texts, each, "digest string, n long, words binary")


def alike(items: list[tuple[str, bytes]], windows: list[tuple[str, bytes]], size: int, least: float, radius: int):
    """(window, item, similarity) of keyed windows against keyed items of one length, through the items' block index."""
    prints = [simhash(shingle_hashes(word_hashes(w.split()), size)) for _, w in items]
    index = BlockIndex(prints, radius)
    weights: dict[int, Counter] = {}
    for window, w in windows:
        words = w.split()
        near = index.within(simhash(shingle_hashes(word_hashes(words), size)))
        own = shingle_weights(words, size) if near else None
        for k in near:
            if k not in weights:
                weights[k] = shingle_weights(items[k][1].split(), size)
            similarity = weighted_similarity(own, weights[k])
            if similarity >= least:
                yield window, items[k][0], similarity


def pairs_of(texts: DataFrame, items: DataFrame, size: int, least: float, radius: int, items_at_a_time: int) -> DataFrame:
    """(digest, item, similarity): the best window of each text against each item that it holds, by their digests.

    Items and windows meet in groups of one length, of bounded size on both sides: a
    length with many items is dealt to several groups, one with many windows as well.
    Only the lengths with their counts and the filter's bits pass through the driver.
    """
    spark = texts.sparkSession
    each = items.select("n", "words", "item").distinct()
    counted = {r["n"]: r["count"] for r in each.groupBy("n").count().collect()}
    total = sum(c * max(1, n - size + 1) for n, c in counted.items())
    digits = min(max(FILTER_BITS[0], (64 * total).bit_length()), FILTER_BITS[1])
    bits = shingle_filter(each.select("n", "words"), size, digits)
    found = staged(document_windows(texts, sorted(counted), bits, digits, size, least)
                   .withColumn("window", F.md5("words")), "decontam-windows")
    different = found.select("n", "words", "window").distinct()
    held = {r["n"]: r["count"] for r in different.groupBy("n").count().collect()}
    deals = spark.createDataFrame(
        [(n, -(-counted[n] // max(1, min(items_at_a_time, GROUP_WORDS // n))),
          -(-c // max(1, min(WINDOWS_AT_A_TIME, GROUP_WORDS // n)))) for n, c in held.items()],
        "n long, items long, windows long")
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    dealt = lambda count: F.pmod(F.xxhash64("words"), F.col(count))
    left = each.join(deals, "n").select("n", "words", F.col("item").alias("key"), dealt("items").alias("a"),
                                        every("windows").alias("b"))
    right = different.join(deals, "n").select("n", "words", F.col("window").alias("key"), every("items").alias("a"),
                                              dealt("windows").alias("b"))

    def meet(one: pa.Table, other: pa.Table) -> pa.Table:
        n = (one if one.num_rows else other).column("n")[0].as_py()
        keyed = [list(zip(t.column("key").to_pylist(), t.column("words").to_pylist())) for t in (one, other)]
        rows = [(n, *r) for r in alike(*keyed, size, least, radius)]
        return pa.Table.from_batches([_batch(rows, (pa.int64(), pa.string(), pa.string(), pa.float64()),
                                             ("n", "window", "item", "similarity"))])

    matches = (left.groupBy("n", "a", "b").cogroup(right.groupBy("n", "a", "b"))
               .applyInArrow(meet, "n long, window string, item string, similarity double"))
    return staged(found.select("digest", "n", "window").join(staged(matches, "decontam-matches"), ["n", "window"])
                  .groupBy("digest", "item").agg(F.max("similarity").alias("similarity")), "decontam-pairs")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 size: int = SHINGLE_WORDS, min_similarity: float = MIN_SIMILARITY, radius: int = RADIUS,
                 items_at_a_time: int = ITEMS_AT_A_TIME) -> DataFrame:
    """(id, item_id, similarity): benchmark items that a document holds, one row a pair.

    Null, empty or wordless texts hold nothing; repeated items and documents give a row each time.
    """
    src = pick(docs, id=id_col, text=text_col).withColumn("digest", F.md5("text"))
    items = item_rows(benchmark)
    pairs = pairs_of(src.select("digest", "text"), items, size, min_similarity, radius, items_at_a_time)
    return (src.select(F.col("id").cast("long").alias("id"), "digest").join(pairs, "digest")
            .join(items.select("item_id", "item"), "item").select("id", "item_id", "similarity"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = SHINGLE_WORDS,
               min_similarity: float = MIN_SIMILARITY, radius: int = RADIUS,
               items_at_a_time: int = ITEMS_AT_A_TIME) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item, all columns as they are (rows without a text stay)."""
    names = docs.columns
    src = docs.toDF(*[f"_d{i}" for i in range(len(names))]).withColumn("_digest", F.md5(f"_d{names.index('text')}"))
    texts = src.select(F.col("_digest").alias("digest"), F.col(f"_d{names.index('text')}").alias("text"))
    pairs = pairs_of(texts, item_rows(benchmark), size, min_similarity, radius, items_at_a_time)
    gone = pairs.select(F.col("digest").alias("_digest")).distinct()
    return src.join(gone, "_digest", "left_anti").drop("_digest").toDF(*names)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op8: every (document, benchmark item) pair of the whole ``documents`` and ``benchmark`` tables."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.round("similarity", 9).alias("similarity"))
