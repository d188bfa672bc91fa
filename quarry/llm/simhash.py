"""SimHash fingerprints and near duplicates within a Hamming radius, found by a vantage-point tree."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import appended, hash_order, map_arrow, pages_of, pick, slots, staged, table
from quarry.llm.components import min_labels

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
LEAVES = 16  # of the tree, while none holds more than LEAF_ROWS: more leaves mean more copies of a fingerprint
LEAF_ROWS = 1 << 22  # distinct fingerprints of 8 bytes a leaf should hold at most, about 200 MB while it is searched
LEAST_LEAF = 4096
SAMPLE_ROWS = 20_000  # the tree is fitted on so many distinct fingerprints,
SAMPLE_PER_LEAF = 64  # or on so many for each leaf
SHORT_RUN = 64  # fingerprints with an equal part that are compared pair by pair
HASHES_AT_A_TIME = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of a text as an unsigned integer.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  A bit is 1 if it
    is set in more than half of the shingles' XXH64 values, repeats counted.  Fewer words
    than a shingle: the whole sequence is the only shingle.  No word (or null): zero.
    """
    from xxhash import xxh64_digest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) < shingle:
        return int.from_bytes(xxh64_digest(line, seed), "big")
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    begin = np.concatenate(([0], end[:-1] + 1))[: len(words) - shingle + 1]
    end = end[shingle - 1:]
    total = np.zeros(64, np.int64)
    for lo in range(0, len(begin), HASHES_AT_A_TIME):
        hi = lo + HASHES_AT_A_TIME
        digests = b"".join([xxh64_digest(line[a:b], seed)
                            for a, b in zip(begin[lo:hi].tolist(), end[lo:hi].tolist())])
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        total += bits.sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(total * 2 > len(begin)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, fp): one row per input row; ``fp`` is the fingerprint as a signed BIGINT."""
    src = pick(docs, id=id_col, text=text_col).withColumn("id", F.col("id").cast("long"))

    def run(batches):
        for ids, texts in pages_of(batches, "id", "text"):
            fps = np.array([fingerprint(t, shingle, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(fps)], names=["id", "fp"])

    return map_arrow(src, run, "id long, fp long")


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b)).astype(np.int16)


def vantage_tree(sample: np.ndarray, leaves: int) -> list[tuple[int, int] | None]:
    """A binary heap of (vantage fingerprint, radius); None marks a leaf.

    Each node's vantage point is the sample point with the widest spread of distances
    among a few tried; its radius is the median distance, so a node halves its points.
    """
    depth = max(0, math.ceil(math.log2(max(1, leaves))))
    nodes: list[tuple[int, int] | None] = [None] * (2 ** (depth + 1) - 1)

    def grow(at: int, level: int, points: np.ndarray) -> None:
        if level == depth or len(points) < 8:
            return
        tried = points[:: max(1, len(points) // 8)][:8]
        spreads = [_distance(points, v).std() for v in tried]
        vantage = tried[int(np.argmax(spreads))]
        d = _distance(points, vantage)
        radius = int(np.median(d))
        if d.max() <= radius:  # ties: cut below the largest distance instead
            radius = int(d.max()) - 1
        if (d <= radius).sum() in (0, len(d)):
            return
        nodes[at] = (int(vantage), radius)
        grow(2 * at + 1, level + 1, points[d <= radius])
        grow(2 * at + 2, level + 1, points[d > radius])

    grow(0, 0, sample)
    return nodes


def route(nodes: list, points: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of point, leaf, is home): every leaf that a point must be held against.

    A point lives in one leaf.  By the triangle bound, a point within ``reach`` of one
    beyond the radius has a distance to the vantage point of more than radius - reach;
    such points also visit the far side.  Of two points that live on either side of a
    radius the inner one visits, so each close pair meets in the outer one's leaf.
    Visitors go on to each child whose ring their ball touches.
    """
    out: list[tuple[np.ndarray, int, bool]] = []
    work = [(0, np.arange(len(points)), np.ones(len(points), bool))]
    while work:
        at, idx, home = work.pop()
        if not len(idx):
            continue
        node = nodes[at] if at < len(nodes) else None
        if node is None:
            out.append((idx, at, home))
            continue
        vantage, radius = node
        d = _distance(points[idx], np.uint64(vantage))
        near = np.where(home, d <= radius, d - reach <= radius)
        far = np.where(home, (d > radius) | (d + reach > radius), d + reach > radius)
        work.append((2 * at + 1, idx[near], home[near]))
        work.append((2 * at + 2, idx[far], (home & (d > radius))[far]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return (np.concatenate([i for i, _, _ in out]),
            np.concatenate([np.full(len(i), leaf, np.int64) for i, leaf, _ in out]),
            np.concatenate([h for _, _, h in out]))


class _Forest:
    """Union-find over positions, with whole arrays of pairs at a time."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            nxt = self.up[self.up]
            if np.array_equal(nxt, self.up):
                return self.up
            self.up = nxt

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            r = self.roots()
            lo, hi = np.minimum(r[a], r[b]), np.maximum(r[a], r[b])
            keep = lo != hi
            if not keep.any():
                return
            a, b = a[keep], b[keep]
            np.minimum.at(self.up, hi[keep], lo[keep])


def _by_rings(points: np.ndarray, reach: int, forest: _Forest) -> None:
    """Pairs of one leaf: sorted by the distance to a vantage point, compared within ``reach`` rings."""
    d = _distance(points, points[0])
    order = np.argsort(d, kind="stable")
    d, sorted_points = d[order], points[order]
    stop = np.searchsorted(d, d + reach, side="right")
    step = 256
    for lo in range(0, len(points), step):
        hi = min(lo + step, len(points))
        for left in range(lo, int(stop[hi - 1]), 16_384):
            right = min(left + 16_384, int(stop[hi - 1]))
            i, j = np.nonzero(_distance(sorted_points[lo:hi, None], sorted_points[None, left:right]) <= reach)
            forest.link(order[i + lo], order[j + left])


def _by_flips(points: np.ndarray, reach: int, forest: _Forest) -> None:
    """The same pairs by flipping up to ``reach`` bits and looking the result up: linear in the leaf."""
    from itertools import combinations

    order = np.argsort(points, kind="stable")
    keys = points[order]
    for n in range(reach + 1):
        for bits in combinations(range(64), n):
            mask = np.uint64(sum(1 << b for b in bits))
            wanted = keys ^ mask
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            hit = keys[at] == wanted
            forest.link(order[hit], order[at[hit]])


def _by_parts(points: np.ndarray, reach: int, forest: _Forest) -> None:
    """The same pairs by parts: of ``reach + 1`` parts of the bits, two such fingerprints share one.

    Sorted by each part in turn, short runs of an equal part are compared pair by pair, a long
    run as a leaf of its own, by rings or flips."""
    cuts = np.linspace(0, 64, reach + 2).astype(int)
    flips = sum(math.comb(64, n) for n in range(reach + 1))
    for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        part = (points >> np.uint64(lo)) & np.uint64((1 << (hi - lo)) - 1)
        order = np.argsort(part, kind="stable")
        part = part[order]
        starts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        size = np.diff(np.append(starts, len(part)))
        short = np.repeat(size <= SHORT_RUN, size)
        for step in range(1, int(size[size <= SHORT_RUN].max(initial=1))):
            near = np.flatnonzero((part[step:] == part[:-step]) & short[step:])
            a, b = order[near], order[near + step]
            hit = _distance(points[a], points[b]) <= reach
            forest.link(a[hit], b[hit])
        for run in np.flatnonzero(size > SHORT_RUN).tolist():
            own = order[starts[run]:starts[run] + size[run]]
            inner = _Forest(len(own))
            (_by_flips if len(own) > 40 * flips else _by_rings)(points[own], reach, inner)
            forest.link(own, own[inner.roots()])


def linked(points: np.ndarray, reach: int) -> np.ndarray:
    """Root position of each point's component at distance ``reach`` or less (exact at any size)."""
    forest = _Forest(len(points))
    if len(points) > 1:
        _by_parts(points, reach, forest)
    return forest.roots()


def leaf_size(n: int) -> int:
    """Distinct fingerprints a leaf should hold, of ``n`` in all."""
    return min(LEAF_ROWS, max(LEAST_LEAF, -(-n // LEAVES)))


def fingerprint_groups(distinct: DataFrame, max_bits: int = MAX_BITS, leaf_rows: int | None = None,
                       sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(node, grp): which distinct fingerprints (column ``fp``) link inside each leaf of the tree.

    The tree is fitted on a sample of ``SAMPLE_PER_LEAF`` fingerprints a leaf (``sample_rows`` at
    least); every fingerprint is routed.  A leaf returns one row per linked fingerprint, never pairs.
    """
    spark = distinct.sparkSession
    n = distinct.count()
    leaf_rows = leaf_rows or leaf_size(n)
    sample_rows = max(sample_rows, SAMPLE_PER_LEAF * -(-n // leaf_rows))
    sample = [r[0] for r in distinct.select("fp").orderBy(hash_order(F.col("fp")), "fp").limit(sample_rows).collect()]
    nodes = vantage_tree(np.array(sample, np.int64).view(np.uint64), -(-n // leaf_rows))

    def send(batches):
        for batch in batches:
            points = batch.column("fp").to_numpy(zero_copy_only=False)
            idx, leaf, _ = route(nodes, points.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(points[idx]), pa.array(leaf)], names=["fp", "leaf"])

    def links(t: pa.Table) -> pa.Table:
        points = t.column("fp").to_numpy().view(np.uint64)
        root = linked(points, max_bits)
        size = np.bincount(root, minlength=len(points))[root]
        keep = size > 1
        leaf = t.column("leaf")[0].as_py()
        grp = [f"{leaf}:{r}" for r in root[keep].tolist()]
        return pa.table({"node": pa.array(points[keep].view(np.int64)), "grp": pa.array(grp, pa.string())})

    shards = max(slots(spark), min(2 * (-(-n // leaf_rows)), 32 * slots(spark)))
    return (map_arrow(distinct.select("fp"), send, "fp long, leaf long")
            .repartition(shards, "leaf").groupBy("leaf").applyInArrow(links, "node long, grp string"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, seed: int = SEED,
                    leaf_rows: int | None = None) -> DataFrame:
    """(id, fp, component): one row per input row; rows whose fingerprints differ in at most
    ``max_bits`` bits are linked, ``component`` is the smallest id reachable.

    Null or empty text: fingerprint zero, linked like any other.  A null id keeps its row
    and counts as larger than any id (a component of null ids only has a null component).
    Repeated rows are returned as often as they come in.  An empty table gives an empty result.
    Copies collapse to one fingerprint before the search (an aggregate with a map-side part).
    """
    return _near_duplicates(docs, id_col, text_col, shingle, max_bits, seed, leaf_rows)[0]


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                     seed: int = SEED, leaf_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of ``near_duplicates``, and (node, grp): the fingerprints that link."""
    fps = staged(fingerprints(docs, id_col, text_col, shingle, seed), "simhash-fp")
    distinct = staged(fps.groupBy("fp").agg(F.min("id").alias("label")), "simhash-distinct")
    found = fingerprint_groups(distinct, max_bits, leaf_rows)
    low = min_labels(found, distinct.select(F.col("fp").alias("node"), "label"))
    component = staged(distinct.join(low.select(F.col("node").alias("fp"), F.col("label").alias("low")), "fp", "left")
                       .select("fp", F.coalesce("low", "label").alias("component")), "simhash-component")
    return fps.join(component, "fp").select("id", "fp", "component"), found


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each near-duplicate group; all columns stay.

    Rows of one id become one row if their fingerprints link; others of one id are decided
    each on its own.  Rows without an id stay, as nothing can name them.
    """
    rows, groups = _near_duplicates(docs, id_col, text_col, **options)
    found = staged(rows, "simhash-found")
    key = F.col(f"`{id_col}`")
    repeated = staged(found.filter("id is not null").groupBy("id")
                      .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).filter("n > 1")
                      .select(F.col("id").alias("_again"), (F.col("a") != F.col("b")).alias("_clash")), "simhash-again")
    clash = repeated.filter("_clash").select("_again")
    clashing = not clash.isEmpty()
    plain = docs.join(clash, key == F.col("_again"), "left_anti") if clashing else docs
    gone = staged(found.filter("id <> component").select(F.col("id").alias("_gone")).distinct(), "simhash-gone")
    kept = plain.join(gone, key == F.col("_gone"), "left_anti")
    if repeated.isEmpty():
        return kept
    again = repeated.filter("not _clash").select("_again")
    once = kept.join(again, key == F.col("_again"), "left_semi").dropDuplicates([id_col])
    kept = kept.join(again, key == F.col("_again"), "left_anti").unionByName(once)
    if not clashing:
        return kept
    several = _one_per_group_of_id(docs.join(clash, key == F.col("_again"), "left_semi"), found, clash, groups,
                                   id_col, text_col, options)
    return kept.unionByName(several)


def _one_per_group_of_id(docs: DataFrame, found: DataFrame, clash: DataFrame, groups: DataFrame, id_col: str,
                         text_col: str, options: dict) -> DataFrame:
    """The rows to keep of ids with several fingerprints: of each id and component that it is the smallest id of, the
    one with the least fingerprint.  A component is told by its least fingerprint."""
    own = found.join(clash, F.col("id") == F.col("_again"), "left_semi").filter("id = component").select("id", "fp").distinct()
    nodes = found.select(F.col("fp").alias("node"), F.col("fp").alias("label")).distinct()
    roots = min_labels(groups, nodes).select(F.col("node").alias("fp"), F.col("label").alias("root"))
    stay = staged(own.join(roots, "fp", "left").groupBy("id", F.coalesce("root", "fp").alias("root"))
                  .agg(F.min("fp").alias("_stay")).select(F.col("id").alias("_owner"), "_stay"), "simhash-stay")
    names = docs.columns
    key, text = f"_d{names.index(id_col)}", f"_d{names.index(text_col)}"

    def setup():
        shingle, seed = options.get("shingle", SHINGLE_WORDS), options.get("seed", SEED)
        return lambda column: [pa.array(np.array([fingerprint(t, shingle, seed) for t in column.to_pylist()],
                                                 np.uint64).view(np.int64))]

    with_fp = appended(docs.toDF(*[f"_d{i}" for i in range(len(names))]), text, [("_fp", "long")], setup)
    kept = with_fp.join(stay, (F.col(key) == F.col("_owner")) & (F.col("_fp") == F.col("_stay")), "left_semi")
    return kept.dropDuplicates([key, "_fp"]).drop("_fp").toDF(*names)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op7 over the whole ``documents`` table (see ``near_duplicates``)."""
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE_WORDS, max_bits=MAX_BITS)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component").alias("component_id"))
