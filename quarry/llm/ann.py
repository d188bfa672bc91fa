"""Nearest neighbours of a stated query set: int8 product tiles with error bounds, exact scores, heap merges."""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappush, heappushpop

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import pick, slots, staged, table
from quarry.session import ensure_importable

TOP = 20
QUERY_STEP = 20
QUERY_ROWS = 2048  # queries a tile
CANDIDATE_ROWS = 8192  # candidates a tile
INT8 = 127


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and the lengths of the vectors' rounded forms and of their rounding errors.

    Vectors too small or too large for that in doubles get zero codes and an error without bound,
    so all their pairs survive.
    """
    with np.errstate(all="ignore"):
        scale = np.abs(vectors).max(axis=1) / INT8
        codes = np.rint(vectors / scale[:, None])
        rounded = codes * scale[:, None]
        length, error = np.linalg.norm(rounded, axis=1), np.linalg.norm(vectors - rounded, axis=1)
    lost = ~(np.isfinite(length) & np.isfinite(error) & (scale >= np.finfo(float).tiny))
    codes[lost], scale[lost], length[lost], error[lost] = 0, 0.0, 0.0, np.inf
    return codes.astype(np.int8), scale, length, error


def exact_scores(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in component order."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        total += query[j] * rows[:, j]
    return total


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray,
         top: int = TOP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, id, score): the ``top`` best rows of one tile for each query, exact.

    The product of the int8 codes is exact in the float type used; times the scales it misses
    the true product by at most |q'||e| + |d||c| (q', c': rounded, d, e: rounding errors,
    |c| <= |c'| + |e|).  A pair survives if its upper bound reaches the ``top``-th best lower
    bound of its query; survivors are scored again on the original vectors and kept in a heap.
    """
    qc, qs, qn, qe = quantised(queries)
    cc, cs, cn, ce = quantised(rows)
    wide = np.float32 if queries.shape[1] * INT8 * INT8 < 2**24 else np.float64
    out_q, out_i, out_s = [], [], []
    codes = cc.astype(wide).T
    for lo in range(0, len(queries), 128):
        hi = min(lo + 128, len(queries))
        with np.errstate(all="ignore"):
            near = (qc[lo:hi].astype(wide) @ codes).astype(np.float64) * qs[lo:hi, None] * cs[None, :]
            slack = qn[lo:hi, None] * ce[None, :] + qe[lo:hi, None] * (cn + ce)[None, :]
            slack = slack * (1 + 1e-9) + np.abs(near) * 1e-12 + 1e-300
            low, high = near - slack, near + slack
        own = query_ids[lo:hi, None] == ids[None, :]
        known = np.isfinite(low) & np.isfinite(high)  # a pair without bounds survives
        low = np.where(own | ~known, -np.inf, low)
        high = np.where(own, -np.inf, np.where(known, high, np.inf))
        k = min(top, len(ids))
        floor = np.partition(low, len(ids) - k, axis=1)[:, len(ids) - k]
        for r in range(hi - lo):
            kept = np.flatnonzero((high[r] >= floor[r]) & ~own[r])
            heap: list[tuple[float, int]] = []
            for s, i in zip(exact_scores(queries[lo + r], rows[kept]).tolist(), (-ids[kept]).tolist()):
                if len(heap) < top:
                    heappush(heap, (s, i))
                elif (s, i) > heap[0]:
                    heappushpop(heap, (s, i))
            out_q += [query_ids[lo + r]] * len(heap)
            out_i += [-i for _, i in heap]
            out_s += [s for s, _ in heap]
    return np.array(out_q, np.int64), np.array(out_i, np.int64), np.array(out_s, np.float64)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v, dim): vectors that take part, as doubles: not null, no null or non-finite component, not zero."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0))
            .filter(fine & F.exists("v", lambda x: x != 0)).withColumn("dim", F.size("v")))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", step: int = QUERY_STEP,
            top: int = TOP, query_rows: int = QUERY_ROWS, candidate_rows: int = CANDIDATE_ROWS) -> DataFrame:
    """(query_id, rank, id, score): for each row whose id is divisible by ``step`` the ``top`` other rows of largest
    inner product, ties to the smaller id; all candidates if fewer.

    Vectors are compared with those of their own length; see ``usable`` for those left out.
    Rows that repeat an id take part as often as they come.  Queries are dealt into blocks of
    about ``query_rows``, candidates of ``candidate_rows``; a tile is one pair of blocks, joined
    on its two numbers, and returns at most ``top`` rows a query.
    """
    spark = vectors.sparkSession
    ensure_importable(spark)
    rows = staged(usable(vectors, id_col, vector_col), "ann-vectors")
    is_query = F.col("id") % step == 0
    counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    q_blocks = max(1, -(-counted["q"] // query_rows))
    c_blocks = max(1, -(-counted["n"] // candidate_rows))

    def block(n: int, salt: str):
        return F.pmod(F.xxhash64(F.lit(salt), "id", "v"), F.lit(n)).cast("int")

    queries = (rows.filter(is_query).withColumn("qb", block(q_blocks, "query"))
               .withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1)))))
    candidates = (rows.withColumn("cb", block(c_blocks, "candidate"))
                  .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
                  # names of its own: both sides come from one table
                  .select(F.col("dim").alias("cdim"), F.col("qb").alias("cqb"), F.col("cb").alias("ccb"),
                          F.col("id").alias("cid"), F.col("v").alias("cv")))
    schema = "query_id long, id long, score double"

    def product(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if left.num_rows and right.num_rows:
            found = tile(left.column("id").to_numpy(), np.stack(left.column("v").to_numpy()),
                         right.column("cid").to_numpy(), np.stack(right.column("cv").to_numpy()), top)
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.float64())})

    parts = max(slots(spark), min(q_blocks * c_blocks, 16 * slots(spark)))
    keys = ["dim", "qb", "cb"]
    others = ["cdim", "cqb", "ccb"]
    tiles = (queries.repartition(parts, *keys).groupBy(*keys)
             .cogroup(candidates.repartition(parts, *others).groupBy(*others)).applyInArrow(product, schema))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[float, int]]] = {}
        for b in batches:
            for q, i, s in zip(*(b.column(n).to_pylist() for n in ("query_id", "id", "score"))):
                heap = heaps.setdefault(q, [])
                if len(heap) < top:
                    heappush(heap, (s, -i))
                elif (s, -i) > heap[0]:
                    heappushpop(heap, (s, -i))
        ranked = [(q, r + 1, -i, s) for q, heap in heaps.items()
                  for r, (s, i) in enumerate(sorted(heap, reverse=True))]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in ranked], kind) for k, kind in enumerate(kinds)],
                                         names=["query_id", "rank", "id", "score"])

    shard = F.pmod(F.xxhash64(F.col("query_id")), F.lit(max(1, -(-counted["q"] // 64)))).cast("int")
    return (tiles.withColumn("shard", shard).groupBy("shard")
            .applyInArrow(merge, "query_id long, rank int, id long, score double"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op4 over the whole ``embeddings`` table."""
    found = nearest(pick(table(spark, sf_dir, "embeddings"), vec_id="vec_id", embedding="embedding"))
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


ORACLE_OP4 = """
WITH fine AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x : x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x : x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM fine q JOIN fine c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 20 = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
