"""op4: tiles against a full float search."""

import random

import numpy as np

from quarry.llm import ann as A
from quarry.llm.queries import ORACLE
from quarry.plans.verify import compare, duckdb_views

from ..conftest import SF01


def product(v, w):
    total = 0.0
    for a, b in zip(v, w):  # not sum(), which compensates
        total += a * b
    return total


def brute(data, step=20, top=20):
    rows = [(i, v) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, v in rows:
        if q % step:
            continue
        found = sorted((-product(v, w), i) for i, w in rows if i != q and len(w) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:top])]
    return sorted(out)


def test_query_matches_sql(spark):
    r = compare(spark, duckdb_views(SF01), "op4_ann", A.op4_ann, ORACLE["op4_ann"], SF01)
    assert r["ok"], r


def test_many_tiles_ties_and_odd_vectors(spark):
    random.seed(6)
    f32 = lambda x: float(np.float32(x))
    data = [(i, [f32(random.gauss(0, 1)) for _ in range(8)]) for i in range(300)]
    data += [(i, data[i % 7][1]) for i in range(300, 420)]  # copies: ties
    data += [(420, None), (440, []), (460, [0.0] * 8), (480, [1.0, None] + [1.0] * 6), (500, [float("nan")] + [1.0] * 7),
             (501, [float("inf")] * 8), (None, [1.0] * 8), (520, [1.0, 2.0]), (521, [3.0, 4.0]), (540, [1e-30] * 8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as qb")
    got = sorted((r.query_id, r.rank, r.id, r.score)
                 for r in A.nearest(df, query_rows=8, candidate_rows=50).collect())
    assert got == brute(data)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(40, 30)) * 100, rng.normal(size=(500, 30)) / 7
    ids, scores = np.arange(500) + 1000, a @ b.T
    q, i, s = A.tile(np.arange(40), a, ids, b, top=5)
    for k in range(40):
        assert set(i[q == k]) == set(ids[np.argsort(-scores[k])[:5]])
    codes, scale, rounded, error = A.quantised(b)
    assert codes.dtype == np.int8 and np.all(error <= scale / 2 * np.sqrt(30) + 1e-12)


def test_repeated_rows_and_empty_table(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.id) for r in A.nearest(df).collect()}
    assert got == {(0, 1)}
    assert A.nearest(df.limit(0)).collect() == []
    assert A.nearest(spark.createDataFrame([(5, [1.0])], df.schema)).collect() == []  # no query


def test_vectors_at_the_ends_of_the_doubles(spark):
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in np.abs(rng.normal(size=6)) + 0.01]) for i in range(120)]
    data += [(200 + i, [float(f * x) for x in data[i][1]]) for i, f in enumerate([1e200, 1e306, 1e-200, 1e-308, 5e-324, 1e155, 1e-320])]
    data += [(300 + 20 * i, [f, 0.0, f, f, 0.0, f]) for i, f in enumerate([1e200, 1e-310, 5e-324, 1e308])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.id, r.score) for r in A.nearest(df, query_rows=4, candidate_rows=30).collect())
    assert got == brute(data)
