"""op7: fingerprints and groups against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import simhash as S

from ..conftest import SF001


def brute_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    grams = [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_groups(ids, prints, bits):
    up = list(range(len(ids)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                up[root(i)] = root(j)
    low = {}
    for i, d in enumerate(ids):
        low[root(i)] = min(low.get(root(i), d), d)
    return {d: low[root(i)] for i, d in enumerate(ids)}


def rows(spark, data, schema="doc_id long, text string"):
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize("text", [None, "", " \t\n", "A", "a B", "One two THREE", "x " * 400, "É\xa0é ß A\x0bB\x0cC d"])
def test_fingerprint_matches_definition(text):
    assert S.fingerprint(text) == brute_fingerprint(text)


def test_fingerprint_is_sparks_own_hash(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert S.fingerprint("One two\tthree") == got % 2**64


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    expect = brute_groups([d.doc_id for d in docs], [brute_fingerprint(d.text) for d in docs], 2)
    got = S.op7_simhash(spark, SF001).collect()
    assert {r.doc_id: r.component_id for r in got} == expect
    assert all(r.fingerprint == f"{brute_fingerprint(d.text):016x}" for r, d in
               zip(sorted(got, key=lambda r: r.doc_id), sorted(docs, key=lambda d: d.doc_id)))


def test_groups_with_close_fingerprints_in_small_leaves(spark):
    """Chains of one- and two-bit steps through many leaves are one group each."""
    rng = np.random.default_rng(3)
    points = rng.integers(0, 2**63, 300, dtype=np.uint64)
    for _ in range(4):
        flip = np.uint64(1) << rng.integers(0, 64, len(points)).astype(np.uint64)
        points = np.concatenate((points, points[:200] ^ flip[:200]))
    points = np.unique(points)
    distinct = spark.createDataFrame([(int(np.int64(p)), i) for i, p in enumerate(points.view(np.int64))], "fp long, label long")
    found = S.fingerprint_groups(distinct, 2, leaf_rows=32)
    low = S.min_labels(found, distinct.select(F.col("fp").alias("node"), "label"))
    got = {r.node % 2**64: r.label for r in low.collect()}
    expect = brute_groups(list(range(len(points))), [int(p) for p in points], 2)
    assert all(got.get(int(p), i) == expect[i] for i, p in enumerate(points))


def test_both_leaf_searches_agree():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    points = np.unique(np.concatenate([base] + [base ^ (np.uint64(1) << np.uint64(b)) for b in (0, 7, 63, 33)]))
    a, b = S._Forest(len(points)), S._Forest(len(points))
    S._by_rings(points, 2, a)
    S._by_flips(points, 2, b)
    assert np.array_equal(a.roots(), b.roots())


def test_every_close_pair_meets_in_a_leaf():
    rng = np.random.default_rng(7)
    points = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    near = points ^ (np.uint64(1) << rng.integers(0, 64, 4000).astype(np.uint64))
    nodes = S.vantage_tree(points[:1000], 64)
    assert sum(n is not None for n in nodes) > 30
    both = np.concatenate((points, near))
    idx, leaf, home = S.route(nodes, both, 2)
    assert np.array_equal(np.sort(idx[home]), np.arange(8000))  # one home each
    leaves = [set() for _ in both]
    for i, n in zip(idx.tolist(), leaf.tolist()):
        leaves[i].add(n)
    assert all(leaves[i] & leaves[i + 4000] for i in range(4000))


def test_odd_rows(spark):
    data = [(3, None), (1, ""), (2, "same text here"), (2, "same text here"), (None, "same text here"), (5, "w " * 60_000)]
    df = rows(spark, data).withColumns({"fp": F.lit("clash"), "id": F.lit(9), "component": F.lit("x")})
    got = S.near_duplicates(df).collect()
    assert len(got) == len(data)
    of = {r.id: r.component for r in got}
    assert of == {1: 1, 3: 1, 2: 2, None: 2, 5: 5}
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, 1), (False, 2), (False, 5), (True, None)]


def test_empty_table(spark):
    assert S.near_duplicates(rows(spark, [])).collect() == []
    assert S.keep_one_per_group(rows(spark, [])).collect() == []


def test_different_texts_under_one_id(spark):
    """Of clashing rows only those go that have a copy of a smaller id, or under their own."""
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(40)) for k in "abcd")
    data = [(1, a), (5, a), (5, b), (5, b), (5, c), (6, c), (7, d), (7, d), (8, b)]
    kept = S.keep_one_per_group(rows(spark, data))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, a), (5, b), (5, c), (7, d)])


def test_search_by_parts_agrees_with_rings():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    base = np.concatenate((base, np.uint64(5) << np.uint64(40) | rng.integers(0, 2**9, 300, dtype=np.uint64)))  # long runs of equal parts
    near = [base ^ (np.uint64(1) << rng.integers(0, 64, len(base)).astype(np.uint64)) for _ in range(3)]
    points = rng.permutation(np.unique(np.concatenate((base, *near))))
    for reach in (0, 1, 2, 3):
        a, b = S._Forest(len(points)), S._Forest(len(points))
        S._by_rings(points, reach, a)
        S._by_parts(points, reach, b)
        assert np.array_equal(a.roots(), b.roots())


def test_few_copies_at_any_size():
    rng = np.random.default_rng(8)
    for n in (50_000, 800_000, 3_200_000):
        points = rng.integers(0, 2**63, n, dtype=np.uint64)
        nodes = S.vantage_tree(points[:S.SAMPLE_ROWS], -(-n // S.leaf_size(n)))
        copies = sum(len(S.route(nodes, points[lo:lo + 200_000], S.MAX_BITS)[0]) for lo in range(0, min(n, 600_000), 200_000))
        assert copies <= 2.6 * min(n, 600_000), (n, copies)
    assert S.leaf_size(10**10) == S.LEAF_ROWS
