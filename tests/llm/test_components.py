"""Components of nodes that share groups: against a union by hand, and the number of rounds."""

import random

import pytest

from quarry.llm.components import _components, min_labels


def brute(members, label):
    groups, root = {}, {n: n for n, _ in members}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, g in members:
        first = groups.setdefault(g, n)
        root[top(n)] = top(first)
    low = {}
    for n in root:
        if label.get(n) is not None:
            t = top(n)
            low[t] = min(low.get(t, label[n]), label[n])
    return {n: low.get(top(n)) for n in root}


def frames(spark, members, label):
    return (spark.createDataFrame(members, "node long, grp string"),
            spark.createDataFrame(list(label.items()), "node long, label long"))


@pytest.mark.parametrize("seed", [1, 2])
def test_labels_match_a_union_by_hand(spark, seed):
    """Random links, repeated rows, nodes of one label in different components, nodes without a label."""
    random.seed(seed)
    members = [(random.randrange(400), f"g{random.randrange(330)}") for _ in range(500)]
    members += members[:50] + [(n, "hot") for n in range(1000, 1400)] + [(5000, "null"), (5001, "null")]
    label = {n: random.randrange(150) for n, _ in members} | {5000: None, 5001: None, 7: None}
    got = {r.node: r.label for r in min_labels(*frames(spark, members, label)).collect()}
    assert got == brute(members, label)


@pytest.mark.parametrize("shuffled", [False, True])
def test_rounds_of_a_long_chain_grow_with_its_logarithm(spark, shuffled):
    n = 10_000
    ids = list(range(n))
    if shuffled:
        random.seed(5)
        random.shuffle(ids)
    members = [(ids[i + d], f"{i}") for i in range(n - 1) for d in (0, 1)]
    out, rounds = _components(*frames(spark, members, {i: i for i in ids}))
    assert {r.label for r in out.collect()} == {0} and rounds <= 20


def test_no_members(spark):
    assert min_labels(*frames(spark, [], {1: 1})).collect() == []
