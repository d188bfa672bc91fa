"""PageRank golden vectors (FIXTURES section 3) and graph helpers."""

import pytest

from quarry.operators import graph as G

EDGES = [(1, 2), (1, 3), (1, 3), (2, 3), (3, 1), (3, 4), (5, 3)]

GOLDEN = {
    ("multi", "redistribute", 1): {1: 0.115, 2: 0.08666667, 3: 0.48333333, 4: 0.115, 5: 0.03},
    ("multi", "redistribute", 2): {1: 0.25841667, 2: 0.08558333, 3: 0.21733333, 4: 0.25841667, 5: 0.053},
    ("multi", "redistribute", 3): {1: 0.17405, 2: 0.15490139, 3: 0.34591528, 4: 0.17405, 5: 0.08168333},
    ("set", "ignore", 1): {1: 0.115, 2: 0.115, 3: 0.455, 4: 0.115},
    ("set", "ignore", 2): {1: 0.223375, 2: 0.078875, 3: 0.176625, 4: 0.223375},
    ("set", "ignore", 3): {1: 0.10506563, 2: 0.12493437, 3: 0.19197813, 4: 0.10506563},
    ("set", "redistribute", 1): {1: 0.155, 2: 0.155, 3: 0.495, 4: 0.155},
    ("set", "redistribute", 2): {1: 0.271375, 2: 0.126875, 3: 0.292625, 4: 0.271375},
    ("set", "redistribute", 3): {1: 0.20864063, 2: 0.19960938, 3: 0.33380313, 4: 0.20864063},
}
LEAKED = {("multi", 1): 0.0, ("multi", 2): 0.115, ("multi", 3): 0.25841667,
          ("set", 1): 0.2, ("set", 2): 0.155, ("set", 3): 0.271375}


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "src long, dst long")


@pytest.mark.parametrize("key", sorted(GOLDEN))
def test_pagerank_golden(edges, key):
    variant, dangling, n = key
    res = G.pagerank(edges, iterations=n, n_nodes=5, variant=variant, dangling=dangling, rows_per_partition=1)
    got = {r["id"]: r["pr"] for r in res.ranks.collect()}
    assert set(got) == set(GOLDEN[key])
    for k, v in GOLDEN[key].items():
        assert got[k] == pytest.approx(v, abs=1e-8)
    if dangling == "redistribute":
        assert res.leaked == pytest.approx(LEAKED[(variant, n)], abs=1e-8)
    else:
        assert res.leaked == 0.0


def test_graph_helpers(edges):
    assert sorted(tuple(r) for r in G.edges_distinct(edges).collect()) == sorted(set(EDGES))
    assert sorted(r.id for r in G.graph_nodes(edges).collect()) == [1, 2, 3, 4, 5]
    assert [r.id for r in G.dangling_nodes(edges).collect()] == [4]
    adj = {(r.src, r.dst): (r.mult, r.outdeg) for r in G.adjacency(edges).collect()}
    assert adj[(1, 3)] == (2, 3) and adj[(3, 4)] == (1, 2)


def test_top_k_and_order(edges):
    res = G.pagerank(edges, iterations=3, n_nodes=5, variant="set")
    top = [r.id for r in G.top_k(res.ranks, 2).collect()]
    assert top == [3, 1]  # 1 and 4 tie; smaller id first
    assert [r.id for r in G.ranked(res.ranks).collect()] == [3, 1, 4, 2]


def test_parse_edge_lines(spark):
    lines = spark.createDataFrame([("# comment",), ("1\t2",), ("3\t4 # x",), ("bad",)], "value string")
    got = sorted(tuple(r) for r in G.parse_edge_lines(lines).collect())
    assert got == [(1, 2)]
    got = sorted(tuple(r) for r in G.parse_edge_lines(lines, "startswith").collect())
    assert got == [(1, 2)]  # '4 # x' is not a number either way


@pytest.mark.parametrize("variant,dangling", [("multi", "redistribute"), ("set", "redistribute")])
def test_pagerank_persisted_steps(edges, variant, dangling):
    res = G.pagerank(edges, iterations=3, n_nodes=5, variant=variant, dangling=dangling, checkpoint_every=2)
    got = {r["id"]: r["pr"] for r in res.ranks.collect()}
    for k, v in GOLDEN[(variant, dangling, 3)].items():
        assert got[k] == pytest.approx(v, abs=1e-8)


def test_iteration_plan_reads_edges_in_place(spark):
    """The edge table is partitioned once; an iteration must not shuffle it again."""
    import contextlib
    import io
    import re

    from quarry.plans import derived

    from .conftest import SF001

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join plan
    captured = []
    orig = G._checkpointed

    def capture(df, parts, *keys):
        captured.append((df, parts, keys))
        return orig(df, parts, *keys)

    G._checkpointed = capture
    try:
        G.pagerank(derived.edges(spark, SF001), iterations=2, variant="set")
        df, parts, keys = captured[-1]
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.repartition(parts, *keys).explain()
    finally:
        G._checkpointed = orig
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = [re.sub(r"#\d+L?", "", x) for x in buf.getvalue().splitlines()]
    scans = [i for i, x in enumerate(lines) if "Scan ExistingRDD" in x]
    edge = [i for i in scans if "[src,salt,dst,w]" in lines[i]]
    assert edge, buf.getvalue()
    # the line above a scan is its parent operator: never an exchange for edges, nodes or ranks
    for i in scans:
        parent = lines[i - 1]
        assert "Exchange" not in parent or "[src,salts" in lines[i], buf.getvalue()
    assert sum("Exchange hashpartitioning" in x for x in lines) == 2  # sent rows + contributions


def test_input_is_evaluated_once_and_the_session_is_left_alone(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(e):
        seen.add(1)
        return e

    rows = spark.sparkContext.parallelize(EDGES, 3).map(count)
    edges = spark.createDataFrame(rows, "src long, dst long")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    G.pagerank(edges, iterations=2, n_nodes=5, variant="multi").ranks.collect()
    assert seen.value == len(EDGES)
    assert before == {k: spark.conf.get(k) for k in before}


def test_edge_line_counters(spark):
    lines = spark.createDataFrame([("# c",), ("1\t2",), ("x\t2",), ("7",), ("",)], "value string")
    assert tuple(G.edge_line_counts(lines).first()) == (5, 1, 3)


@pytest.mark.parametrize("variant", ["set", "multi"])
def test_a_stopped_run_goes_on(edges, tmp_path, variant):
    state = str(tmp_path / "state")
    golden = GOLDEN[(variant, "redistribute", 3)]
    whole = {r["id"]: r["pr"] for r in G.pagerank(edges, iterations=7, n_nodes=5, variant=variant).ranks.collect()}
    G.pagerank(edges, iterations=2, n_nodes=5, variant=variant, state=state)
    assert G.kept_step(state)["step"] == 2
    res = G.pagerank(edges, iterations=3, n_nodes=5, variant=variant, state=state)
    got = {r["id"]: r["pr"] for r in res.ranks.collect()}
    assert got == pytest.approx(golden, abs=1e-8) and res.leaked == pytest.approx(LEAKED[(variant, 3)], abs=1e-8)
    # the driver dies between a step's ranks and their publication: the step is made again
    (tmp_path / "state" / "step-4").mkdir()
    on = {r["id"]: r["pr"] for r in G.pagerank(edges, iterations=7, n_nodes=5, variant=variant, state=state).ranks.collect()}
    assert on == pytest.approx(whole, abs=1e-12) and G.kept_step(state)["step"] == 7
    again = {r["id"]: r["pr"] for r in G.pagerank(edges, iterations=7, n_nodes=5, variant=variant, state=state).ranks.collect()}
    assert again == pytest.approx(whole, abs=1e-12)
    assert len([p for p in (tmp_path / "state").iterdir() if p.name.startswith("step-")]) == 2
    with pytest.raises(ValueError, match="another run"):
        G.pagerank(edges, iterations=8, n_nodes=6, variant=variant, state=state)
    with pytest.raises(ValueError, match="beyond"):
        G.pagerank(edges, iterations=5, n_nodes=5, variant=variant, state=state)
