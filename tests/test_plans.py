"""Plan properties the scale design relies on (checked on the executed plans)."""

import contextlib
import io

import __spark_entry__ as E

from .conftest import SF001


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def test_sized_terms_push_filter_and_prune_columns(spark):
    p = _plan(E.queries()["term_frequency_sized"](spark, SF001))
    assert "GreaterThanOrEqual(n_chars,9216)" in p and "LessThanOrEqual(n_chars,10240)" in p
    assert "ReadSchema: struct<text:string,n_chars:bigint>" in p


def test_aggregates_are_partial_before_the_shuffle(spark):
    for name, fn in [("doc_frequency", "partial_count"), ("hottest_year_per_station_day", "partial_max"),
                     ("top_query_per_host", "partial_min"), ("host_counts", "partial_count")]:
        p = _plan(E.queries()[name](spark, SF001), "simple")
        assert fn in p, (name, p)


def test_share_of_total_reuses_the_per_host_shuffle(spark):
    df = E.queries()["host_percent"](spark, SF001)
    df.collect()
    p = _plan(df, "simple")
    assert "ReusedExchange" in p and "Window" not in p


def test_argmax_per_station_day_does_not_sort(spark):
    assert "SortAggregate" not in _plan(E.queries()["hottest_year_per_station_day"](spark, SF001), "simple")


def test_joins_start_no_job_while_they_are_planned(spark):
    """Nothing is measured first: each input is read by the query alone."""
    from quarry.operators import graph, robots, weather
    from quarry.plans import derived

    edges, pages, sites = derived.edges(spark, SF001), derived.pages_table(spark, SF001), derived.sites(spark, SF001)
    hot, stations = weather.hottest_year(derived.readings_c(spark, SF001)), derived.stations(spark, SF001)
    for name, build in (("adjacency", lambda: graph.adjacency(edges)), ("robots", lambda: robots.reconciled(pages, sites)),
                        ("labels", lambda: weather.station_labels(hot, stations))):
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        build()
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"build-{name}")) == 0, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_nodes_come_from_one_scan(spark):
    for name in ("graph_nodes", "dangling_nodes"):
        assert _plan(E.queries()[name](spark, SF001), "simple").count("FileScan") == 1, name


def test_pipes_run_without_python(spark):
    p = _plan(E.queries()["pipe_word_count"](spark, SF001), "simple")
    assert p.count("ScriptTransformationIOSchema") == 3 and "Python" not in p and "ExistingRDD" not in p


def test_a_host_is_taken_by_one_pattern(spark):
    for name in ("host_counts", "top_query_per_host"):
        p = _plan(E.queries()[name](spark, SF001), "extended").split("== Physical Plan ==")[1]
        assert "regexp_replace" not in p and "RLIKE" not in p and p.count("regexp_extract_all") == 1, name
