"""Operators on hand-made rows: the reference's golden cases and the D-decisions."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import hosts as H
from quarry.operators import keyed as K
from quarry.operators import robots as RB
from quarry.operators import text as TX
from quarry.operators import weather as WE
from quarry.operators.joins import salts_per_key, skew_safe_join

CLICKS = [("y", "http://a/1"), ("x", "http://a/2"), ("y", "http://a/3"), ("x", "http://a/4"), ("z", "http://b/")]


@pytest.mark.parametrize("m,as_written,default", [
    (0, {("a", "x", 2), ("b", "z", 1)}, {("a", "x", 2), ("b", "z", 1)}),
    (2, {("a", "x", 2), ("b", "", 1)}, {("a", "x", 2)}),
    (3, {("a", "", 2), ("b", "", 2)}, set()),
])
def test_top_query_min_clicks(spark, m, as_written, default):
    df = spark.createDataFrame(CLICKS, "query string, url string")
    got_w = {tuple(r) for r in H.top_query_per_host(df, min_clicks=m, emit_below_threshold=True).collect()}
    got_d = {tuple(r) for r in H.top_query_per_host(df, min_clicks=m).collect()}
    assert got_w == as_written and got_d == default


def test_host_share_and_tagged(spark):
    df = spark.createDataFrame([("http://a/x",), ("http://a/y",), ("http://b/",), ("bad url",)], "url string")
    got = {r.host: (r.hits, r.percent) for r in H.host_percent(df).collect()}
    assert got == {"a": (2, pytest.approx(66.666667)), "b": (1, pytest.approx(33.333333))}
    assert {tuple(r) for r in H.host_counts_tagged(df).collect()} == {("H:a", 2.0), ("H:b", 1.0)}
    q = H.url_quality(df).first()
    assert (q.urls, q.malformed_urls, q.hosts) == (4, 1, 2)


def test_first_char_bucket(spark):
    df = spark.createDataFrame([("Abc",), ("abc",), ("mno",), ("zed",), ("~x",), ("",)], "host string")
    got = {r.host: r.b for r in df.select("host", H.first_char_bucket().alias("b")).collect()}
    assert got == {"Abc": 0, "abc": 0, "mno": 16, "zed": 33, "~x": 34, "": 0}


def test_hottest_year_tie_smallest_year(spark):
    rows = [(10010, 2001, 1, 2, -5.7), (10010, 2002, 1, 2, 1.0), (10010, 2003, 1, 2, 1.0), (10010, 2004, 1, 2, 5537.72)]
    df = spark.createDataFrame(rows, "station int, year int, month int, day int, max_c float")
    r = WE.hottest_year(df).collect()
    assert [(x.key, x.value) for x in r] == [("10010:02.01", "1.0C (2002)")]
    s = WE.skipped_readings(df).first()
    assert (s.readings, s.skipped) == (4, 1)


def test_station_labels_and_missing(spark):
    hot = spark.createDataFrame([(100001, "100001:09.03", "21.0C (2014)"), (100002, "100002:09.03", "8.0C (1992)")],
                                "station int, key string, value string")
    st = spark.createDataFrame([("100001", "10.5", "20.25", "ONE", 1), ("100001", "11.0", "21.0", "ONE-B", 2),
                                ("100002", "", "1", "NOLAT", 1), ("999999", "1", "1", "X", 1)],
                               "usaf string, lat string, lon string, name string, ord int")
    for opts in ({}, {"salted": True, "rows_per_partition": 1}):
        lab = [tuple(r) for r in WE.station_labels(hot, st, **opts).collect()]
        assert lab == [(100001, "100001:09.03", "11.0000, 21.0000, ONE-B (21.0C (2014))")]  # last duplicate wins
        assert [r.station for r in WE.stations_missing(hot, st, **opts).collect()] == [100002]


def test_word_counts(spark):
    df = spark.createDataFrame([("  a  b \nb",), ("",)], "text string")
    ws = {r.word: r.cnt for r in TX.word_count_ws(df).collect()}
    assert ws == {"": 3, "a": 1, "b": 2}  # an empty text has no line
    wc = {r.word: r.cnt for r in TX.word_count(df).collect()}
    assert wc == {"a": 1, "b": 2}
    df2 = spark.createDataFrame([("Ab ab, AB!",), ("ab cd",)], "text string")
    assert {r.term: r.doc_count for r in TX.doc_frequency(df2).collect()} == {"ab": 2, "cd": 1}
    assert {r.term: r.term_count for r in TX.term_frequency(df2).collect()} == {"ab": 4, "cd": 1}


def test_robots_reconciliation(spark):
    pages = spark.createDataFrame([("http://h/en/1", None), ("http://h/fr/2", "Y"), ("http://g/x", "Y"),
                                   ("http://h/en/3", "Y")], "url string, disabled string")
    sites = spark.createDataFrame([("http://h/", "Disallow: /en"), ("h", "Disallow: /"), ("http://k/", None)],
                                  "site string, robots string")
    ch = {r.url: r.op for r in RB.status_changes(pages, sites).collect()}
    # smallest site string wins for host h (D11): 'h' < 'http://h/' -> 'Disallow: /'
    assert ch == {"http://h/en/1": "put", "http://g/x": "delete"}
    merged = K.merge_cells(pages.select(F.md5("url").alias("row_key"), "url", "disabled"),
                           RB.changes_as_cells(RB.status_changes(pages, sites)), "disabled")
    got = {r.url: r.disabled for r in merged.collect()}
    assert got == {"http://h/en/1": "Y", "http://h/fr/2": "Y", "http://g/x": None, "http://h/en/3": "Y"}
    rec = {r.url: r.disabled for r in RB.reconciled(pages, sites).collect()}
    assert rec == got


def test_merge_cells_insert_and_latest(spark):
    base = spark.createDataFrame([("k1", "a", "x"), ("k2", "b", None)], "row_key string, url string, c string")
    ch = spark.createDataFrame([("k1", "delete", None, 1), ("k1", "put", "z", 2), ("k3", "put", "n", 1)],
                               "row_key string, op string, value string, ts int")
    got = {r.row_key: (r.url, r.c) for r in K.merge_cells(base, K.latest_change(ch), "c").collect()}
    assert got == {"k1": ("a", "z"), "k2": ("b", None), "k3": (None, "n")}
    assert [r.url for r in K.point_read(base, "k2").collect()] == ["b"]


def test_first_per_key(spark):
    df = spark.createDataFrame([("h", "b", 2), ("h", "c", 1), ("g", "a", 5)], "k string, v string, o int")
    assert {tuple(r) for r in K.first_per_key(df, "k", "v", "o").collect()} == {("h", "c"), ("g", "a")}
    assert {tuple(r) for r in K.first_per_key(df, "k", "v").collect()} == {("h", "b"), ("g", "a")}


def test_skew_safe_join_matches_plain_join(spark):
    big = spark.createDataFrame([("hot", i) for i in range(60)] + [(f"k{i}", i) for i in range(20)], "k string, v int")
    small = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"S{i}") for i in range(0, 20, 2)], "k string, s string")
    assert [tuple(r) for r in salts_per_key(big, "k", 20).collect()] == [("hot", 3)]
    for how in ("left", "inner", "left_anti", "left_semi"):
        plain = sorted(tuple(r) for r in big.join(small, "k", how).collect())
        for salted in (None, True, False):
            got = sorted(tuple(r) for r in skew_safe_join(big, small, "k", how, salted, rows_per_partition=20).collect())
            assert got == plain, (how, salted)


def test_upsert_rows(spark):
    base = spark.createDataFrame([("k1", "a", 1), ("k2", "b", 2)], "row_key string, text string, size int")
    rows = spark.createDataFrame([("k2", "B"), ("k3", "c")], "row_key string, text string")
    got = {r.row_key: (r.text, r.size) for r in K.upsert_rows(base, rows).collect()}
    assert got == {"k1": ("a", 1), "k2": ("B", 2), "k3": ("c", None)}
