"""Property checks of URL parts and robots matching against plain-Python models of the
reference's semantics (string index/split for URLs, anchored regular expressions for rules)."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import robots as R
from quarry.functions import url as U

URL_CHARS = st.text(alphabet="ab/:.?#*$x", max_size=14)


def model_parts(url: str) -> tuple[str, str]:
    p = url.find("://")
    if p != -1:
        url = url[p + 3:]
    parts = url.split("/", 1)
    host, path = parts[0], ""
    if len(parts) == 2:
        path = parts[1] if parts[1].startswith("/") else "/" + parts[1]
    return host, path


def model_rule(rule: str):
    """Rule text -> compiled pattern, full match (with the D8 decision: other texts are literal)."""
    if rule.startswith("/"):
        pat = "^" + re.escape(rule) + ".*"
    elif rule.startswith("*"):
        pat = ".*" + re.escape(rule[1:]) + ".*"
    else:
        pat = re.escape(rule[:-1]) + "$" if rule.endswith("$") else re.escape(rule)
        pat = (".*" + pat) if rule.endswith("$") else pat
        return re.compile(pat)
    esc_dollar = re.escape("$") + ".*"
    if pat.endswith(esc_dollar):
        pat = pat[: -len(esc_dollar)] + "$"
    return re.compile(pat)


@settings(max_examples=30, deadline=None)
@given(st.lists(URL_CHARS, min_size=1, max_size=8))
def test_lenient_parts_model(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [(r.h, r.p) for r in df.select(U.lenient_host("u").alias("h"), U.lenient_path("u").alias("p")).collect()]
    assert got == [model_parts(u) for u in urls]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="/*$ab.", min_size=0, max_size=6), max_size=4),
       st.lists(st.text(alphabet="/ab.$", max_size=8), min_size=1, max_size=6))
def test_robots_model(spark, rules, paths):
    text = "\n".join("Disallow: " + r for r in rules)
    compiled = [model_rule(r) for r in rules]
    expect = [any(c.fullmatch(p) for c in compiled) for p in paths]
    df = spark.createDataFrame([(text, p) for p in paths], "robots string, path string")
    got = [r.d for r in df.select(R.is_disallowed(R.compile_rules("robots"), F.col("path")).alias("d")).collect()]
    assert got == expect


def test_point_read_is_pushed_down(spark, tmp_dir):
    from quarry.operators.keyed import point_read
    from quarry.sinks.files import write_sorted

    df = spark.createDataFrame([(f"k{i:04d}", i) for i in range(1000)], "row_key string, v int")
    write_sorted(df, tmp_dir + "/t", "row_key", partitions=4)
    t = spark.read.parquet(tmp_dir + "/t")
    q = point_read(t, "k0042")
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        q.explain("formatted")
    plan = buf.getvalue()
    assert "EqualTo(row_key,k0042)" in plan
    assert [r.v for r in q.collect()] == [42]
