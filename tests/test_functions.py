"""Scalar helpers against the reference's unit cases (FIXTURES) and plain-Python models."""

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import robots as R
from quarry.functions import text as T
from quarry.functions import url as U
from quarry.functions import weather as W

# Two daily records, with readings and with both readings missing.
WEATHER_LINE_1 = "010010 99999  20010102    19.7  7    16.9  7  1002.9  7  1001.7  7   13.6  6   11.3  7   14.0  999.9    21.6*   17.1   0.05F 999.9  001000"
WEATHER_LINE_2 = "010010 99999  20010102    19.7  7    16.9  7  1002.9  7  1001.7  7   13.6  6   11.3  7   14.0  999.9  9999.9* 9999.9   0.05F 999.9  001000"


def one(spark, col, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first()["r"]


def test_weather_record(spark):
    df = spark.createDataFrame([(WEATHER_LINE_1,), (WEATHER_LINE_2,)], "value string")
    rows = df.select(*W.parse_gsod("value")).collect()
    r = rows[0]
    assert (r.station, r.year, r.month, r.day) == (10010, 2001, 1, 2)
    assert r.max_c == pytest.approx(-5.7, abs=0.1) and r.min_c == pytest.approx(-8.3, abs=0.1)
    flags = df.select(*W.parse_gsod("value")).select(W.has_temp("max_c").alias("mx"), W.has_temp("min_c").alias("mn")).collect()
    assert (flags[0].mx, flags[0].mn) == (True, True)
    assert (flags[1].mx, flags[1].mn) == (False, False)


def test_weather_formats(spark):
    df = spark.createDataFrame([(100001, 9, 3, 21.0, 2014)], "s int, d int, m int, t float, y int")
    r = df.select(W.station_day_key("s", "d", "m").alias("k"), W.temp_value("t", "y").alias("v")).first()
    assert (r.k, r.v) == ("100001:09.03", "21.0C (2014)")


@pytest.mark.parametrize("url,host,path", [
    ("http://h:8080/a/b", "h:8080", "/a/b"), ("http://h", "h", ""), ("http://h/", "h", "/"), ("h//x", "h", "/x")])
def test_lenient_url_parts(spark, url, host, path):
    assert one(spark, U.lenient_host("x"), url) == host
    assert one(spark, U.lenient_path("x"), url) == path


@pytest.mark.parametrize("url,host", [
    ("http://u@h.com:80/x", "h.com"), ("HTTP://H.com?x", "H.com"), ("foo://h/x", None), ("/rel", None),
    ("http:///x", ""), ("https://a.b.example.org/en/1#top", "a.b.example.org"), ("ftp://f.org", "f.org")])
def test_strict_host(spark, url, host):
    assert one(spark, U.strict_host("x"), url) == host


def test_row_key_is_md5_hex(spark):
    import hashlib

    u = "http://h/x?ü"
    assert one(spark, U.row_key("x"), u) == hashlib.md5(u.encode()).hexdigest()


@pytest.mark.parametrize("line,words", [("  a  b ", ["", "", "a", "", "b"]), ("", [""]), ("   ", []), ("a", ["a"])])
def test_java_whitespace_split(spark, line, words):
    assert one(spark, T.split_ws_java("x"), line) == words


def _java_split(s: str) -> list[str]:
    if s == "":
        return [""]
    parts = re.split(r"[ \t\n\x0b\f\r]", s)
    while parts and parts[-1] == "":
        parts.pop()
    return parts


@settings(max_examples=40, deadline=None)
@given(st.text(alphabet=" \tabé", max_size=12))
def test_java_whitespace_split_model(spark, s):
    assert one(spark, T.split_ws_java("x"), s) == _java_split(s)


def test_letter_runs_and_case(spark):
    assert one(spark, T.lower_terms("x"), "Привет, МИР! Straße 42 ÉTÉ") == ["привет", "мир", "straße", "été"]
    assert one(spark, T.distinct_lower_terms("x"), "a A b a") == ["a", "b"]


def test_utf16_length(spark):
    assert one(spark, T.utf16_length("x"), "a\U0001F600") == 3


# Robots texts, and whether each path is disallowed under them.
ROBOTS_CASES = [
    ("""Disallow: /massages
Disallow: /kiev
Disallow: */reviews.html$
Disallow: /dnepropetrovsk
Disallow: /krivoy-rog
Disallow: */vacancy.html$""", {
        "/dnepropetrovsk/": True,
    }),
    ("Disallow: /users", {
        "/company/about.html": False,
        "/users/jan": True,
        "/users/": True,
        "/users": True,
        "/another/prefix/users/about.html": False,
        "/another/prefix/users": False,
    }),
    (None, {
        "/company/about.html": False,
        "/company/second.html": False,
        "any_url": False,
    }),
    ("", {
        "/company/about.html": False,
        "/company/second.html": False,
        "any_url": False,
    }),
    ("Disallow: *.php$", {
        "file.php": True,
        "file.sphp": False,
    }),
    ("""Disallow: /users
Disallow: *.php$
Disallow: */cgi-bin/
Disallow: /very/secret.page.html$""", {
        "/users/jan": True,
        "/subdir2/users/about.html": False,
        "/info.php": True,
        "/info.php?user=123": False,
        "/info.pl": False,
        "/forum/cgi-bin/send?user=123": True,
        "/forum/cgi-bin/": True,
        "/cgi-bin/": True,
        "/scgi-bin/": False,
        "/very/secret.page.html": True,
        "/the/very/secret.page.html": False,
        "/very/secret.page.html?blah": False,
        "/the/very/secret.page.html?blah": False,
    }),
]


@pytest.mark.parametrize("text,cases", ROBOTS_CASES)
def test_robots_rules(spark, text, cases):
    df = spark.createDataFrame([(text, p) for p in cases], "robots string, path string")
    got = df.select("path", R.is_disallowed(R.compile_rules("robots"), F.col("path")).alias("d")).collect()
    assert {r.path: r.d for r in got} == cases


def test_robots_rule_kinds_and_skipped_lines(spark):
    text = "User-agent: *\nDisallow: /a$\nDisallow: *b\nDisallow: c$\nDisallow: d\n"
    df = spark.createDataFrame([(text,)], "robots string")
    r = df.select(R.compile_rules("robots").alias("r"), R.skipped_rule_lines("robots").alias("s")).first()
    assert [(x.kind, x.literal) for x in r.r] == [("exact", "/a"), ("contains", "b"), ("suffix", "c"), ("exact", "d")]
    assert r.s == 1


def test_empty_disallow_matches_only_empty_path(spark):
    # D12: "Disallow: " compiles to an empty pattern, which fully matches only the empty path
    df = spark.createDataFrame([("Disallow: ", ""), ("Disallow: ", "/x")], "robots string, path string")
    got = [r.d for r in df.select(R.is_disallowed(R.compile_rules("robots"), F.col("path")).alias("d")).collect()]
    assert got == [True, False]


def test_lenient_base64(spark):
    # Junk characters in base64 text are skipped, as the reference's decoder does
    from quarry.functions.codec import from_base64_text, utf8_lenient

    got = one(spark, utf8_lenient(from_base64_text("x")), "aGVs*bG8=")
    assert got == "hello"
