"""Smaller inventory items: result-line labels (J1 + F25), codecs, sinks, small files, counters."""

import os

from pyspark.sql import functions as F

from quarry.functions import codec as C
from quarry.functions.weather import day_month
from quarry.operators import weather as WE
from quarry.operators.quality import observed
from quarry.sinks.files import tuple_line
from quarry.sources.text import read_small_files


def test_labels_from_result_lines(spark):
    lines = spark.createDataFrame([("100001:09.03\t21.0C (2014)",), ("100010:09.03\t8.0C (1992)",), ("junk",)],
                                  "value string")
    res = WE.parse_result_lines(lines)
    assert [tuple(r) for r in res.collect()] == [(100001, "100001:09.03", "21.0C (2014)"),
                                                 (100010, "100010:09.03", "8.0C (1992)")]
    st = spark.createDataFrame([("100001", "60.1", "-5.25", "SOMEWHERE")], "usaf string, lat string, lon string, name string")
    assert [r.label for r in WE.station_labels(res, st).collect()] == ["60.1000, -5.2500, SOMEWHERE (21.0C (2014))"]


def test_codecs(spark):
    import numpy as np

    b = np.asarray([1, -2, 70000], "<i4").tobytes()
    df = spark.createDataFrame([(bytearray(b), 123456789)], "b binary, n long")
    r = df.select(C.le_int32_array("b").alias("a"), C.be_long(C.long_be_bytes("n")).alias("n2"),
                  C.base64_text("b").alias("t")).first()
    assert r.a == [1, -2, 70000] and r.n2 == 123456789
    assert df.select(C.from_base64_text(F.lit(r.t)).alias("x")).first().x == bytearray(b)


def test_codecs_with_nulls_and_negative_numbers(spark):
    data = [(1, [1.5, -2.0]), (-1, None), (-(2**63), []), (2**63 - 1, [0.25])]
    df = spark.createDataFrame(data, "n long, a array<float>").coalesce(1)
    out = df.select("n", C.be_long(C.long_be_bytes("n")).alias("n2"), C.float32_le_bytes("a").alias("b"))
    out = out.select("n", "n2", C.le_float32_array("b").alias("a"), C.le_int32_array(F.lit(None).cast("binary")).alias("z"))
    assert [(r.n2, r.a, r.z) for r in out.collect()] == [(n, a, None) for n, a in data]


def test_hottest_year_of_any_resolution(spark):
    data = [(1, 2000, 3, 9, 10.123), (1, 2001, 3, 9, 10.1239), (1, 1999, 3, 9, -3.0)]
    df = spark.createDataFrame(data, "station int, year int, month int, day int, max_c double").withColumn(
        "max_c", F.col("max_c").cast("float"))
    assert WE.hottest_year(df, tenths=False).first().year == 2001
    exact = df.withColumn("max_c", WE.W.to_celsius(F.lit(70.3).cast("float")))
    r = WE.hottest_year(exact).first()
    assert r.year == 1999 and r.max_c == exact.first().max_c and r.key == "1:09.03"


def test_day_month_and_tuple_line(spark):
    df = spark.createDataFrame([("2024-03-09",)], "d string").select(F.to_date("d").alias("d"))
    assert df.select(day_month("d").alias("x")).first().x == "09.03"
    t = spark.createDataFrame([(0.25, 7)], "pr double, id long").select(tuple_line("pr", "id").alias("l")).first().l
    assert t == "(0.25,7)"


def test_small_files_are_packed(spark, tmp_dir):
    for i in range(20):
        with open(os.path.join(tmp_dir, f"f{i}.txt"), "w") as f:
            f.write(f"line {i}\n")
    df = read_small_files(spark, tmp_dir)
    assert df.count() == 20 and df.rdd.getNumPartitions() < 20


def test_observed_counters(spark):
    df = spark.createDataFrame([("http://a/",), ("bad",)], "url string")
    from quarry.functions.url import strict_host

    d2, obs = observed(df.select(strict_host("url").alias("h")), "COMMON_COUNTERS",
                       MalformedUrls=F.count_if(F.col("h").isNull()))
    d2.collect()
    assert obs.get["MalformedUrls"] == 1


def test_scale_conf():
    from quarry.session import scale_conf

    c = scale_conf(100 * 1024**4, 1000, 8)
    assert int(c["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(1024, 2, 4)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_scratch_is_cleared(spark):
    from quarry import session as SE

    path = SE.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    kept, SE._SCRATCH[:] = SE._SCRATCH[:-1], [path]
    assert SE.clear_scratch(spark) == 1 and SE._SCRATCH == []
    SE._SCRATCH[:] = kept
    assert not os.path.exists(path.removeprefix("file:"))


def test_finer_readings_and_long_years_are_not_rounded(spark):
    import pytest

    to_c = lambda f: (f - 32) / 1.8
    data = [(1, 2001, 3, 9, to_c(20.04)), (1, 2000, 3, 9, to_c(20.03)), (2, 12001, 1, 1, to_c(50.0))]
    df = spark.createDataFrame(data, "station int, year int, month int, day int, max_c double")
    got = {r.station: (r.year, r.max_c) for r in WE.hottest_year(df).collect()}
    assert got == {1: (2001, to_c(20.04)), 2: (12001, to_c(50.0))}
    for station in (1, 2):
        with pytest.raises(Exception, match="no whole tenth"):
            WE.hottest_year(df.filter(F.col("station") == station), tenths=True).collect()
    whole = spark.createDataFrame([(1, 1990 + k, 1, 2, -999 + k / 10) for k in range(40)], "station int, year int, month int, day int, f double")
    r = WE.hottest_year(whole.withColumn("max_c", WE.W.to_celsius(F.col("f").cast("float"))), tenths=True).first()
    assert r.year == 2029
