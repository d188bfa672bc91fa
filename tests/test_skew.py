"""One key holding a third of all rows: the salted paths give the same results as the plain ones."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import graph as G
from quarry.operators import robots as RB
from quarry.plans import derived

from .conftest import SF01


def test_robots_with_a_host_holding_a_third_of_pages(spark):
    pages = derived.pages_table(spark, SF01)
    # every third page moves to one host (its path is kept)
    skewed = pages.select(
        "row_key",
        F.when(F.abs(F.xxhash64("url")) % 3 == 0,
               F.regexp_replace("url", r"^(https?://)[^/?#]*", "$1hot.example.com")).otherwise(F.col("url")).alias("url"),
        "disabled")
    sites = derived.sites(spark, SF01).unionByName(
        spark.createDataFrame([("http://hot.example.com/", "Disallow: /en\nDisallow: *#top$")], "site string, robots string"))
    n = skewed.count()
    hot = skewed.filter(F.col("url").contains("hot.example.com")).count()
    assert hot > n / 4
    plain = sorted(tuple(r) for r in RB.reconciled(skewed, sites, salted=False).collect())
    salted = sorted(tuple(r) for r in RB.reconciled(skewed, sites, salted=True, rows_per_partition=20).collect())
    assert plain == salted and len(plain) == n


def test_pagerank_with_a_source_holding_a_third_of_edges(spark):
    e = derived.edges(spark, SF01)
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").select("l_orderkey", "l_suppkey", "l_partkey")
    skewed = li.select(F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_suppkey")).alias("src"),
                       (F.col("l_partkey") + 50).alias("dst"))
    assert skewed.filter("src = 0").count() > e.count() / 4
    for variant in ("set", "multi"):
        rows = 500
        w, _, hot, parts = G._weighted_edges(skewed, variant == "multi", None, rows)
        assert 0 in {r.src for r in hot.collect()}  # the salted path is really taken
        sizes = [r["n"] for r in w.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        total = sum(sizes)
        assert parts >= total / rows and max(sizes) <= 8 * max(rows, total / parts)
        largest = w.groupBy("src", "salt").count().agg(F.max("count")).first()[0]
        assert largest <= 2 * rows  # a hot source's parts are of a partition's size
        unsalted = G.pagerank(skewed, iterations=3, variant=variant).ranks
        salted = G.pagerank(skewed, iterations=3, variant=variant, rows_per_partition=rows).ranks
        a = {r.id: r.pr for r in unsalted.collect()}
        b = {r.id: r.pr for r in salted.collect()}
        assert a.keys() == b.keys()
        for k in a:
            assert b[k] == pytest.approx(a[k], rel=1e-9, abs=1e-15)
