"""J4 for hosts with many rules: literals are looked up, with the same result as rule by rule."""

import random

from pyspark.sql import functions as F

from quarry.operators import robots as RB


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lookups_equal_the_scan_of_rules(spark):
    rnd = random.Random(3)
    part = lambda: "".join(rnd.choice("ab/.") for _ in range(rnd.randint(0, 4)))
    rule = lambda: rnd.choice(["/", "*", ""]) + part() + rnd.choice(["", "$"])
    sites = [(f"http://h{k}/", "\n".join("Disallow: " + rule() for _ in range(n))) for k, n in enumerate((0, 1, 3, 8, 20))]
    sites += [("http://x/", None), ("h1", "Disallow: /zz")]
    pages = [(f"http://h{rnd.randint(0, 6)}{rnd.choice(['', '/'])}{part()}", rnd.choice([None, "Y"])) for _ in range(400)]
    p = spark.createDataFrame(pages + pages[:9], "url string, disabled string")
    s = spark.createDataFrame(sites, "site string, robots string")
    scan = rows(RB.page_status(p, s, many_rules=None))
    assert any(r[3] for r in scan)
    for many in (0, 2, 10, 1000):
        assert rows(RB.page_status(p, s, many_rules=many)) == scan
        assert rows(RB.page_status(p, s, many_rules=many, salted=True, rows_per_partition=50)) == scan


def test_many_rules_and_pages_of_one_host(spark):
    n = 100_000
    lines = F.concat_ws("\n", F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(
        i % 3 == 0, F.concat(F.lit("Disallow: /p"), i.cast("string"), F.lit("/")))
        .when(i % 3 == 1, F.concat(F.lit("Disallow: /q"), i.cast("string"), F.lit("$")))
        .otherwise(F.concat(F.lit("Disallow: *-"), i.cast("string"), F.lit("$")))))
    sites = spark.range(1).select(F.lit("http://big/").alias("site"), lines.alias("robots"))
    i = F.col("id").cast("string")
    url = (F.when(F.col("id") % 4 == 0, F.concat(F.lit("http://big/p"), i, F.lit("/x")))
           .when(F.col("id") % 4 == 1, F.concat(F.lit("http://big/q"), i))
           .when(F.col("id") % 4 == 2, F.concat(F.lit("http://big/z-"), i)).otherwise(F.concat(F.lit("http://big/free"), i)))
    pages = spark.range(n).select("id", url.alias("url"), F.lit(None).cast("string").alias("disabled"))
    assert RB.many_rules_in(sites) == RB.MANY_RULES and RB.many_rules_in(sites.limit(0)) is None
    got = {r.url for r in RB.page_status(pages, sites, many_rules=RB.many_rules_in(sites)).filter("dis").collect()}
    want = {f"http://big/p{k}/x" for k in range(n) if k % 4 == 0 and k % 3 == 0}
    want |= {f"http://big/q{k}" for k in range(n) if k % 4 == 1 and k % 3 == 1}
    want |= {f"http://big/z-{k}" for k in range(n) if k % 4 == 2 and k % 3 == 2}
    assert got == want
