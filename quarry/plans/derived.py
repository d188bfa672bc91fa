"""Inputs the reference's jobs expect, derived by Spark from the test tables.

Each derivation keeps every input row; it only reshapes (clicks = events
attached to pages, edges = lineitem supplier -> part links, ...), so the
work of the query grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import padded
from quarry.sources.tables import table

# Fixed values for the derived inputs.
PART_NODE_OFFSET = 50            # edge target id = l_partkey + 50
SENTINEL_FLAG = "A"              # lineitem rows with this return flag carry a missing reading
MISSING_F = 9999.9               # the weather file's missing-value marker (degrees F)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click log (query, url): every event lands on page ``event_id mod #pages``; query = event type."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = pages.agg(F.count(F.lit(1)).alias("n_pages"))  # one row
    ev = (table(spark, sf_dir, "events").select("event_id", "event_type")
          .crossJoin(F.broadcast(n_pages))
          .select((F.col("event_id") % F.col("n_pages")).alias("page_id"), F.col("event_type").alias("query")))
    return ev.join(pages, "page_id").select("query", "url")


def bad_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page URLs plus a scheme-less copy of each (``url`` from its 8th character): half malformed."""
    urls = table(spark, sf_dir, "pages").select("url")
    return urls.unionByName(urls.select(F.substring("url", 8, 1 << 30).alias("url")))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Link graph (src, dst): supplier -> part + offset, one edge per lineitem (duplicates kept)."""
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey")
    return li.select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") + PART_NODE_OFFSET).alias("dst"))


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily readings (station, year, month, day, max_f): lineitem supplier/ship date/quantity.

    Rows flagged ``A`` carry the missing marker instead of a reading.
    """
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_shipdate", "l_quantity", "l_returnflag")
    return li.select(
        F.col("l_suppkey").alias("station"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.dayofmonth("l_shipdate").alias("day"),
        F.when(F.col("l_returnflag") == SENTINEL_FLAG, F.lit(MISSING_F))
         .otherwise(F.col("l_quantity")).cast("float").alias("max_f"))


def readings_c(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather readings with the maximum converted to Celsius (``max_c``)."""
    from quarry.functions.weather import to_celsius

    w = weather(spark, sf_dir)
    return w.select("station", "year", "month", "day", to_celsius("max_f").alias("max_c"))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station file rows as strings (usaf, lat, lon, name) from ``supplier``.

    A negative account balance stands for a station without coordinates.
    """
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    return s.select(
        padded("s_suppkey", 6).alias("usaf"),
        F.when(F.col("s_acctbal") < 0, F.lit("")).otherwise(F.col("s_acctbal").cast("string")).alias("lat"),
        (F.col("s_nationkey") * 7 - 90).cast("string").alias("lon"),
        F.col("s_name").alias("name"))


# Robots texts handed to sites, chosen per host by the first hex
# digit of md5(host); choice 0 means the site has no robots row.
ROBOTS_TEXTS = [
    None,
    "Disallow: /en",
    "Disallow: *.html$\nDisallow: /fr/",
    "Disallow: *#top$",
    "Disallow: /es/\nDisallow: *utm_source=feed$\nDisallow: /de/1$",
    "",
    "User-agent: *\nDisallow: *page=2",
]
SECOND_ROBOTS = "Disallow: /"   # extra row (site = bare host) for hosts with choice 1


def pages_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed page table (row_key, url, disabled): disabled = 'Y' when md5(url)'s 2nd hex digit < '6'."""
    from quarry.functions.url import row_key

    p = table(spark, sf_dir, "pages").select("url")
    rk = row_key("url")
    return p.select(rk.alias("row_key"), "url",
                    F.when(F.substring(rk, 2, 1) < "6", F.lit("Y")).alias("disabled"))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site table (site, robots) for every host of ``pages``."""
    from quarry.functions.url import lenient_host

    hosts = table(spark, sf_dir, "pages").select(lenient_host("url").alias("host")).distinct()
    choice = F.pmod(F.ascii(F.substring(F.md5(F.col("host").cast("binary")), 1, 1)), F.lit(len(ROBOTS_TEXTS)))
    texts = F.array(*[F.lit(t).cast("string") for t in ROBOTS_TEXTS])
    main = hosts.select(F.concat(F.lit("http://"), F.col("host"), F.lit("/")).alias("site"),
                        F.element_at(texts, (choice + 1).cast("int")).alias("robots"), choice.alias("choice"))
    extra = main.filter(F.col("choice") == 1).select(
        F.regexp_extract("site", r"^http://([^/]*)/$", 1).alias("site"), F.lit(SECOND_ROBOTS).alias("robots"))
    return main.select("site", "robots").unionByName(extra)
