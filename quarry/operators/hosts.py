"""Per-host analytics over URL logs.

Scale notes: every grouping is a hash/sort aggregate with a partial stage,
so a host that holds a third of all hits contributes one row per input
partition to the shuffle.  The grand total for the share is a one-row
aggregate joined by broadcast (its size is one row by construction), never a
``Window.partitionBy()`` over all rows, which would pull everything into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.url import strict_host

# Fixed values of the reference's range partitioner for best-query output.
FIRST_LETTER, LAST_LETTER = "a", "z"
SEO_PARTITIONS = 35


def host_counts(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """A5: hits per host; malformed URLs skipped (P5) -> (host, hits)."""
    # malformed URLs make one group of no counted host: a filter on hosts would match the pattern again
    h = urls.select(strict_host(url_col).alias("host"))
    return h.groupBy("host").agg(F.count("host").alias("hits")).filter("hits > 0")


def host_percent(urls: DataFrame, url_col: str = "url", digits: int = 6) -> DataFrame:
    """A6 (intended) + A7 + J8: share of all well-formed hits per host, in percent.

    -> (host, hits, percent).  The total is a separate one-row aggregate over
    the per-host counts (which Spark reuses), cross-joined by broadcast.
    """
    counts = host_counts(urls, url_col)
    total = counts.agg(F.sum("hits").alias("total_hits"))
    return (counts.crossJoin(F.broadcast(total))
            .select("host", "hits",
                    F.round(F.col("hits") * 100.0 / F.col("total_hits"), digits).alias("percent")))


def host_counts_tagged(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """A6 as written (D2): the raw count as FLOAT under the key ``H:<host>`` -> (key, value)."""
    return host_counts(urls, url_col).select(
        F.concat(F.lit("H:"), F.col("host")).alias("key"), F.col("hits").cast("float").alias("value"))


def url_quality(urls: DataFrame, url_col: str = "url") -> DataFrame:
    """P5 + A18: one row of counters (urls, malformed_urls, hosts)."""
    h = urls.select(strict_host(url_col).alias("host"))
    return h.agg(F.count(F.lit(1)).alias("urls"),
                 F.count_if(F.col("host").isNull()).alias("malformed_urls"),
                 F.count_distinct("host").alias("hosts"))


def top_query_per_host(clicks: DataFrame, query_col: str = "query", url_col: str = "url",
                       min_clicks: int = 0, emit_below_threshold: bool = False) -> DataFrame:
    """Most clicked query per host; ties go to the smallest query.

    -> (host, query, clicks).  Hosts whose best query has fewer than
    ``min_clicks`` clicks are dropped, or (``emit_below_threshold``, as the
    reference writes them, D4) reported as ``(host, '', min_clicks - 1)``.
    """
    pairs = (clicks.select(strict_host(url_col).alias("host"), F.col(query_col).alias("query"))
             .groupBy("host", "query").agg(F.count("host").alias("clicks")).filter("clicks > 0"))
    # min over (-clicks, query) == largest count, then smallest query; partial-aggregated.
    best = (pairs.groupBy("host")
            .agg(F.min(F.struct((-F.col("clicks")).alias("neg"), F.col("query"))).alias("b"))
            .select("host", F.col("b.query").alias("query"), (-F.col("b.neg")).alias("clicks")))
    if min_clicks <= 1:
        return best
    if emit_below_threshold:
        below = F.col("clicks") < min_clicks
        return best.select("host",
                           F.when(below, F.lit("")).otherwise(F.col("query")).alias("query"),
                           F.when(below, F.lit(min_clicks - 1).cast("long")).otherwise(F.col("clicks")).alias("clicks"))
    return best.filter(F.col("clicks") >= min_clicks)


def first_char_bucket(host_col: str = "host", n: int = SEO_PARTITIONS):
    """O4 as written: bucket by the first character (below 'a' -> 0, above 'z' -> n-1)."""
    c = F.col(host_col)
    code = F.ascii(c)  # empty host -> 0, falls into the first range (D19)
    lin = ((code - F.ascii(F.lit(FIRST_LETTER))).cast("float")
           / F.lit(float(ord(LAST_LETTER) - ord(FIRST_LETTER) + 1)) * F.lit(float(n))).cast("int")
    return (F.when(code < ord(FIRST_LETTER), F.lit(0))
            .when(code > ord(LAST_LETTER), F.lit(n - 1))
            .otherwise(lin))


def range_sorted_by_host(df: DataFrame, n: int = SEO_PARTITIONS, host_col: str = "host") -> DataFrame:
    """O4 intent + O3: part files that, concatenated, are ordered by host (sampled range bounds)."""
    return df.repartitionByRange(n, host_col).sortWithinPartitions(host_col)


def letter_range_parts(df: DataFrame, n: int = SEO_PARTITIONS, host_col: str = "host") -> DataFrame:
    """O4 as written: the rows of bucket ``b`` in partition ``b`` of ``n``, sorted by host."""
    return df.repartitionById(n, first_char_bucket(host_col, n)).sortWithinPartitions(host_col)
