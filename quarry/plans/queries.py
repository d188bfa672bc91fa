"""Registered queries: each binds an operator to the test tables at ``sf_dir``.

Every query reads whole tables (or data Spark derives from them); nothing is
sampled, capped or filtered by id to keep it cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarry.operators import text as text_ops
from quarry.session import ensure_importable
from quarry.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    """Add a query to the registry; the registered callable first ships the package to workers."""
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_importable(spark)
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return fn
    return deco


# ---------------------------------------------------------------- text (A1-A4)

@register("doc_frequency")
def q_doc_frequency(spark, sf_dir):
    return text_ops.doc_frequency(table(spark, sf_dir, "documents").select("text"))


@register("term_frequency")
def q_term_frequency(spark, sf_dir):
    return text_ops.term_frequency(table(spark, sf_dir, "documents").select("text"))


@register("word_count")
def q_word_count(spark, sf_dir):
    return text_ops.word_count(table(spark, sf_dir, "conversations").select("text"))


@register("word_count_ws")
def q_word_count_ws(spark, sf_dir):
    return text_ops.word_count_ws(table(spark, sf_dir, "conversations").select("text"))


# ---------------------------------------------------------------- hosts
from quarry.operators import hosts as host_ops  # noqa: E402
from quarry.plans import derived  # noqa: E402

MIN_CLICKS = 30


def _page_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("url")


@register("host_counts")
def q_host_counts(spark, sf_dir):
    return host_ops.host_counts(_page_urls(spark, sf_dir))


@register("host_percent")
def q_host_percent(spark, sf_dir):
    return host_ops.host_percent(_page_urls(spark, sf_dir))


@register("host_counts_tagged")
def q_host_counts_tagged(spark, sf_dir):
    return host_ops.host_counts_tagged(_page_urls(spark, sf_dir))


@register("malformed_url_count")
def q_malformed_url_count(spark, sf_dir):
    return host_ops.url_quality(derived.bad_urls(spark, sf_dir))


@register("top_query_per_host")
def q_top_query_per_host(spark, sf_dir):
    return host_ops.top_query_per_host(derived.clicks(spark, sf_dir))


@register("top_query_per_host_min")
def q_top_query_per_host_min(spark, sf_dir):
    return host_ops.top_query_per_host(derived.clicks(spark, sf_dir), min_clicks=MIN_CLICKS)


@register("top_query_per_host_as_written")
def q_top_query_per_host_as_written(spark, sf_dir):
    return host_ops.top_query_per_host(derived.clicks(spark, sf_dir), min_clicks=MIN_CLICKS,
                                       emit_below_threshold=True)


@register("host_bucket_sorted")
def q_host_bucket_sorted(spark, sf_dir):
    hosts = host_ops.host_counts(_page_urls(spark, sf_dir)).select("host")
    return host_ops.range_sorted_by_host(hosts).withColumn("bucket", host_ops.first_char_bucket("host"))


# ---------------------------------------------------------------- weather
from quarry.operators import weather as weather_ops  # noqa: E402

ON_THIS_DAY = (9, 3)  # 9 March


def _hottest(spark, sf_dir):
    return weather_ops.hottest_year(derived.readings_c(spark, sf_dir), tenths=True)


@register("hottest_year_per_station_day")
def q_hottest_year(spark, sf_dir):
    return _hottest(spark, sf_dir)


@register("weather_skipped")
def q_weather_skipped(spark, sf_dir):
    return weather_ops.skipped_readings(derived.readings_c(spark, sf_dir))


@register("station_label_join")
def q_station_label_join(spark, sf_dir):
    return weather_ops.station_labels(_hottest(spark, sf_dir), derived.stations(spark, sf_dir))


@register("station_missing")
def q_station_missing(spark, sf_dir):
    return weather_ops.stations_missing(_hottest(spark, sf_dir), derived.stations(spark, sf_dir))


@register("on_this_day")
def q_on_this_day(spark, sf_dir):
    return weather_ops.on_this_day(_hottest(spark, sf_dir), *ON_THIS_DAY)


# ---------------------------------------------------------------- robots + keyed table
from quarry.operators import keyed as keyed_ops  # noqa: E402
from quarry.operators import robots as robots_ops  # noqa: E402


@register("robots_status_changes")
def q_robots_status_changes(spark, sf_dir):
    return robots_ops.status_changes(derived.pages_table(spark, sf_dir), derived.sites(spark, sf_dir))


@register("robots_reconciled")
def q_robots_reconciled(spark, sf_dir):
    return robots_ops.reconciled(derived.pages_table(spark, sf_dir), derived.sites(spark, sf_dir))


@register("robots_reconciled_salted")
def q_robots_reconciled_salted(spark, sf_dir):
    """Same result by the salted join, with hosts of more than 100 pages spread."""
    return robots_ops.reconciled(derived.pages_table(spark, sf_dir), derived.sites(spark, sf_dir),
                                 salted=True, rows_per_partition=100)


@register("robots_reconciled_lookup")
def q_robots_reconciled_lookup(spark, sf_dir):
    """Same result with every host's rules looked up by their literals."""
    return robots_ops.reconciled(derived.pages_table(spark, sf_dir), derived.sites(spark, sf_dir), many_rules=0)


@register("keyed_upsert_delete")
def q_keyed_upsert_delete(spark, sf_dir):
    base = derived.pages_table(spark, sf_dir)
    changes = robots_ops.changes_as_cells(robots_ops.status_changes(base, derived.sites(spark, sf_dir)))
    return keyed_ops.merge_cells(base, changes, "disabled")


@register("first_per_key")
def q_first_per_key(spark, sf_dir):
    from quarry.functions.url import lenient_host

    p = table(spark, sf_dir, "pages").select(lenient_host("url").alias("host"), "url", "page_id")
    return keyed_ops.first_per_key(p, "host", "url", order_col="page_id")


# ---------------------------------------------------------------- graph + PageRank
from quarry.operators import graph as graph_ops  # noqa: E402

PR_ITERATIONS = 3
PR_DIGITS = 8


@register("edges_distinct")
def q_edges_distinct(spark, sf_dir):
    return graph_ops.edges_distinct(derived.edges(spark, sf_dir))


@register("adjacency_list")
def q_adjacency_list(spark, sf_dir):
    return graph_ops.adjacency(derived.edges(spark, sf_dir))


@register("graph_nodes")
def q_graph_nodes(spark, sf_dir):
    return graph_ops.graph_nodes(derived.edges(spark, sf_dir))


@register("dangling_nodes")
def q_dangling_nodes(spark, sf_dir):
    return graph_ops.dangling_nodes(derived.edges(spark, sf_dir))


def _pagerank(spark, sf_dir, variant, dangling="redistribute", iterations=PR_ITERATIONS):
    return graph_ops.pagerank(derived.edges(spark, sf_dir), iterations=iterations, variant=variant,
                              dangling=dangling, digits=PR_DIGITS).ranks


@register("pagerank_multi")
def q_pagerank_multi(spark, sf_dir):
    return _pagerank(spark, sf_dir, "multi")


@register("pagerank_set")
def q_pagerank_set(spark, sf_dir):
    return _pagerank(spark, sf_dir, "set")


@register("pagerank_set_ignore_dangling")
def q_pagerank_set_ignore(spark, sf_dir):
    return _pagerank(spark, sf_dir, "set", "ignore")


@register("pagerank_top_k")
def q_pagerank_top_k(spark, sf_dir):
    return graph_ops.top_k(_pagerank(spark, sf_dir, "set"))


# ---------------------------------------------------------------- file layouts
from quarry.plans import files as file_plans  # noqa: E402

for _name in ("fixed_records", "rewritten_records", "indexed_chunks_doc_frequency", "proto_docs", "bulk_sorted_load",
              "kv_lines", "edge_lines", "fixed_width_weather"):
    register(_name)(getattr(file_plans, _name))


# ---------------------------------------------------------------- sized term frequency (A4 + P9)
SIZE_RANGE = (9 * 1024, 10 * 1024)  # the reference's 9-10 KiB check


@register("term_frequency_sized")
def q_term_frequency_sized(spark, sf_dir):
    """A4 over documents whose stored size lies in the range (pushed to the Parquet scan)."""
    from pyspark.sql import functions as F

    lo, hi = SIZE_RANGE
    docs = table(spark, sf_dir, "documents").filter(F.col("n_chars").between(lo, hi)).select("text")
    return text_ops.term_frequency(docs)


@register("document_size_check")
def q_document_size_check(spark, sf_dir):
    """P8 + A18: counts (not drops) documents outside the size range."""
    from pyspark.sql import functions as F

    lo, hi = SIZE_RANGE
    d = table(spark, sf_dir, "documents").select("n_chars")
    return d.agg(F.count(F.lit(1)).alias("documents"),
                 F.count_if(~F.col("n_chars").between(lo, hi)).alias("out_of_range"))


@register("robots_rule_counts")
def q_robots_rule_counts(spark, sf_dir):
    """F22 + D12: per host with robots, the compiled rules and the skipped (non-rule) lines."""
    from pyspark.sql import functions as F

    r = robots_ops.site_rules(derived.sites(spark, sf_dir))
    return r.select("host", F.size("rules").cast("long").alias("rules"), F.col("skipped_lines").cast("long").alias("skipped"))


# ---------------------------------------------------------------- layouts, counters and files made visible
from quarry.plans import more  # noqa: E402

for _name in more.NAMES:
    register(_name)(getattr(more, _name))
