"""Robots-rule reconciliation of a page table's ``disabled`` flag.

The reference tags page and robots rows, shuffles both by host and sorts the
robots row first.  Here each site's robots text is compiled once into an
array of (kind, literal) rules, pages are joined to it on host (left outer:
a host without robots allows everything), and ``exists`` over the array
decides each page.  The join is a size-checked broadcast, or a shuffle join
that splits hot hosts (``skew_safe_join``).  Pages of hosts with very many rules are
looked up instead: the beginnings and ends of a path, of the lengths that its
host's rules have, are joined to the rules' literals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import robots as R
from quarry.functions.url import lenient_host, lenient_path, row_key
from quarry.operators.joins import skew_safe_join

DISABLED = "Y"
MANY_RULES = 1000  # a host with more is looked up by literals
PUT, DELETE = "put", "delete"


def site_rules(sites: DataFrame, site_col: str = "site", robots_col: str = "robots") -> DataFrame:
    """One compiled rule array per host -> (host, rules, skipped_lines).

    Rows without robots are ignored; two robots rows for one host: the
    smallest site string wins (D11).
    """
    s = (sites.filter(F.col(robots_col).isNotNull())
         .select(lenient_host(site_col).alias("host"), F.struct(F.col(site_col), F.col(robots_col)).alias("r")))
    one = s.groupBy("host").agg(F.min("r").alias("r"))
    return one.select("host", R.compile_rules(F.col("r")[robots_col]).alias("rules"),
                      R.skipped_rule_lines(F.col("r")[robots_col]).alias("skipped_lines"))


def page_status(pages: DataFrame, sites: DataFrame, url_col: str = "url", disabled_col: str = "disabled",
                many_rules: int | None = None, **join_opts) -> DataFrame:
    """Every page with its old and new state -> (row_key, url, was, dis).

    ``many_rules``: hosts with more rules go through ``literal_matches`` (None: no host does;
    ``many_rules_in`` tells by the sites whether one needs it).  That reads the pages twice.
    """
    p = pages.select(row_key(url_col).alias("row_key"), F.col(url_col).alias("url"),
                     F.col(disabled_col).isNotNull().alias("was"),
                     lenient_host(url_col).alias("host"), lenient_path(url_col).alias("path"))
    rules = site_rules(sites).select("host", "rules")
    out = ("row_key", "url", "was")
    if many_rules is None:
        j = skew_safe_join(p, rules, "host", "left", **join_opts)
        return j.select(*out, R.is_disallowed("rules", "path").alias("dis"))
    many = F.size("rules") > many_rules
    few = rules.select("host", F.when(~many, F.col("rules")).alias("rules"), many.alias("many"))
    j = skew_safe_join(p, few, "host", "left", **join_opts).filter(~F.coalesce("many", F.lit(False)))
    own = rules.filter(many)
    return (j.select(*out, R.is_disallowed("rules", "path").alias("dis"))
            .unionByName(_looked_up(p, own, join_opts).select(*out, "dis")))


def many_rules_in(sites: DataFrame) -> int | None:
    """``MANY_RULES`` if a host has more rules, else None (one pass over the sites)."""
    return None if site_rules(sites).filter(F.size("rules") > MANY_RULES).isEmpty() else MANY_RULES


def _looked_up(pages: DataFrame, rules: DataFrame, join_opts: dict) -> DataFrame:
    """Pages of the hosts in ``rules`` with ``dis``, without holding a page against all rules of its host."""
    each = rules.select("host", F.explode("rules").alias("r")).select("host", "r.kind", "r.literal").distinct()
    # a host's rules with a literal of a length are found by that length alone
    lengths = each.filter(F.col("kind") != R.CONTAINS).groupBy("host").agg(
        F.collect_set(F.struct("kind", F.length("literal").alias("n"))).alias("lengths"))
    scanned = each.filter(F.col("kind") == R.CONTAINS).groupBy("host").agg(F.collect_set("literal").alias("inside"))
    known = rules.select("host").join(lengths, "host", "left").join(scanned, "host", "left")
    j = skew_safe_join(pages, known, "host", "inner", **join_opts)
    hits = literal_matches(j.select("host", "path", "lengths").dropDuplicates(["host", "path"]), each)
    inside = F.coalesce(F.exists("inside", lambda lit: F.col("path").contains(lit)), F.lit(False))
    return (j.join(hits.withColumn("hit", F.lit(True)), ["host", "path"], "left")
            .select("row_key", "url", "was", (inside | F.coalesce("hit", F.lit(False))).alias("dis")))


def literal_matches(paths: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path) that a prefix, exact or suffix rule of the host matches.

    ``paths``: (host, path, lengths), ``lengths`` being the (kind, n) of the host's rules;
    ``rules``: (host, kind, literal).  An equi-join on (host, kind, literal): a path meets one
    key for every kind and length that its host has and that fits into it.
    """
    n, kind, path = F.col("l.n"), F.col("l.kind"), F.col("path")
    key = F.when(kind == R.SUFFIX, F.substring(path, F.length(path) - n + 1, n)).otherwise(F.substring(path, F.lit(1), n))
    keys = (paths.select("host", "path", F.explode("lengths").alias("l"))
            .filter((n <= F.length(path)) & ((kind != R.EXACT) | (n == F.length(path))))
            .select("host", "path", "l.kind", key.alias("literal")))
    return keys.join(rules, ["host", "kind", "literal"], "left_semi").select("host", "path").distinct()


def status_changes(pages: DataFrame, sites: DataFrame, **kw) -> DataFrame:
    """The change set -> (row_key, url, op) with op ``put`` (newly disallowed) or ``delete``."""
    st = page_status(pages, sites, **kw)
    op = (F.when(F.col("dis") & ~F.col("was"), F.lit(PUT))
          .when(~F.col("dis") & F.col("was"), F.lit(DELETE)))
    return st.select("row_key", "url", op.alias("op")).filter(F.col("op").isNotNull())


def reconciled(pages: DataFrame, sites: DataFrame, **kw) -> DataFrame:
    """The page table after applying the change set, in the same pass -> (row_key, url, disabled)."""
    st = page_status(pages, sites, **kw)
    return st.select("row_key", "url", F.when(F.col("dis"), F.lit(DISABLED)).alias("disabled"))


def changes_as_cells(changes: DataFrame) -> DataFrame:
    """Change set -> cell operations (row_key, op, value) for :func:`quarry.operators.keyed.merge_cells`."""
    return changes.select("row_key", "op",
                          F.when(F.col("op") == PUT, F.lit(DISABLED)).cast("string").alias("value"))
