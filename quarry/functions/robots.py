"""Robots rules as data: compile ``Disallow:`` lines to (kind, literal) and match paths.

A rule never becomes a regular expression: each kind is a plain string
predicate Spark evaluates in generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rule-line prefix, the wildcard and end-anchor characters,
# and the four predicate kinds.
RULE_PREFIX = "Disallow: "
WILDCARD = "*"
END_ANCHOR = "$"
PREFIX, EXACT, CONTAINS, SUFFIX = "prefix", "exact", "contains", "suffix"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _rule(text: Column) -> Column:
    """One rule text (after the prefix) -> struct(kind, literal).

    ``/lit`` prefix, ``/lit$`` exact, ``*lit`` contains, ``*lit$`` suffix.
    Any other text is taken literally: ``lit$`` suffix, ``lit`` exact (D8).
    """
    anchored = text.endswith(END_ANCHOR)
    starred = text.startswith(WILDCARD)
    body = F.when(starred, F.substring(text, 2, 1 << 30)).otherwise(text)
    body = F.when(anchored, F.substring(body, F.lit(1), F.length(body) - 1)).otherwise(body)
    kind = (F.when(text.startswith("/"), F.when(anchored, F.lit(EXACT)).otherwise(F.lit(PREFIX)))
            .when(starred, F.when(anchored, F.lit(SUFFIX)).otherwise(F.lit(CONTAINS)))
            .when(anchored, F.lit(SUFFIX))
            .otherwise(F.lit(EXACT)))
    return F.struct(kind.alias("kind"), body.alias("literal"))


def compile_rules(robots) -> Column:
    """Robots text -> ARRAY<STRUCT<kind, literal>>; lines without the prefix are skipped.

    NULL or empty text gives an empty array (everything allowed).
    """
    lines = F.split(F.coalesce(_col(robots), F.lit("")), "\n")
    kept = F.filter(lines, lambda l: l.startswith(RULE_PREFIX))
    return F.transform(kept, lambda l: _rule(F.substring(l, len(RULE_PREFIX) + 1, 1 << 30)))


def skipped_rule_lines(robots) -> Column:
    """Number of non-empty robots lines that are not ``Disallow:`` rules (D12 counter)."""
    lines = F.split(F.coalesce(_col(robots), F.lit("")), "\n")
    return F.size(F.filter(lines, lambda l: (l != "") & ~l.startswith(RULE_PREFIX)))


def rule_matches(rule: Column, path: Column) -> Column:
    """Does one compiled rule match the whole path."""
    k, lit = rule["kind"], rule["literal"]
    return (F.when(k == PREFIX, path.startswith(lit))
            .when(k == EXACT, path == lit)
            .when(k == CONTAINS, path.contains(lit))
            .otherwise(path.endswith(lit)))


def is_disallowed(rules, path) -> Column:
    """J4 inside one host: any rule matches (stops at the first match); no rules -> False."""
    return F.coalesce(F.exists(_col(rules), lambda r: rule_matches(r, _col(path))), F.lit(False))
