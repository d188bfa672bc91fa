"""The driver contract: entry() smoke, every query has an oracle, every query matches it."""

import pytest

import __spark_entry__ as E
from quarry.plans.queries import REGISTRY
from quarry.plans.verify import compare, duckdb_views

from .conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["term", "doc_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.queries())
    assert set(REGISTRY) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duckdb_views(SF001)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert r["ok"], r


def test_no_row_caps_except_the_top_k_report():
    """Queries run over whole tables: a LIMIT appears only where it is the feature (top-k)."""
    import pathlib
    import re

    for name in REGISTRY:
        sql = E.oracle_sql()[name]
        if re.search(r"\bLIMIT\b", sql, re.I):
            assert name == "pagerank_top_k", name
    root = pathlib.Path(__file__).resolve().parents[1] / "quarry"
    limits = [(p.name, line.strip()) for p in root.rglob("*.py")
              if p.relative_to(root).parts[0] != "llm" for line in p.read_text().splitlines()
              if ".limit(" in line]
    assert limits == [("graph.py", 'return ranks.orderBy(F.desc("pr"), F.asc("id")).limit(k)')], limits
