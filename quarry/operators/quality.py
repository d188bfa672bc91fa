"""Data-quality counters (A18) as ``Observation`` metrics collected by the action itself.

The reference increments named job counters from its mappers.  A Spark
``Observation`` is filled by the action that runs the plan, once per
successful query run.  For counters that must be exact under stage retries,
use the one-row aggregate variants in the operator modules instead
(``url_quality``, ``skipped_readings``, ``bad_url_base64_lines``, ``chunk_errors``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation


def observed(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """Attach named counters: ``df2, obs = observed(df, 'COMMON_COUNTERS', bad=count_if(...))``;
    after an action on ``df2``, ``obs.get`` maps each name to its value."""
    obs = Observation(name)
    exprs = [c.alias(k) for k, c in counters.items()]
    return df.observe(obs, *exprs), obs
