"""Compare a registered query with its DuckDB oracle: row count, column names, value hash."""

from __future__ import annotations

import hashlib
import math


def norm(v) -> str:
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return str(v)


def digest(cols, rows) -> tuple[str, list[str]]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()[:12], lines


def duckdb_views(sf_dir: str):
    import duckdb

    from quarry.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> dict:
    df = query(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    ocols, orows = rel.columns, rel.fetchall()
    hs, ls = digest(df.columns, srows)
    ho, lo = digest(ocols, orows)
    ok = sorted(df.columns) == sorted(ocols) and hs == ho and len(srows) == len(orows)
    return {"name": name, "ok": ok, "spark_rows": len(srows), "oracle_rows": len(orows),
            "spark_cols": sorted(df.columns), "oracle_cols": sorted(ocols),
            "spark_only": sorted(set(ls) - set(lo))[:5], "oracle_only": sorted(set(lo) - set(ls))[:5]}
