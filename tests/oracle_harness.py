"""Compare a catalogue query with its DuckDB oracle the way the driver does:
columns sorted by name, row count, then an order-insensitive multiset of rows."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, Decimal):
        return float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "toArray"):
        return tuple(float(x) for x in v.toArray())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return [tuple(_norm(r[i]) for i in order) for r in rows]


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = _rows(s_cols, [tuple(r) for r in spark_df.collect()])
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = _rows(d_cols, res.fetchall())
    out = {
        "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "columns_match": sorted(c.lower() for c in s_cols) == sorted(c.lower() for c in d_cols),
    }
    cs, cd = Counter(s_rows), Counter(d_rows)
    out["values_match"] = cs == cd
    if not out["values_match"]:
        out["only_spark"] = list((cs - cd).elements())[:5]
        out["only_oracle"] = list((cd - cs).elements())[:5]
    out["ok"] = out["columns_match"] and out["values_match"] and len(s_rows) == len(d_rows)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = s_cols, d_cols
    return out
