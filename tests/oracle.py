"""Local twin of the driver's check: Spark query vs DuckDB oracle."""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out, key=repr)


def compare(spark_df, con, sql: str):
    a = spark_df.toPandas()
    b = con.execute(sql).df()
    ca, ra = rows(a)
    cb, rb = rows(b)
    problems = []
    if ca != cb:
        problems.append(f"columns {ca} vs {cb}")
    if len(ra) != len(rb):
        problems.append(f"rows {len(ra)} vs {len(rb)}")
    elif ra != rb:
        bad = [(x, y) for x, y in zip(ra, rb) if x != y][:3]
        problems.append(f"values differ e.g. {bad}")
    return problems, len(ra)
