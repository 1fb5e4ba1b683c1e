"""Test helper: compare a Spark result with a DuckDB oracle result (order-insensitive).

Collects both results on the driver, so it is for small verification runs only.
"""

from __future__ import annotations

import hashlib
import math

import duckdb
import pandas as pd

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()  # numpy scalar -> Python scalar
    if isinstance(v, bool):
        return v
    if isinstance(v, float) and v.is_integer() and abs(v) < 2**53:
        return int(v)  # nullable BIGINT arrives as float64 from toPandas
    if isinstance(v, float) and v == 0.0:
        return 0.0
    return v


def frame_digest(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = sorted(repr(tuple(_norm(v) for v in r)) for r in df[cols].itertuples(index=False, name=None))
    h = hashlib.sha256("\n".join(rows).encode()).hexdigest()
    return len(df), cols, h


def compare(spark_df, con, sql: str) -> dict:
    s = spark_df.toPandas()
    o = con.execute(sql).fetchdf()
    s = s.astype(object).where(pd.notnull(s), None)
    o = o.astype(object).where(pd.notnull(o), None)
    sd, od = frame_digest(s), frame_digest(o)
    return {"rows": (sd[0], od[0]), "cols_match": sd[1] == od[1], "hash_match": sd[2] == od[2],
            "spark_cols": sd[1], "oracle_cols": od[1]}
