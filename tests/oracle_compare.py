"""Compare a Spark query with its DuckDB oracle the way the driver does:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    return str(v)


def table_hash(columns, rows) -> tuple[int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_cols = spark_df.columns
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    sn, sh = table_hash(s_cols, s_rows)
    dn, dh = table_hash(d_cols, d_rows)
    return {
        "rows_spark": sn, "rows_oracle": dn,
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "cols_spark": s_cols, "cols_oracle": d_cols,
        "hash_match": sh == dh,
    }
