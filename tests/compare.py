"""Spark query vs DuckDB oracle comparison (row count, column names, values)."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in RAW_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return names, data


def compare(spark_df, con, sql: str):
    s_rows = [tuple(r) for r in spark_df.collect()]
    s_names, s_data = canonical(spark_df.columns, s_rows)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_names, d_data = canonical(d_cols, res.fetchall())
    problems = []
    if s_names != d_names:
        problems.append(f"columns differ: spark-only {sorted(set(s_names) - set(d_names))} "
                        f"oracle-only {sorted(set(d_names) - set(s_names))}")
    if len(s_data) != len(d_data):
        problems.append(f"rows spark={len(s_data)} oracle={len(d_data)}")
    if not problems and s_data != d_data:
        diff = next(i for i, (a, b) in enumerate(zip(s_data, d_data)) if a != b)
        bad = [(s_names[j], s_data[diff][j], d_data[diff][j])
               for j in range(len(s_names)) if s_data[diff][j] != d_data[diff][j]]
        problems.append(f"values differ at sorted row {diff}: {bad[:6]}")
    return len(s_data), problems
