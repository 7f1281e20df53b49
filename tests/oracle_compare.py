"""Local stand-in for the driver's check: run a Spark query and its DuckDB SQL
on the same parquet tables and compare row count, column names and an
order-insensitive multiset of rounded values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.sql(sql).df()


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return "NULL"
    if hasattr(v, "tolist") and not isinstance(v, (int, float, str)):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 6):.6f}"
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, int) and not isinstance(v, bool):
        return f"{float(v):.6f}"
    return str(v)


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out)


def compare(spark_df, sql: str, sf_dir: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = duck(sql, sf_dir)
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: spark={sorted(s.columns)} duck={sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row counts differ: spark={len(s)} duck={len(d)}"
    rs, rd = rows_of(s), rows_of(d)
    if rs != rd:
        diff = [(a, b) for a, b in zip(rs, rd) if a != b][:3]
        return False, f"values differ, first: {diff}"
    return True, f"ok ({len(s)} rows)"


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "smallint": "SMALLINT", "float": "FLOAT", "boolean": "BOOLEAN"}


def type_diffs(spark_df, sql: str, sf_dir: str) -> list[tuple]:
    """Columns whose Spark type differs from the DuckDB result type."""
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rel = con.sql(sql)
    d = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    s = dict(spark_df.dtypes)
    return [(c, s.get(c), d.get(c)) for c in sorted(set(s) | set(d))
            if SPARK_TO_DUCK.get(s.get(c), s.get(c)) != d.get(c)]
