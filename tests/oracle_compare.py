"""Compare a registered Spark query with its DuckDB oracle: row count, column names and an
order-insensitive multiset of normalised values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if hasattr(v, "item"):
        return v.item()
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(repr(norm(r[i])) for i in order) for r in rows]
    return sorted(out)


def compare(spark_df, con, sql):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns differ: spark-only {sorted(set(s_cols) - set(d_cols))}, "
                        f"oracle-only {sorted(set(d_cols) - set(s_cols))}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count spark={len(s_rows)} oracle={len(d_rows)}")
    a, b = canon(s_rows, s_cols), canon(d_rows, d_cols)
    if a != b:
        sa, sb = set(a), set(b)
        problems.append(f"values differ: e.g. spark {sorted(sa - sb)[:2]} oracle {sorted(sb - sa)[:2]}")
    return problems
