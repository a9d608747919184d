"""Compare a Spark result with a DuckDB oracle the way the driver does:
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck_connection(data_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    canon = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    digest = hashlib.sha256("\n".join(canon).encode()).hexdigest()
    return cols, len(canon), digest, canon


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]


def duck_rows(con, sql):
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def compare(df, con, sql) -> tuple[bool, str]:
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    a = canonical(sc, sr)
    b = canonical(dc, dr)
    if a[0] != b[0]:
        return False, f"columns differ: spark={a[0]} duckdb={b[0]}"
    if a[1] != b[1]:
        return False, f"row counts differ: spark={a[1]} duckdb={b[1]}"
    if a[2] != b[2]:
        diff = [x for x, y in zip(a[3], b[3]) if x != y][:3]
        alt = [y for x, y in zip(a[3], b[3]) if x != y][:3]
        return False, f"values differ: spark={diff} duckdb={alt}"
    return True, f"{a[1]} rows"
