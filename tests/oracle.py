"""Run registered queries next to their SQL and compare the rows."""

from __future__ import annotations

import math
import os
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_dir, t)}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (bool, str, bytes)):
        return value
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def ordered(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, str(type(v)), v) if not isinstance(v, (int, float)) or isinstance(v, bool)
                                                                       else (True, "number", v) for v in r))


def difference(spark, con, query, sql, sf_dir) -> str | None:
    """None if both give the same rows, else what differs first."""
    df = query(spark, sf_dir)
    cols, rows = ordered(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names, want = ordered([d[0] for d in cursor.description], cursor.fetchall())
    if cols != names:
        return f"columns {cols} instead of {names}"
    if len(rows) != len(want):
        missing = [r for r in want if r not in set(rows)][:2]
        extra = [r for r in rows if r not in set(want)][:2]
        return f"{len(rows)} rows instead of {len(want)}; missing {missing}, extra {extra}"
    for got, expected in zip(rows, want):
        if got != expected:
            return f"{cols}: {got} instead of {expected}"
    return None
