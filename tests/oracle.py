"""Compare a registered query with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, Decimal)):
        v = float(v)
        if math.isnan(v):
            return "nan"
        return int(v) if v == int(v) else v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(timespec="microseconds")
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP",
    "string": "VARCHAR", "boolean": "BOOLEAN",
}


def compare(df, con, sql) -> str | None:
    """None if equal in names, types and values, else what differs."""
    types = {c[0]: str(c[1]) for c in con.execute(f"describe {sql}").fetchall()}
    odd = {c: (t, types.get(c)) for c, t in df.dtypes if TYPES.get(t) != types.get(c)}
    if odd:
        return f"types {odd}"
    got = rows(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None
