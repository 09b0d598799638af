"""Compare a Spark result with the checking SQL's: columns, types and rows in any order."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return v


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    columns = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != columns:
        return f"columns: {columns} against {sorted(rel.columns)}"
    types = dict(zip(rel.columns, map(str, rel.types)))
    odd = {c: (t, types[c]) for c, t in df.dtypes if TYPES.get(t) != types[c]}
    if odd:
        return f"types: {odd}"
    order = [rel.columns.index(c) for c in columns]
    want = Counter(tuple(_plain(r[i]) for i in order) for r in rel.fetchall())
    got = Counter(tuple(_plain(v) for v in r) for r in df.select(*columns).collect())
    if want == got:
        return None
    extra, missing = got - want, want - got
    return (
        f"rows: {sum(got.values())} against {sum(want.values())}; columns {columns}\n"
        f"only Spark {sum(extra.values())}: {str(sorted(extra, key=str)[:2])[:1500]}\n"
        f"only SQL {sum(missing.values())}: {str(sorted(missing, key=str)[:2])[:1500]}"
    )
