"""Side-by-side run of a query and its oracle SQL."""

from __future__ import annotations

import math

import duckdb

from quayside.tables import TABLE_NAMES

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
    "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def rows_of(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in at) for r in rows), key=repr)


def difference(df, sql: str, con) -> str | None:
    """None when schema and rows are equal, else what differs."""
    rel = con.execute(sql)
    want_types = {d[0]: str(d[1]) for d in rel.description}
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    want_types = {d[0]: d[1] for d in desc}
    want = con.execute(sql).fetchall()
    got_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if got_types != want_types:
        return f"schema {got_types} != {want_types}"
    got = df.collect()
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(list(want_types), want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first {bad[0]}"
    return None
