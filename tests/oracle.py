"""Strict comparison of a Spark result with DuckDB on the same Parquet files."""

import math
import os
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value) if value is not None else None


def compare(df, con, sql: str) -> str | None:
    """None when schema and values agree, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    expected = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wrong = {
        f.name: (f.dataType.simpleString(), types[f.name])
        for f in df.schema
        if TYPES.get(f.dataType.simpleString()) != types[f.name]
    }
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    left = Counter(tuple(_key(v) for v in r) for r in rows)
    right = Counter(tuple(_key(v) for v in r) for r in expected)
    if left != right:
        only_left = list((left - right).items())[:3]
        only_right = list((right - left).items())[:3]
        return f"{len(rows)} rows against {len(expected)} {names}: only ours {only_left}, only theirs {only_right}"
    if wrong:
        return f"types {wrong}"
    if not rows:
        return "no rows"
    return None
