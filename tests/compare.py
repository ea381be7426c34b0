"""Compare a Spark result with the result of its SQL equivalent in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if hasattr(v, "asDict"):
        return tuple((k, norm(x)) for k, x in sorted(v.asDict().items()))
    if isinstance(v, dict):
        return tuple((k, norm(x)) for k, x in sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return v
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.12g}")
    if isinstance(v, int):
        return float(v)
    if type(v).__name__ == "Decimal":
        return float(v)
    return str(v)


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def difference(spark_df, con, sql):
    """Empty text when both sides agree, else a short report."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    expected = bag(names, cur.fetchall())
    got = bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    bad = [
        f"{c}: {t} vs {types[c]}" for c, t in spark_df.dtypes
        if kinds.get(t) and types[c] not in (kinds[t], "STRING" if t == "string" else kinds[t], "NUMBER")
    ]
    note = f" [types {bad}]" if bad else ""
    if got == expected:
        return note.strip() and ("types only" + note)
    return (
        f"rows {sum(got.values())} vs {sum(expected.values())}; "
        f"only spark {list((got - expected).items())[:3]}; only sql {list((expected - got).items())[:3]}{note}"
    )
