"""Comparison of a Spark result with the SQL result on the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
PAIRS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP",
    "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v) -> str:
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return str(v)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of Spark rows and a list of differences (empty when equal)."""
    cols = sorted(df.columns)
    mine = sorted(tuple(_cell(v) for v in row) for row in df.select(*[f"`{c}`" for c in cols]).collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != cols:
        return len(mine), [f"columns {cols} / {sorted(names)}"]
    kinds = dict(df.dtypes)
    problems = [
        f"type of {d[0]}: {kinds[d[0]]} / {d[1]}" for d in result.description if PAIRS.get(kinds[d[0]]) != str(d[1])
    ]
    order = [names.index(c) for c in cols]
    theirs = sorted(tuple(_cell(row[i]) for i in order) for row in result.fetchall())
    if mine != theirs:
        extra, lacking = sorted(set(mine) - set(theirs)), sorted(set(theirs) - set(mine))
        problems.append(f"rows {len(mine)} / {len(theirs)}, columns {cols}")
        problems += [f"  spark {r}" for r in extra[:3]] + [f"  sql   {r}" for r in lacking[:3]]
    return len(mine), problems
