"""Side-by-side comparison of a query with its SQL in DuckDB."""

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
DATA = "/root/testdata"

# Spark type -> DuckDB type of the same values.
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        db.sql(f"create view {name} as select * from '{path}'")
    return db


def ordered(rows):
    def key(row):
        return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)

    return sorted((tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows), key=key)


def compare(df, db, sql):
    """Empty when names, types and all values agree; else what differs."""
    relation = db.sql(sql)
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} != {sorted(relation.columns)}"
    types = dict(zip(relation.columns, map(str, relation.types)))
    wrong = {n: (t, types[n]) for n, t in df.dtypes if TYPES.get(t) != types[n]}
    if wrong:
        return f"types {wrong}"
    ours = ordered(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    theirs = ordered(db.sql(f"select {', '.join(chr(34) + n + chr(34) for n in names)} from ({sql})").fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    differing = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(differing)} of {len(ours)} rows, first {differing[0]}" if differing else ""
