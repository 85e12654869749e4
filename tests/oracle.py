"""Side-by-side comparison of a query with its SQL."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
)


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is not None, "" if v is None else str(v)) for v in row)


def _type_class(name: str) -> str:
    name = name.lower()
    if name in ("bigint", "integer", "int", "hugeint"):
        return "int" if name in ("integer", "int") else name
    if name.startswith("timestamp"):
        return "timestamp"
    return {"varchar": "string"}.get(name, name)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a Spark result and SQL, exact on every value."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = {d[0]: _type_class(str(d[1])) for d in result.description}
    theirs = result.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    spark_types = {c: _type_class(t) for c, t in df.dtypes}
    for c in names:
        if spark_types[c] != types[c]:
            found.append(f"type of {c}: {spark_types[c]} != {types[c]}")
    order = sorted(names)
    ours = sorted((tuple(r[c] for c in order) for r in df.select(*order).collect()), key=_key)
    at = [names.index(c) for c in order]
    theirs = sorted((tuple(r[i] for i in at) for r in theirs), key=_key)
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    for a, b in zip(ours, theirs, strict=False):
        same = all(
            x == y or (isinstance(x, float) and isinstance(y, float) and math.isnan(x) and math.isnan(y))
            for x, y in zip(a, b, strict=True)
        )
        if not same:
            found.append(f"{a} != {b}")
            break
    return found
