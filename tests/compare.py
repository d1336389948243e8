"""Compare a Spark result with SQL over the same tables, as bags of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
         "BOOLEAN": "boolean"}


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bags(df, con, sql) -> tuple[Counter, Counter]:
    columns = sorted(df.columns)
    ours = Counter(tuple(_cell(v) for v in r) for r in df.select(*columns).collect())
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    assert {d[0]: TYPES[str(d[1])] for d in found.description} == dict(df.dtypes)
    order = [names.index(c) for c in columns]
    theirs = Counter(tuple(_cell(row[i]) for i in order) for row in found.fetchall())
    return ours, theirs
