"""Compare a Spark result with DuckDB over the same Parquet tables."""

import glob
import math
import os
from collections import Counter

import duckdb

TESTDATA = "/root/testdata"


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        assert not math.isnan(value), "NaN must never be produced"
    return value


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(normal(r[i]) for i in order) for r in data)


KINDS = {
    "VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean",
    "INTEGER": "int", "TIMESTAMP": "timestamp_ntz",
}


def mismatch(df, con, sql):
    """None if columns, types and rows agree, else a description."""
    expected = con.execute(sql)
    types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in expected.description}
    if types != dict(df.dtypes):
        return f"types differ: {dict(df.dtypes)} against {types}"
    want = rows(list(types), expected.fetchall())
    have = rows(df.columns, [tuple(r) for r in df.collect()])
    if want != have:
        return f"{list((have - want).items())[:3]} against {list((want - have).items())[:3]}"
    return None
