"""Compare registered queries with their SQL in DuckDB."""

from __future__ import annotations

import datetime
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf, t)}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return "NaN" if math.isnan(x) else round(x, 6) + 0.0
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, dict):
        return tuple((k, plain(v)) for k, v in x.items())
    if isinstance(x, (list, tuple)):
        return tuple(plain(v) for v in x)
    return x


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(plain(v) for v in r) for r in df.select(*names).collect()), key=repr)


def duck_rows(con, sql):
    rel = con.sql(sql)
    names = sorted(rel.columns)
    at = [rel.columns.index(n) for n in names]
    return names, sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)


SPARK_TO_DUCK = {
    "string": {"VARCHAR"},
    "int": {"INTEGER"},
    "bigint": {"BIGINT"},
    "double": {"DOUBLE"},
    "float": {"FLOAT"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def type_gaps(df, con, sql):
    rel = con.sql(sql)
    duck = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return {
        n: (t, duck.get(n)) for n, t in df.dtypes if t in SPARK_TO_DUCK and duck.get(n) not in SPARK_TO_DUCK[t]
    } | {n: (t, duck.get(n)) for n, t in df.dtypes if t not in SPARK_TO_DUCK}
