"""Compare a query with its SQL on the same tables."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
from collections import Counter

import duckdb

_KIND = {
    "bigint": "int", "int": "int", "smallint": "int", "hugeint": "int", "integer": "int", "string": "text", "varchar": "text",
    "double": "float", "float": "float", "boolean": "bool", "timestamp_ntz": "time", "timestamp": "time",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, column kinds and all rows agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: _KIND.get(str(d[1]).lower(), str(d[1]).lower()) for d in cur.description}
    expected = _rows(names, cur.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns: {sorted(spark_df.columns)} instead of {sorted(names)}"]
    out = []
    for field in spark_df.schema.fields:
        kind = _KIND.get(field.dataType.simpleString(), field.dataType.simpleString())
        if kind != kinds[field.name]:
            out.append(f"type of {field.name}: {kind} instead of {kinds[field.name]}")
    got = _rows(spark_df.columns, spark_df.collect())
    if got != expected:
        extra, missing = list((got - expected).items()), list((expected - got).items())
        out.append(f"{sum(got.values())} rows instead of {sum(expected.values())}; {len(extra)} extra, {len(missing)} missing")
        out += [f"extra   {r}" for r in sorted(extra, key=str)[:3]] + [f"missing {r}" for r in sorted(missing, key=str)[:3]]
    return out
