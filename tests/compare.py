"""Runs a registered query on Spark and its SQL on DuckDB and compares the rows, in any order."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, (float, decimal.Decimal)):
        return ("float", float(value))
    if isinstance(value, datetime.datetime):
        return ("timestamp", value.replace(tzinfo=None).isoformat())
    if isinstance(value, datetime.date):
        return ("date", value.isoformat())
    if isinstance(value, (list, tuple)):
        return ("list", tuple(canonical(v) for v in value))
    return ("text", str(value))


def sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(canonical(r[i]) for i in order) for r in rows), key=repr)


SPARK_KINDS = {"bigint": "int64", "int": "int32", "double": "double", "string": "text", "date": "date",
               "boolean": "bool", "timestamp": "timestamp", "timestamp_ntz": "timestamp"}
DUCK_KINDS = {"BIGINT": "int64", "INTEGER": "int32", "DOUBLE": "double", "VARCHAR": "text", "DATE": "date",
              "BOOLEAN": "bool", "TIMESTAMP": "timestamp", "TIMESTAMP WITH TIME ZONE": "timestamp"}


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    got_cols = df.columns
    got = sorted_rows(got_cols, df.collect())
    rel = con.sql(sql)
    want_cols = rel.columns
    want = sorted_rows(want_cols, rel.fetchall())
    problems = []
    if sorted(got_cols) != sorted(want_cols):
        return [f"columns {sorted(got_cols)} against {sorted(want_cols)}"]
    spark_types = {c: SPARK_KINDS.get(t, t) for c, t in df.dtypes}
    duck_types = {c: DUCK_KINDS.get(str(t), str(t)) for c, t in zip(want_cols, rel.types)}
    problems += [f"type of {c}: {spark_types[c]} against {duck_types[c]}"
                 for c in sorted(got_cols) if spark_types[c] != duck_types[c]]
    if len(got) != len(want):
        problems.append(f"{len(got)} rows against {len(want)}")
    if not want:
        problems.append("the oracle gives no rows")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        problems.append(f"{len(bad)} rows differ, first {bad[0]} in columns {sorted(got_cols)}")
    return problems
