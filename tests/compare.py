"""Compare a Spark result with the result of its SQL equivalent, order aside."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

from rowharbor.catalog.fixtures import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return [canonical(x) for x in v]
    return v


def kind(type_name: str) -> str:
    t = type_name.lower()
    for word, family in (
        ("[]", "array"), ("array", "array"), ("bool", "bool"), ("decimal", "decimal"), ("double", "double"), ("float", "double"),
        ("hugeint", "HUGE"), ("bigint", "int64"), ("long", "int64"), ("int", "int32"),
        ("timestamp", "timestamp"), ("date", "date"), ("varchar", "text"), ("string", "text"), ("null", "text"),
    ):
        if word in t:
            return family
    return t


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([canonical(r[i]) for i in order] for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    rel = con.sql(sql)
    problems = []
    spark_types = {f.name: kind(f.dataType.simpleString()) for f in df.schema}
    duck_types = {c: kind(str(t)) for c, t in zip(rel.columns, rel.types)}
    if sorted(spark_types) != sorted(duck_types):
        return [f"columns {sorted(spark_types)} != {sorted(duck_types)}"]
    for c in spark_types:
        if spark_types[c] != duck_types[c]:
            problems.append(f"type of {c}: {spark_types[c]} != {duck_types[c]}")
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(rel.columns, rel.fetchall())
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        gs, ws = {repr(r) for r in got}, {repr(r) for r in want}
        problems.append(f"only spark {sorted(gs - ws)[:2]} only sql {sorted(ws - gs)[:2]}")
    return problems
