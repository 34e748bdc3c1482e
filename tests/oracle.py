"""Run a query in Spark and its SQL in DuckDB and compare names, types and values."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "integer": "int", "bigint": "bigint", "hugeint": "hugeint",
         "string": "text", "varchar": "text", "double": "double", "timestamp_ntz": "timestamp", "timestamp": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value if value is None else str(value)


def compare(spark, con, function, sql: str, sf_dir: str) -> list[str]:
    """Differences as text; empty when the results agree."""
    df = function(spark, sf_dir)
    names = sorted(df.columns)
    result = con.execute(sql)
    duck_types = {d[0]: str(d[1]).lower() for d in result.description}
    problems = []
    if names != sorted(duck_types):
        return [f"columns {names} != {sorted(duck_types)}"]
    for field in df.schema.fields:
        ours = KINDS.get(field.dataType.simpleString(), field.dataType.simpleString())
        theirs = KINDS.get(duck_types[field.name], duck_types[field.name])
        if ours != theirs:
            problems.append(f"type of {field.name}: {ours} != {theirs}")
    order = [list(duck_types).index(n) for n in names]
    key = lambda row: tuple((v is None, v or "") for v in row)
    expected = sorted((tuple(_cell(row[i]) for i in order) for row in result.fetchall()), key=key)
    found = sorted((tuple(_cell(row[n]) for n in names) for row in df.collect()), key=key)
    if len(found) != len(expected):
        problems.append(f"rows {len(found)} != {len(expected)}")
    wrong = [(f, e) for f, e in zip(found, expected) if f != e]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, first {wrong[0][0]} != {wrong[0][1]}")
    return problems
