"""Runs a query in Spark and its SQL in DuckDB, and compares rows as multisets."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb

KINDS = {
    "bigint": "int", "int": "int", "smallint": "int", "tinyint": "int",
    "BIGINT": "int", "INTEGER": "int", "HUGEINT": "int", "SMALLINT": "int", "TINYINT": "int", "UBIGINT": "int",
    "double": "float", "float": "float", "DOUBLE": "float", "FLOAT": "float",
    "string": "text", "VARCHAR": "text", "boolean": "bool", "BOOLEAN": "bool",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def spark_result(df):
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    columns = df.columns
    return types, _rows(columns, [tuple(r) for r in df.collect()])


def duckdb_result(con, sql):
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    return types, _rows(list(types), result.fetchall())


def differences(df, con, sql) -> list[str]:
    spark_types, spark_rows = spark_result(df)
    duck_types, duck_rows = duckdb_result(con, sql)
    if sorted(spark_types) != sorted(duck_types):
        return [f"columns {sorted(spark_types)} against {sorted(duck_types)}"]
    found = [
        f"type of {c}: {spark_types[c]} against {duck_types[c]}"
        for c in sorted(spark_types)
        if KINDS.get(spark_types[c], spark_types[c]) != KINDS.get(duck_types[c], duck_types[c])
    ]
    if sum(spark_rows.values()) != sum(duck_rows.values()):
        found.append(f"{sum(spark_rows.values())} rows against {sum(duck_rows.values())}")
    only_spark, only_duck = spark_rows - duck_rows, duck_rows - spark_rows
    if only_spark or only_duck:
        found.append(f"{list(only_spark.items())[:3]} against {list(only_duck.items())[:3]}")
    return found
