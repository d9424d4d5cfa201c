"""Register of queries: name, Spark form, SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallybook.sources.tables import read_table


class Tables:
    """The given tables of one folder, read when asked for: ``t.documents``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return read_table(self.spark, self.folder, name)


@dataclass(frozen=True)
class Query:
    name: str
    operator: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}

# Documents as a manifest, for the SQL side.
DOCS = """docs AS (
  SELECT concat_ws('/', lang, source, doc_id) AS path, sha256(text) AS oid,
         CAST(octet_length(encode(text)) AS BIGINT) AS size, doc_id, lang, source
  FROM documents)"""


def query(operator: str, sql: str | None = None):
    """Registers a function of ``Tables`` under its own name, with the id of its operator."""

    def register(body: Callable[[Tables], DataFrame]):
        name = body.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        QUERIES[name] = Query(name, operator, lambda spark, folder: body(Tables(spark, folder)), sql)
        return body

    return register
