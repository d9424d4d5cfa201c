"""Other tables seen as manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Address layout of the pages table.
URL_PATTERN = r"^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents_manifest(documents: DataFrame) -> DataFrame:
    """path, oid, size of each document's whole text, with doc_id, lang and source."""
    return documents.select(
        F.concat_ws("/", "lang", "source", F.col("doc_id").cast("string")).alias("path"),
        F.sha2("text", 256).alias("oid"),
        F.octet_length("text").cast("bigint").alias("size"),
        "doc_id",
        "lang",
        "source",
    )


def pages_addresses(pages: DataFrame) -> DataFrame:
    """page_id, url, host, lang, ordinal and tail of each page address."""

    def part(group: int):
        return F.regexp_extract("url", URL_PATTERN, group)

    return pages.select(
        "page_id",
        "url",
        F.nullif(part(1), F.lit("")).alias("host"),
        F.nullif(part(2), F.lit("")).alias("lang"),
        part(3).try_cast("bigint").alias("ordinal"),
        part(4).alias("tail"),
    )
