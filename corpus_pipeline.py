"""From raw documents to a training mix, a stage a time.

Each stage takes what the one before kept, as a table of its own, so a lost
executor never costs more than a stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallybook.functions.storage import store
from tallybook.llm import decontaminate, mixing, quality, simhash
from tallybook.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity under trusted text is within their language's limit.

    Null and empty texts are rejected; a perplexity equal to the limit is kept. Rows that repeat share their lot, and a null id or
    language is judged as any other. All columns are kept, whatever their names. An empty table stays empty; without trusted
    labels every document with a text stays.
    """
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id.

    Null and empty texts, and texts without a word, have the fingerprint zero and are copies of each other. Of rows with equal ids, and
    of rows without one, one stays in a group. All columns are kept, whatever their names. An empty table stays empty.
    """
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a 10-word window of a benchmark item.

    Null and empty texts are clean; null and empty items have no windows. Rows that repeat share their lot. All columns are
    kept, whatever their names. An empty table stays empty, and without items all documents stay.
    """
    return decontaminate.remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their rate and how often they are taken, so that domains get their target shares.

    Adds ``rate`` and ``times``, in place of columns of these names; documents to be taken zero times are left out. Null and empty texts
    have no tokens, and the rate of their prior probabilities. Rows of equal id and text share a rate. Labels that contradict each
    other or are null teach nothing. An empty table stays empty.
    """
    labels = read_table(spark, sf_dir, "labels")
    return mixing.mix(docs, labels.select("doc_id", mixing.domain_of().alias("domain")), mixing.TARGETS)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mixing_to_targets", mixing_to_targets),
]

# Neither a language model nor SimHash can be said in SQL; tests/llm holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name)
    return docs
