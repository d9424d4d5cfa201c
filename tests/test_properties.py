"""Relations between results that hold whatever the rows are."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallybook import operators as op
from tallybook.sources import documents_manifest, read_table

FOLDER = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason=f"no tables in {FOLDER}")


@pytest.fixture(scope="module")
def docs(spark):
    return documents_manifest(read_table(spark, FOLDER, "documents")).cache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dedup_twice_is_dedup_once(docs):
    once = op.exact_dedup(docs, ["lang", "doc_id", "path"])
    assert rows(once) == rows(op.exact_dedup(once, ["lang", "doc_id", "path"]))


def test_savings_are_what_dedup_removes(docs):
    saved = op.dedup_savings(docs, "lang").agg(F.sum("saved_bytes"), F.sum("n_rows"), F.sum("n_oids")).first()
    kept = op.exact_dedup(docs, ["lang", "doc_id", "path"]).agg(F.sum("size"), F.count("*")).first()
    assert saved[0] == docs.agg(F.sum("size")).first()[0] - kept[0]
    assert (saved[1], saved[2]) == (docs.count(), kept[1])


def test_present_and_missing_fill_the_range(spark):
    labels = read_table(spark, FOLDER, "labels")
    low, high = labels.agg(F.min("doc_id"), F.max("doc_id")).first()
    present = op.ordinal_islands(labels, [], "doc_id").agg(F.sum("n")).first()[0]
    assert present + op.missing_ordinals(labels, [], "doc_id").count() == high - low + 1


def test_strata_hold_every_row_once(docs):
    split = op.stratified_split(docs, "lang")
    assert rows(split.select("path")) == rows(docs.select("path"))


def test_bytes_add_up(docs):
    total = docs.agg(F.sum("size")).first()[0]
    assert op.size_histogram(docs).agg(F.sum("n_bytes")).first()[0] == total
    assert op.inventory_rollup(docs, ["lang", "source"]).filter("level = 2").first().n_bytes == total


@pytest.mark.parametrize("name", ["event_runs", "label_islands", "linked_docs", "size_stats", "stratified_split", "turn_pairs"])
def test_results_do_not_depend_on_partitions(spark, setting, name):
    found = []
    for partitions, coalesce in (("1", "true"), ("13", "false")):
        setting("spark.sql.shuffle.partitions", partitions)
        setting("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
        found.append(rows(contract.queries()[name](spark, FOLDER)))
    assert found[0] == found[1]
