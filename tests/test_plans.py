"""Physical plans and the rules all jobs keep to."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tallybook import operators as op
from tallybook.functions import join_summary, joins, storage
from tallybook.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
PACKAGE = Path(contract.__file__).parent / "tallybook"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_in_plans(spark, name):
    text = plan(QUERIES[name].run(spark, FOLDER))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in text


EXTENSIONS = {f"X{i}" for i in range(2, 13)}


def test_every_operator_has_a_query():
    expected = {f"M{i}" for i in range(1, 6)} | {f"D{i}" for i in range(1, 8)} | {f"I{i}" for i in range(1, 13)}
    expected |= {f"C{i}" for i in range(1, 7)} | {f"P{i}" for i in range(1, 5)} | {f"G{i}" for i in range(1, 8)}
    assert {q.operator for q in QUERIES.values()} == expected | EXTENSIONS and len(expected) == 41


def test_copies_are_cut_down_before_the_shuffle(spark):
    docs = spark.createDataFrame([("o", "p")], "oid string, path string")
    text = plan(op.exact_dedup(docs, ["path"]))
    assert re.search(r"Exchange hashpartitioning\(oid.*\n.*WindowGroupLimit.*row_number\(\), 1, Partial", text), text


def test_inventory_reads_only_its_columns(spark):
    text = plan(op.class_inventory(spark.read.parquet(f"{FOLDER}/documents.parquet"), ["lang"], size="n_chars"))
    assert "ReadSchema: struct<lang:string,n_chars:bigint>" in text


def test_rollup_expands_sums_not_rows(spark):
    text = plan(op.inventory_rollup(spark.read.parquet(f"{FOLDER}/documents.parquet"), ["lang"], size="n_chars"))
    assert text.index("Expand") < text.rindex("Exchange hashpartitioning(lang")  # the scan is the last line


@pytest.mark.parametrize("group", [[], ["l_partkey"]])
def test_islands_hold_no_rows_for_an_aggregation(spark, group):
    """Beside the two halves of the distinct, rows are only sorted: an aggregation of stretches held each row twice more."""
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    text = plan(op.ordinal_islands(lines, group, "l_orderkey"))
    assert text.count("HashAggregate(") == 2 and text.count("Sort [") == 2 and text.count("Exchange hashpartitioning") == 3, text


def test_split_by_group_does_not_shuffle(spark):
    assert "Exchange" not in plan(op.group_split(spark.range(10), "id"))


def test_small_summary_leaves_rows_in_place(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(join_summary(rows, rows.groupBy("k").count(), ["k"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_hot_key_is_split_by_aqe(spark, setting, monkeypatch):
    """With a summary too large to broadcast, the partition of a hot key is cut up."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        # The hot partition must exceed five times the median, as it does on a cluster.
        "spark.sql.shuffle.partitions": "64",
    }.items():
        setting(key, value)
    rows = spark.range(0, 60_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    joined = join_summary(rows, rows.groupBy("k").count(), ["k"])
    assert len(joined.collect()) == 60_000
    assert "skew=true" in plan(joined)


def test_tables_go_to_the_named_folder(spark, monkeypatch):
    assert storage.scratch_path(spark, "x").startswith(storage.shared_dir(spark) + "/tallybook-")
    monkeypatch.setattr(storage, "CHECKPOINT_DIR", "spark.sql.warehouse.dir")
    assert storage.scratch_path(spark, "x").startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))


def test_scratch_can_be_cleared(spark):
    table = storage.store(spark.range(5))
    assert sorted(r.id for r in table.collect()) == [0, 1, 2, 3, 4]
    folder = Path(storage.scratch_path(spark, "x")).parent
    assert list(folder.iterdir())
    storage.clear_scratch(spark)
    assert not folder.exists()


def test_cluster_without_a_shared_folder_is_refused():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session())


def test_no_local_checkpoint_no_udf_no_rdd_in_the_package():
    for file in PACKAGE.rglob("*.py"):
        text = file.read_text()
        for bad in ("localCheckpoint", "crossJoin", ".rdd", "toPandas", "F.udf", "pandas_udf", ".sample("):
            assert bad not in text, (file, bad)
