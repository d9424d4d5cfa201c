"""What was added, removed, changed or moved between two snapshots of a manifest.

A snapshot is written by ranges of paths, with a digest for each range and one for each group of ranges
up to the whole. Two snapshots with the same ranges are compared from the top: where
digests are equal nothing below is looked at, and rows are read only of ranges that differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.ordering import running_total
from tallybook.functions.storage import store

SNAPSHOT_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("oid", T.StringType()), T.StructField("size", T.LongType())])
FANOUT = 64  # ranges are FANOUT groups of FANOUT
DIGEST_SCHEMA = "level int, node int, digest string, n_rows bigint"
CUT_SCHEMA = "leaf int, cut string"


def _cuts(manifest: DataFrame, fanout: int) -> list[str]:
    """First path of each range but the first: about equal shares of the rows, fanout^2 - 1 cuts at most."""
    ranged = manifest.select("path").filter("path is not null").repartitionByRange(fanout * fanout, "path")
    firsts = ranged.groupBy(F.spark_partition_id().alias("part")).agg(F.min("path").alias("cut"))
    return sorted(r.cut for r in firsts.collect())[1:]


def _leaf(cuts: list[str], fanout: int) -> Column:
    """Number of the range a path is in: the group by the groups' first cuts, then the range in the group. Null is in the first."""
    groups = [cuts[i : i + fanout] for i in range(0, len(cuts), fanout)]
    if not groups:
        return F.lit(0)

    def listed(found: list[str]) -> Column:
        return F.array(*[F.lit(c) for c in found])

    def passed(found: Column) -> Column:
        return F.coalesce(F.size(F.filter(found, lambda c: c <= F.col("path"))), F.lit(0))

    group = passed(listed([g[0] for g in groups]))
    inside = passed(F.get(F.array(*map(listed, groups)), group - 1))
    return F.when(group == 0, 0).otherwise((group - 1) * fanout + inside).cast("int")


def _digests(rows: DataFrame, fanout: int) -> DataFrame:
    """level 2: ranges; level 1: groups of ranges; level 0: all. A digest does not depend on the order of rows.

    Two 64-bit hashes of each row are added up without loss. That tells any accidental difference; it is no
    defence against rows made to collide.
    """
    hashes = [F.sum(F.xxhash64(F.lit(seed), "path", "oid", "size").cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    leaves = rows.groupBy(F.col("leaf").alias("node")).agg(F.concat_ws("/", *hashes).alias("sums"), F.count(F.lit(1)).alias("n_rows"))
    leaves = store(leaves.select(F.lit(2).alias("level"), "node", F.sha2(F.concat_ws("/", "sums", "n_rows"), 256).alias("digest"), "n_rows"), "digests")
    found, below = [leaves], leaves
    for level in (1, 0):
        up = F.floor(F.col("node") / fanout).cast("int")
        listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("node", "digest"))), lambda x: F.concat_ws(":", x["node"], x["digest"])), " ")
        below = below.groupBy(up.alias("node")).agg(F.sha2(listed, 256).alias("digest"), F.sum("n_rows").alias("n_rows"))  # fanout digests to a row
        below = below.select(F.lit(level).alias("level"), "node", "digest", "n_rows")
        found.append(below)
    return reduce(DataFrame.unionByName, found)


def write_snapshot(manifest: DataFrame, where: str, like: str | None = None, fanout: int = FANOUT) -> None:
    """Writes path, oid, size of ``manifest`` to ``where``/rows, with ``where``/cuts and ``where``/digests.

    ``like`` names an earlier snapshot whose ranges are taken over, so that the two can be compared. A range with
    most of the rows is written by several tasks. Rows with a null path are in the first range; repeated rows stay.
    """
    session, where = manifest.sparkSession, where.rstrip("/")
    if like is None:
        cuts = _cuts(manifest, fanout)
    else:
        known = session.read.schema(CUT_SCHEMA).parquet(f"{like.rstrip('/')}/cuts").orderBy("leaf").collect()
        cuts, fanout = [r.cut for r in known if r.leaf > 0], next(-r.leaf for r in known if r.leaf < 0)
    # Leaf numbers count from 1 for cuts; the row below 0 keeps the fanout.
    listed = [(-fanout, None), *[(i + 1, c) for i, c in enumerate(cuts)]]
    session.createDataFrame(listed, CUT_SCHEMA).coalesce(1).write.parquet(f"{where}/cuts")
    plain = manifest.select("path", "oid", F.col("size").cast("bigint").alias("size")).withColumn("leaf", _leaf(cuts, fanout))
    plain.repartitionByRange("leaf", "path").sortWithinPartitions("leaf", "path").write.partitionBy("leaf").parquet(f"{where}/rows")
    rows = read_snapshot(session, where)
    _digests(rows, fanout).write.parquet(f"{where}/digests")


def read_snapshot(spark: SparkSession, where: str) -> DataFrame:
    """path, oid, size and leaf, the range; a filter on leaf reads the folders of those ranges only."""
    schema = T.StructType([*SNAPSHOT_SCHEMA.fields, T.StructField("leaf", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{where.rstrip('/')}/rows")


def unequal_ranges(spark: SparkSession, before: str, after: str) -> list[int]:
    """Ranges in which two snapshots differ, found from the root of the digests down; fanout^2 numbers at most."""
    cuts = [sorted(spark.read.schema(CUT_SCHEMA).parquet(f"{w.rstrip('/')}/cuts").collect(), key=lambda r: r.leaf) for w in (before, after)]
    if cuts[0] != cuts[1]:
        raise ValueError("snapshots with different ranges; write the later one with like=")
    fanout = -cuts[0][0].leaf
    old, new = (spark.read.schema(DIGEST_SCHEMA).parquet(f"{w.rstrip('/')}/digests") for w in (before, after))
    parents: list[int] | None = None
    for level in range(3):
        sides = [d.filter(F.col("level") == level) for d in (old, new)]
        if parents is not None:
            sides = [d.filter(F.floor(F.col("node") / fanout).isin(parents)) for d in sides]
        a, b = (d.select("node", F.col("digest").alias(n)) for d, n in zip(sides, ("a", "b")))
        parents = sorted(r.node for r in a.join(b, "node", "full_outer").filter("not (a <=> b)").select("node").collect())
        if not parents:
            return []
    return parents


DIFF_SCHEMA = "change string, path string, old_path string, oid string, old_oid string, size bigint, old_size bigint"


def diff_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """DIFF_SCHEMA: rows of two manifests that differ, each as added, removed, changed or moved.

    Rows are matched by path, repeated paths in the order of (oid, size). A path with another oid or size has
    changed. An oid that was removed at one path and added at another has moved: within an oid, the first removed path goes with the first
    added one, and so on; what is left over stays removed or added. Ranks are taken by ranges and are
    part of the join's key, so an oid of a third of all rows is no hot key. Null paths match null paths; a null oid never moves.
    """
    nth = Window.partitionBy("path").orderBy("oid", "size")

    def side(df: DataFrame, prefix: str) -> DataFrame:
        numbered = df.select("path", "oid", "size").withColumn("nth", F.row_number().over(nth))
        return numbered.withColumnsRenamed({c: prefix + c for c in ("path", "oid", "size", "nth")}).withColumn(prefix + "here", F.lit(True))

    a, b = side(before, "a_"), side(after, "b_")
    both = a.join(b, a.a_path.eqNullSafe(b.b_path) & (a.a_nth == b.b_nth), "full_outer")
    equal = F.col("a_here").isNotNull() & F.col("b_here").isNotNull() & F.col("a_oid").eqNullSafe(F.col("b_oid")) & F.col("a_size").eqNullSafe(F.col("b_size"))
    unequal = store(both.filter(~equal), "unequal")
    empty = lambda kind: F.lit(None).cast(kind)
    changed = unequal.filter("a_here and b_here").select(
        F.lit("changed").alias("change"), F.col("b_path").alias("path"), F.col("a_path").alias("old_path"),
        F.col("b_oid").alias("oid"), F.col("a_oid").alias("old_oid"), F.col("b_size").alias("size"), F.col("a_size").alias("old_size"),
    )
    removed = unequal.filter("b_here is null").select("a_path", "a_oid", "a_size", "a_nth")
    added = unequal.filter("a_here is null").select("b_path", "b_oid", "b_size", "b_nth")

    def ranked(df: DataFrame, p: str) -> DataFrame:
        return running_total(df, [p + "oid"], [F.col(p + c) for c in ("path", "nth", "size")], total=p + "rank").drop("group_total")

    gone, come = ranked(removed, "a_"), ranked(added, "b_")
    met = gone.join(come, (gone.a_oid == come.b_oid) & (gone.a_rank == come.b_rank), "full_outer")
    met = met.select(
        F.when(F.col("a_rank").isNull(), "added").when(F.col("b_rank").isNull(), "removed").otherwise("moved").alias("change"),
        F.col("b_path").alias("path"), F.col("a_path").alias("old_path"), F.col("b_oid").alias("oid"), F.col("a_oid").alias("old_oid"),
        F.col("b_size").alias("size"), F.col("a_size").alias("old_size"),
    )
    return changed.unionByName(met)


def manifest_diff(spark: SparkSession, before: str, after: str) -> DataFrame:
    """``diff_rows`` of two written snapshots, reading only the ranges whose digests differ."""
    leaves = unequal_ranges(spark, before, after)
    old, new = (read_snapshot(spark, w).filter(F.col("leaf").isin(leaves)) for w in (before, after))
    if not leaves:
        return spark.createDataFrame([], DIFF_SCHEMA)
    return diff_rows(old, new)
