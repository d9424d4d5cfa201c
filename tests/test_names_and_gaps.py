"""Columns named like an operator's own, gaps of any length, overlap in long form."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallybook import operators as op
from tallybook.functions import first_n, free_names, join_null_safe, join_summary, running_total, with_runs

CLASHING = ("_right_g", "_rank", "rank", "rank_", "low_fence", "_range", "_start", "_amount", "group_total", "_slice", "_total", "_least", "_block", "_n", "split")
ROWS = [("a", 3, "00ff"), ("a", 1, "01aa"), ("b", 2, "ffff"), (None, 7, "0a0a"), ("a", 900, "0bcd"), ("a", 2, "1111"), ("a", 4, "2222")]


@pytest.fixture
def table(spark):
    df = spark.createDataFrame(ROWS, "g string, size bigint, oid string")
    return df.withColumns({c: F.concat(F.lit(f"{c}:"), "oid") for c in CLASHING})


def own(df, without=()):
    """Each row's clashing columns still hold what they held."""
    for r in df.collect():
        for c in CLASHING:
            if c not in without:
                assert r[c] == f"{c}:{r.oid}"


def test_free_names():
    assert free_names(["a", "A_"], "a", "a", "b") == ["a__", "a___", "b"]


@pytest.mark.parametrize(
    "name, job",
    [
        ("first_n", lambda t: first_n(t, ["g"], [F.col("size")], 2)),
        ("first_n by ranges", lambda t: first_n(t, ["g"], [F.col("size")], 2000)),
        ("running_total", lambda t: running_total(t, ["g"], [F.col("size")], weight="size", total="upto", whole="all")),
        ("largest_k", lambda t: op.largest_k(t, ["g"], 2, path="oid")),
        ("capped_sample", lambda t: op.capped_sample(t, "g", 2, ["oid"])),
        ("size_outliers", lambda t: op.size_outliers(t, ["g"])),
        ("exact_dedup", lambda t: op.exact_dedup(t, ["size"])),
        ("join_summary", lambda t: join_summary(t, t.groupBy("g").agg(F.max("size").alias("most")), ["g"])),
        ("join_null_safe", lambda t: join_null_safe(t, t.groupBy("g").agg(F.max("size").alias("most")), ["g"])),
    ],
)
def test_clashing_columns_are_kept(table, name, job):
    found = job(table)
    assert len(found.columns) == len({c.lower() for c in found.columns}) and found.count() > 0
    own(found)


def test_split_keeps_columns(table):
    found = op.stratified_split(table, "g", ["oid"])
    assert set(found.columns) == set(table.columns) and found.count() == len(ROWS)
    own(found, without=("split",))
    plain = op.stratified_split(table.select("g", "size", "oid"), "g", ["oid"])
    assert {(r.oid, r.split) for r in found.collect()} == {(r.oid, r.split) for r in plain.collect()}


def test_added_columns_take_free_names(table):
    assert "rank__" in first_n(table, ["g"], [F.col("size")], 1).columns
    assert "low_fence_" in op.size_outliers(table, ["g"]).columns


def test_runs_of_clashing_names(spark):
    df = spark.createDataFrame([("x", 1, "u"), ("x", 2, "u"), ("x", 3, None)], "_range string, _piece int, _run string")
    found = {tuple(r) for r in with_runs(df, ["_range"], ["_piece"], "_run").collect()}
    assert found == {("x", "u", 1, 2, 2), ("x", None, 3, 3, 1)}


def test_gap_of_any_length(spark):
    df = spark.createDataFrame([("a", 1), ("a", 10**16), ("a", 10**16 + 2), ("b", 5)], "g string, o bigint")
    found = {tuple(r) for r in op.missing_ranges(df, ["g"], "o").collect()}
    assert found == {("a", 2, 10**16 - 1, 10**16 - 2), ("a", 10**16 + 1, 10**16 + 1, 1)}
    assert op.missing_ordinals(df.filter("o > 1"), ["g"], "o").collect()[0].o == 10**16 + 1
    declared = spark.createDataFrame([("a", 10**16)], "g string, total bigint")
    found = op.missing_shard_ranges(df, "o", "total", ["g"], declared=declared).collect()
    assert [tuple(r) for r in found] == [("a", 0, 0, 1), ("a", 2, 10**16 - 1, 10**16 - 2)]


@pytest.mark.parametrize("seed", range(3))
def test_ranges_against_brute_force(spark, setting, seed):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "hot", "hot", "b", None]), rng.choice([None, *range(-30, 200)])) for _ in range(150)]
    bounds = [("hot", -10, 220), ("b", 50, 49), ("none", 3, 9), (None, 0, 10)]
    here = defaultdict(set)
    for g, o in rows:
        here[g].add(o)
    df, limits = spark.createDataFrame(rows, "g string, o int"), spark.createDataFrame(bounds, "g string, lo int, hi int")
    opened = lambda found: Counter((r.g, o) for r in found.collect() for o in range(r["first"], r["last"] + 1))
    assert opened(op.missing_ranges(df, ["g"], "o", limits)) == Counter((g, o) for g, a, b in bounds for o in range(a, b + 1) if o not in here[g])
    free = {g: [o for o in s if o is not None] for g, s in here.items()}
    expected = Counter((g, o) for g, s in free.items() if s for o in range(min(s), max(s)) if o not in here[g])
    assert opened(op.missing_ranges(df, ["g"], "o")) == expected


def test_overlap_of_many_groups(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["hot", None, *[f"o{i}" for i in range(30)]]), rng.choice([None, *"abcdefgh"])) for _ in range(400)]
    rows += [("everywhere", g) for g in "abcdefgh"] * 3
    held = defaultdict(set)
    for oid, g in rows:
        if g is not None:
            held[oid].add(g)
    expected = Counter((a, b) for s in held.values() for a in s for b in s if a < b)
    found = op.origin_overlap(spark.createDataFrame(rows, "oid string, g string"), "g")
    assert {(r.group_a, r.group_b): r.n_shared for r in found.collect()} == dict(expected)
