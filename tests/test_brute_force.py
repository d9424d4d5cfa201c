"""Ordered, linked and sampled results against plain Python on random rows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallybook import operators as op
from tallybook.functions import first_n, join_summary, joins, running_total, with_runs


@pytest.fixture(autouse=True)
def many_partitions(setting):
    """Small data in many ranges, so that runs and ranks do cross them."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


def hot_rows(seed, n=600):
    """Rows of which one group has two thirds, one a null name, with long runs of equal values."""
    rng = random.Random(seed)
    rows, value = [], "a"
    for i in range(n):
        if rng.random() < 0.1:
            value = rng.choice(["a", "b", None])
        rows.append((rng.choice(["hot", "hot", "hot", "hot", "cold", None]), i, value, rng.randint(1, 50)))
    rng.shuffle(rows)
    return rows


SCHEMA = "g string, at int, v string, size bigint"


def by_group(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    return {g: sorted(rs, key=lambda r: r[1]) for g, rs in groups.items()}


@pytest.mark.parametrize("seed", range(3))
def test_runs(spark, seed):
    rows = hot_rows(seed)
    expected = Counter()
    for g, rs in by_group(rows).items():
        start = 0
        for i in range(1, len(rs) + 1):
            if i == len(rs) or rs[i][2] != rs[start][2]:
                expected[(g, rs[start][2], rs[start][1], rs[i - 1][1], i - start)] += 1
                start = i
    found = with_runs(spark.createDataFrame(rows, SCHEMA).repartition(7), ["g"], ["at"], "v")
    assert Counter(map(tuple, found.select("g", "v", "first_at", "last_at", "length").collect())) == expected


def test_one_run_over_all_ranges(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.col("id").alias("at"), F.lit("x").alias("v"))
    assert [tuple(r) for r in with_runs(df, ["g"], ["at"], "v").collect()] == [(1, "x", 0, 4999, 5000)]


@pytest.mark.parametrize("weight", [None, "size"])
def test_running_total(spark, weight):
    rows = hot_rows(5)
    expected = {}
    for g, rs in by_group(rows).items():
        total = sum(r[3] if weight else 1 for r in rs)
        so_far = 0
        for r in rs:
            so_far += r[3] if weight else 1
            expected[r[1]] = (g, so_far, total)
    found = running_total(spark.createDataFrame(rows, SCHEMA), ["g"], [F.col("at")], weight=weight, total="t")
    assert {r["at"]: (r["g"], r["t"], r["group_total"]) for r in found.collect()} == expected


@pytest.mark.parametrize("limit", ["1000", "3"])
def test_first_n_below_and_above_group_limit(spark, setting, limit):
    setting("spark.sql.optimizer.windowGroupLimitThreshold", limit)
    rows = hot_rows(6)
    expected = {(g, r[1], i + 1) for g, rs in by_group(rows).items() for i, r in enumerate(rs[:9])}
    found = first_n(spark.createDataFrame(rows, SCHEMA), ["g"], [F.col("at")], 9)
    assert {(r["g"], r["at"], r["rank"]) for r in found.collect()} == expected


@pytest.mark.parametrize("seed", range(3))
def test_percentiles(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice("aaaab"), rng.choice([rng.randint(-5, 5), rng.randint(0, 10**9), None])) for _ in range(400)]
    points = {"p0": 0.0, "q1": 0.25, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    for r in op.exact_percentiles(spark.createDataFrame(rows, "g string, v bigint"), ["g"], "v", points).collect():
        values = [v for g, v in rows if g == r.g and v is not None]
        assert (r.n, r.min_value, r.max_value) == (len(values), min(values), max(values))
        for name, point in points.items():
            assert r[name] == pytest.approx(np.percentile(values, point * 100), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("block", [1, 4, 64, 1 << 20])
def test_missing_and_islands(spark, block):
    rng = random.Random(block)
    rows = [(rng.choice(["a", "a", "b", None]), rng.randint(-60, 60)) for _ in range(110)]
    rows += rows[:20] + [("a", None), ("lone", 7), ("nothing", None)]
    df = spark.createDataFrame(rows, "g string, o int")
    present = defaultdict(set)
    for g, o in rows:
        if o is not None:
            present[g].add(o)
    missing = {(g, o) for g, os in present.items() for o in range(min(os), max(os) + 1) if o not in os}
    found = [tuple(r) for r in op.missing_ordinals(df, ["g"], "o", block=block).collect()]
    assert len(found) == len(set(found)) and set(found) == missing

    islands = [tuple(r) for r in op.ordinal_islands(df, ["g"], "o", block=block).collect()]
    covered = Counter((g, o) for g, start, end, _ in islands for o in range(start, end + 1))
    assert covered == Counter((g, o) for g, os in present.items() for o in os)
    assert all(n == end - start + 1 for _, start, end, n in islands)
    ends = {(g, end) for g, _, end, _ in islands}
    assert not any((g, start - 1) in ends for g, start, _, _ in islands)


@pytest.mark.parametrize("block", [1, 4, 1 << 20])
@pytest.mark.parametrize("ordinal", ["start", "end", "_start"])
def test_islands_at_the_ends_of_long(spark, block, ordinal):
    low, high = -(1 << 63), (1 << 63) - 1
    rows = [("a", low), ("a", low + 1), ("a", high), ("a", high), ("a", high - 1), ("b", low), (None, 0), (None, None)]
    df = spark.createDataFrame(rows, f"_end string, {ordinal} bigint")
    found = sorted((tuple(r) for r in op.ordinal_islands(df, ["_end"], ordinal, block=block).collect()), key=str)
    assert found == sorted([("a", low, low + 1, 2), ("a", high - 1, high, 2), ("b", low, low, 1), (None, 0, 0, 1)], key=str)


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_missing_within_given_bounds(spark, block):
    df = spark.createDataFrame([("a", o) for o in (-9, 2, 3, 7, 30)] + [("out", 100)], "g string, o int")
    bounds = spark.createDataFrame([("a", 0, 10), ("b", 5, 6), ("out", 1, 2)], "g string, lo bigint, hi bigint")
    found = {tuple(r) for r in op.missing_ordinals(df, ["g"], "o", bounds=bounds, block=block).collect()}
    wanted = {("a", o) for o in range(11) if o not in (2, 3, 7)} | {("b", 5), ("b", 6), ("out", 1), ("out", 2)}
    assert found == wanted


def test_missing_shards(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 3, 5), ("b", 1, 2)], "g string, shard int, total int")
    found = {tuple(r) for r in op.missing_shards(df, "shard", "total", ["g"]).collect()}
    assert found == {("a", 1), ("a", 2), ("a", 4), ("b", 0)}


def components(pairs):
    parent = {}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_via = {}
    for m, via in pairs:
        if m is None:
            continue
        parent.setdefault(m, m)
        if via is None:
            continue
        a, b = top(m), top(by_via.setdefault(via, m))
        parent[max(a, b)] = min(a, b)
    return {m: top(m) for m in parent}


def graph(kind):
    rng = random.Random(1)
    if kind == "chain":
        order = rng.sample(range(120), 120)
        return [(m, f"v{i}") for i, m in enumerate(order)] + [(m, f"v{i + 1}") for i, m in enumerate(order)]
    if kind == "hub":
        return [(m, "everyone") for m in range(200)] + [(m, f"own{m}") for m in range(200, 250)] + [(7, "x"), (230, "x")]
    return [(rng.randint(0, 150), f"v{rng.randint(0, 160)}") for _ in range(200)] + [(900, None), (None, "v1")]


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("kind", ["chain", "hub", "random"])
def test_linked_groups(spark, monkeypatch, kind, small):
    if not small:
        monkeypatch.setattr(joins, "BROADCAST_ROWS", -1)
    pairs = graph(kind)
    found = op.linked_groups(spark.createDataFrame(pairs, "m bigint, via string"), "m", "via").collect()
    assert len(found) == len({r.m for r in found})
    assert {r.m: r.component for r in found} == components(pairs)


def test_chain_of_three_patients(spark):
    df = spark.createDataFrame([("1", 10), ("2", 10), ("2", 20), ("3", 20), ("4", 30)], "patient string, lesion int")
    found = {r.patient: r.component for r in op.linked_groups(df, "patient", "lesion").collect()}
    assert found == {"1": "1", "2": "1", "3": "1", "4": "4"}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("copies", [1, 150])
def test_stratified_split(spark, copies):
    rows = [("a", sha(f"{i}"), f"p{i}") for i in range(203)]
    rows += [("b", sha("same"), f"q{i:03}") for i in range(copies)] + [(None, sha(f"n{i}"), f"r{i}") for i in range(13)]
    expected = {}
    for label in ("a", "b", None):
        mine = sorted(r[1:] for r in rows if r[0] == label)
        n = len(mine)
        for i, (oid, path) in enumerate(mine, 1):
            expected[path] = "train" if i <= n * 80 // 100 else "val" if i <= n * 90 // 100 else "test"
    found = op.stratified_split(spark.createDataFrame(rows, "label string, oid string, path string"), "label")
    assert {r.path: r.split for r in found.collect()} == expected
    assert found.count() == len(rows)


def test_hierarchy_keeps_every_member_once(spark):
    rows = [("big", f"l{i % 4}", i) for i in range(100)] + [("small", "l0", 0), ("small", "l9", 1), (None, "l1", 5)]
    found = op.entity_hierarchy(spark.createDataFrame(rows, "p string, l string, i int"), "p", "l", ["i"]).collect()
    assert Counter((r.p, r.l, r.i) for r in found) == Counter(rows)
    for parent, n_children, n_members in (("big", 4, 100), ("small", 2, 2), (None, 1, 1)):
        mine = sorted((r for r in found if r.p == parent), key=lambda r: r.member_no)
        assert [r.member_no for r in mine] == list(range(1, n_members + 1))
        assert [(r.l, r.i) for r in mine] == sorted((r.l, r.i) for r in mine)
        assert {(r.n_children, r.n_members) for r in mine} == {(n_children, n_members)}


def test_hierarchy_of_a_huge_parent(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("p"), (F.col("id") % 3).alias("c"), F.col("id").alias("i"))
    found = op.entity_hierarchy(df, "p", "c", ["i"])
    row = found.agg(F.count("*"), F.countDistinct("member_no"), F.max("member_no"), F.min("n_members"), F.max("n_children")).first()
    assert tuple(row) == (1_000_000, 1_000_000, 1_000_000, 1_000_000, 3)


def test_leakage_for_any_split_names(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (3, None), (3, "c"), (None, "a"), (None, "b")], "g int, split string")
    found = {(r.g, r.split, r.n_rows, r.n_splits) for r in op.split_leakage(df, "g").collect()}
    assert found == {(1, "a", 1, 2), (1, "b", 2, 2), (3, None, 1, 2), (3, "c", 1, 2)}


def test_null_keys_and_hashes_have_a_split(spark):
    keys = spark.createDataFrame([(None,), (None,), ("x",)], "k string")
    assert all(r.split for r in op.group_split(keys, "k").collect())
    rows = [("a", None if i < 5 else sha(f"{i}"), f"p{i}") for i in range(15)]
    df = spark.createDataFrame(rows, "label string, oid string, path string")
    assert Counter(r.split for r in op.stratified_split(df, "label").collect()) == {"train": 12, "val": 1, "test": 2}
    with pytest.raises(ValueError):
        op.stratified_split(df.withColumn("oid", F.lit(1)), "label")


def test_no_group_columns(spark):
    df = spark.createDataFrame([(i, 10 if i < 3 else 1) for i in range(20)], "o int, size bigint")
    assert op.size_cap_audit(df, [], "o", 10).first().last_big_ordinal == 2
    assert op.size_outliers(df, []).count() >= 0


def test_missing_shards_without_rows(spark):
    none = spark.createDataFrame([], "g string, shard int, total int")
    declared = spark.createDataFrame([("a", 3)], "g string, total int")
    found = {tuple(r) for r in op.missing_shards(none, "shard", "total", ["g"], declared=declared).collect()}
    assert found == {("a", 0), ("a", 1), ("a", 2)}


def test_pivot_adds_up(spark):
    df = spark.createDataFrame([(1, "view"), (1, "refund"), (1, None)], "u int, e string")
    row = op.modality_pivot(df, ["u"], "e", ["click", "view"]).first()
    assert (row.click, row.view, row.other) == (0, 1, 2)


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
@pytest.mark.parametrize("limit", [-1, 100_000])
def test_join_summary_both_ways(spark, monkeypatch, how, limit):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", limit)
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4)], "k string, i int")
    summary = spark.createDataFrame([("a", "x"), (None, "y")], "k string, s string")
    found = sorted(tuple(r) for r in join_summary(rows, summary, ["k"], how).select("i", *(["s"] if how in ("inner", "left") else [])).collect())
    assert found == {
        "inner": [(1, "x"), (2, "x"), (3, "y")],
        "left": [(1, "x"), (2, "x"), (3, "y"), (4, None)],
        "left_semi": [(1,), (2,), (3,)],
        "left_anti": [(4,)],
    }[how]


def test_pairs_with_repeats(spark):
    left = spark.createDataFrame([(1, "l1"), (1, "l2"), (2, "l3"), (None, "l4")], "k int, path string")
    right = spark.createDataFrame([(1, "r2"), (1, "r1"), (3, "r3"), (None, "r4")], "k int, path string")
    found = {(r.left_path, r.right_path, r.n_right) for r in op.matched_pairs(left, right, ["k"], ["path"], ["path"]).collect()}
    assert found == {("l1", "r1", 2), ("l2", "r1", 2)}
    every = {(r.k, r.path, r.n_right) for r in op.repeated_partners(right, ["k"]).collect()}
    assert every == {(1, "r1", 2), (1, "r2", 2)}
    alone = {(r.path, r.side) for r in op.unpaired(left, right, ["k"]).collect()}
    assert alone == {("l3", "left"), ("r3", "right"), ("l4", "left"), ("r4", "right")}


def test_identity_conflict_is_found(spark):
    df = spark.createDataFrame([("o", 1), ("o", 2), ("p", 1), ("p", 1), ("q", None), ("q", 5)], "oid string, size bigint")
    assert [tuple(r) for r in op.identity_conflicts(df, "size").collect()] == [("o", 2)]


def test_misrouted(spark):
    df = spark.createDataFrame([(0, 99), (1, 100), (0, 100), (None, 5)], "shard int, ordinal int")
    rule = F.floor(F.col("ordinal") / 100)
    assert {(r.shard, r.ordinal) for r in op.misrouted(df, "shard", rule).collect()} == {(0, 100), (None, 5)}
    assert {r.shard: (r.n_kept, r.n_broken) for r in op.routing_check(df, "shard", rule).collect()} == {
        0: (1, 1), 1: (1, 0), None: (0, 1)
    }


def test_exact_powers_of_two(spark):
    sizes = [0, 1, 2, 3, 4, 7, 8, 2**29 - 1, 2**29, 2**40, 2**62]
    found = {r.power: r.n_rows for r in op.size_histogram(spark.createDataFrame([(s,) for s in sizes], "size bigint")).collect()}
    assert found == Counter(None if s < 1 else s.bit_length() - 1 for s in sizes)


def test_overlap_counts_each_oid_once(spark):
    rows = [("o1", g) for g in "abc"] * 3 + [("o2", "a"), ("o2", "b"), ("o3", "c"), ("o4", None), ("o4", "a")]
    found = {tuple(r) for r in op.origin_overlap(spark.createDataFrame(rows, "oid string, g string"), "g").collect()}
    assert found == {("a", "b", 2), ("a", "c", 1), ("b", "c", 1)}


def test_copies_across_partitions_in_long_form(spark):
    rows = [("hot", f"p{i % 5000}") for i in range(20_000)] + [("one", "p1"), ("one", "p1"), (None, "a"), (None, "b"), ("x", None), ("x", "a")]
    found = op.cross_partition_duplicates(spark.createDataFrame(rows, "oid string, part string"), "part").collect()
    expected = {("hot", f"p{i}", 5000) for i in range(5000)} | {(None, "a", 2), (None, "b", 2)}
    assert {tuple(r) for r in found} == expected and len(found) == len(expected)
    assert op.cross_partition_duplicates(spark.createDataFrame([], "oid string, part string"), "part").count() == 0
