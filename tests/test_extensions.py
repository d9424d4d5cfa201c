"""Snapshots, joins on time and event-time streams, against plain Python."""

import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tallybook.functions import storage
from tallybook.operators import snapshots
from tallybook.operators.temporal import asof_join, interval_join
from tallybook.streaming import closed_sessions, first_seen, read_slices, run_to_table, write_slices


@pytest.fixture
def small_ranges(setting):
    """Small data in many ranges."""
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- as-of join ---------------------------------------------------------------

ROW = "id int, k int, t int, note string"


def asof_rows(seed, hot):
    rng = random.Random(seed)
    keys = [1] * hot + [2, 3, None]
    left = [(i, rng.choice(keys), rng.choice([None, *range(60)]), "l") for i in range(300)]
    right = [(i, rng.choice(keys), rng.choice([None, *range(0, 60, 4)]), "r") for i in range(70)]
    return left, right + right[:5]  # repeated rows


def brute_asof(left, right, strict):
    out = {}
    for i, k, t, _ in left:
        fits = [(u, j) for j, m, u, _ in right if None not in (k, t, m, u) and m == k and (u < t or (u == t and not strict))]
        out[i] = max(fits)[1] if fits else None
    return out


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("hot", [1, 30])
def test_asof(spark, small_ranges, strict, hot):
    left, right = asof_rows(hot, hot)
    a, b = spark.createDataFrame(left, ROW), spark.createDataFrame(right, ROW)
    found = asof_join(a.repartition(5), b, ["k"], "t", "t", ["id"], strict)
    assert found.columns == ["id", "k", "t", "note", "right_id", "right_k", "right_t", "right_note"]
    assert {r.id: r.right_id for r in found.collect()} == brute_asof(left, right, strict)
    one_key = lambda rows: [(i, 0, t, n) for i, _, t, n in rows]
    found = asof_join(a, b, [], "t", "t", ["id"], strict)
    assert {r.id: r.right_id for r in found.collect()} == brute_asof(one_key(left), one_key(right), strict)


def test_asof_empty_clashing_and_types(spark):
    a, b = spark.createDataFrame([(1, 1, 5, "x")], ROW), spark.createDataFrame([], ROW)
    assert [r.right_id for r in asof_join(a, b, ["k"], "t", "t").collect()] == [None]
    assert asof_join(b, a, ["k"], "t", "t").collect() == []
    odd = a.withColumns({c: F.lit("own") for c in ("range", "side", "k0", "o0", "l", "r", "start", "found", "last")})
    found = asof_join(odd, a, ["k"], "t", "t", ["id"]).first()
    assert (found.range, found.side, found.k0, found.l, found.r, found.right_id) == ("own",) * 5 + (1,)
    with pytest.raises(ValueError, match="prefix"):
        asof_join(a, a, ["k"], "t", "t", prefix="")


def test_asof_forms_no_pairs(spark):
    a = spark.createDataFrame([(1, 1, 5, "x")], ROW)
    text = plan(asof_join(a, a, ["k"], "t", "t", ["id"]))
    assert "SortMergeJoin [t" not in text and "NestedLoop" not in text and "Cartesian" not in text


# --- interval join ------------------------------------------------------------

SPAN = "id int, k int, s bigint, e bigint"


def spans(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = rng.choice([None, *range(-200, 200)])
        e = None if s is None or rng.random() < 0.03 else s + rng.choice([-1, 0, 1, 2, 3, 10, 100, 10**12])
        rows.append((i, rng.choice([1, 1, 1, 2, None]), s, e))
    return rows + rows[:3]


def brute_overlaps(a, b, by):
    ok = lambda x: None not in x[2:] and x[2] < x[3]
    return Counter(
        (x[0], y[0]) for x in a for y in b
        if ok(x) and ok(y) and (not by or (x[1] is not None and x[1] == y[1])) and x[2] < y[3] and y[2] < x[3]
    )


@pytest.mark.parametrize("width", [1, 7, 64, 10**6])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_overlaps(spark, width, by):
    a, b = spans(1), spans(2)
    found = interval_join(spark.createDataFrame(a, SPAN), spark.createDataFrame(b, SPAN), by, ("s", "e"), ("s", "e"), width)
    assert Counter((r.id, r.right_id) for r in found.collect()) == brute_overlaps(a, b, by)


def test_long_intervals_are_few_nodes(spark):
    from tallybook.operators.temporal import _cover

    ends = [(0, 0), (5, 5), (1, 10**15), (-(10**15), 10**15), (-7, 9), (-1, 0), (0, 2**40 - 1)]
    df = spark.createDataFrame(ends, "a bigint, b bigint").select("a", "b", _cover(F.col("a"), F.col("b")).alias("n"))
    for r in df.collect():
        pieces = sorted((x.node << x.level, (x.node + 1) << x.level) for x in r.n)
        assert pieces[0][0] == r.a and pieces[-1][1] == r.b + 1 and len(pieces) <= 110
        assert all(x[1] == y[0] for x, y in zip(pieces, pieces[1:]))


def test_overlaps_of_times_and_no_nested_loop(spark):
    at = datetime(2024, 1, 1)
    rows = [(i, at + timedelta(hours=i), at + timedelta(hours=i, minutes=90)) for i in range(5)]
    for kind in ("timestamp", "timestamp_ntz"):
        df = spark.createDataFrame(rows, f"id int, s {kind}, e {kind}")
        joined = interval_join(df, df, [], ("s", "e"), ("s", "e"), 3_600_000_000)
        assert {(r.id, r.right_id) for r in joined.collect()} == {(i, j) for i in range(5) for j in range(5) if abs(i - j) <= 1}
        assert "NestedLoop" not in plan(joined) and "Cartesian" not in plan(joined)
    empty = df.limit(0)
    assert interval_join(empty, df, [], ("s", "e"), ("s", "e"), 1).collect() == []


# --- snapshots ----------------------------------------------------------------

MANIFEST = "path string, oid string, size bigint"


def manifest_rows(seed, n=400):
    rng = random.Random(seed)
    rows = [(f"{rng.choice('abcd')}/{i:04d}", "hot" if i % 3 == 0 else f"o{i}", i) for i in range(n)]
    return rows + [(None, "n", 1), ("a/dup", "x", 1), ("a/dup", "x", 1), ("b/null", None, 3)]


def brute_diff(before, after):
    number = lambda rows: {(p, k): (o, s) for p, group in by_path(rows).items() for k, (o, s) in enumerate(group)}

    def by_path(rows):
        groups = {}
        for p, o, s in rows:
            groups.setdefault(p, []).append((o, s))
        return {p: sorted(g, key=lambda x: (x[0] is not None, x[0] or "", x[1])) for p, g in groups.items()}

    a, b = number(before), number(after)
    out = Counter(("changed", p[0], p[0], b[p][0], a[p][0], b[p][1], a[p][1]) for p in a.keys() & b.keys() if a[p] != b[p])
    order = lambda x: (x[0][0] is not None, x[0][0] or "", x[0][1])
    gone = sorted(((p, a[p]) for p in a.keys() - b.keys()), key=order)
    come = sorted(((p, b[p]) for p in b.keys() - a.keys()), key=order)
    for oid in {x[1][0] for x in gone + come}:
        g, c = [x for x in gone if x[1][0] == oid], [x for x in come if x[1][0] == oid]
        paired = min(len(g), len(c)) if oid is not None else 0
        out.update(("moved", y[0][0], x[0][0], oid, oid, y[1][1], x[1][1]) for x, y in zip(g[:paired], c[:paired]))
        out.update(("removed", None, x[0][0], None, oid, None, x[1][1]) for x in g[paired:])
        out.update(("added", y[0][0], None, oid, None, y[1][1], None) for y in c[paired:])
    return out


def snapshots_of(spark, before, after, **how):
    a, b = storage.scratch_path(spark, "before"), storage.scratch_path(spark, "after")
    snapshots.write_snapshot(spark.createDataFrame(before, MANIFEST), a, **how)
    snapshots.write_snapshot(spark.createDataFrame(after, MANIFEST).repartition(3), b, like=a)
    return a, b


def changed_rows(rows, seed):
    rng = random.Random(seed)
    out = []
    for p, o, s in rows:
        turn = rng.random()
        if turn < 0.1:
            continue
        if turn < 0.2:
            out.append((f"moved/{p}", o, s))
        elif turn < 0.3:
            out.append((p, f"{o}'", s))
        else:
            out.append((p, o, s))
    return out + [("new/1", "hot", 5), ("new/2", "fresh", 6), ("new/3", None, 7)]


@pytest.mark.parametrize("fanout", [2, 4])
def test_diff(spark, fanout):
    before = manifest_rows(1)
    after = changed_rows(before, 2)
    a, b = snapshots_of(spark, before, after, fanout=fanout)
    found = snapshots.manifest_diff(spark, a, b)
    assert Counter(map(tuple, found.collect())) == brute_diff(before, after)


def test_diff_reads_unequal_ranges_only(spark):
    before = manifest_rows(3)
    after = [(p, o, s + 1 if p == "c/0005" or p == "a/dup" else s) for p, o, s in before]
    after[10] = (before[10][0], "other", 1)
    a, b = snapshots_of(spark, before, after, fanout=4)
    leaves = snapshots.unequal_ranges(spark, a, b)
    assert 1 <= len(leaves) <= 3
    text = plan(snapshots.read_snapshot(spark, a).filter(F.col("leaf").isin(leaves)))
    assert re.search(r"PartitionFilters: \[[^\]]*leaf", text)
    read = snapshots.read_snapshot(spark, a).filter(F.col("leaf").isin(leaves)).count()
    assert read <= 4 * len(before) * len(leaves) / 16
    assert Counter(map(tuple, snapshots.manifest_diff(spark, a, b).collect())) == brute_diff(before, after)


def test_equal_snapshots_and_empty_ones(spark):
    rows = manifest_rows(4, 50)
    a, b = snapshots_of(spark, rows, random.Random(1).sample(rows, len(rows)), fanout=3)
    assert snapshots.unequal_ranges(spark, a, b) == [] and snapshots.manifest_diff(spark, a, b).collect() == []
    a, b = snapshots_of(spark, rows, [], fanout=3)
    assert Counter(map(tuple, snapshots.manifest_diff(spark, a, b).collect())) == brute_diff(rows, [])
    a, b = snapshots_of(spark, [], rows, fanout=3)
    assert Counter(map(tuple, snapshots.manifest_diff(spark, a, b).collect())) == brute_diff([], rows)


def test_different_ranges_are_refused(spark):
    a, _ = snapshots_of(spark, manifest_rows(5), [], fanout=3)
    c = storage.scratch_path(spark, "other")
    snapshots.write_snapshot(spark.createDataFrame(manifest_rows(6, 30), MANIFEST), c, fanout=3)
    with pytest.raises(ValueError, match="like"):
        snapshots.unequal_ranges(spark, a, c)


# --- streams ------------------------------------------------------------------

EVENT = "id int, k string, t timestamp"
DAY = datetime(2024, 3, 1)


def minute(n):
    return DAY + timedelta(minutes=n)


def test_first_seen_once_and_forgotten(spark, tmp_path):
    rows = [(i, f"k{i}", minute(10 * i)) for i in range(200)]
    df = spark.createDataFrame(rows, EVENT)
    cuts = [minute(400 * i) for i in range(1, 5)]
    write_slices(df, str(tmp_path / "in"), "t", cuts, again=3600)
    run = lambda: run_to_table(
        first_seen(read_slices(spark, str(tmp_path / "in"), EVENT), ["k"], "t", "2 hours"), str(tmp_path / "out"), str(tmp_path / "cp")
    )
    report = run()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == list(range(200))
    assert report.n_read == 200 + 4 * 6 and report.n_late == 0
    assert max(report.state_rows) < 120 and report.state_rows[-1] < max(report.state_rows)
    assert run().n_read == 0  # started again, nothing is read or written twice
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200
    spark.createDataFrame([(777, "k199", minute(1995)), (778, "late", minute(3))], EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    later = run()  # a repeat of a key still remembered, from before the stop, and a row too late
    assert (later.n_read, later.n_late) == (2, 1)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 200


def test_sessions_close_and_late_rows_are_counted(spark, tmp_path):
    rows = [(1, "a", minute(0)), (2, "a", minute(30)), (3, "a", minute(61)), (4, None, minute(5)), (5, "b", minute(500)), (6, "b", minute(1000)), (7, "a", None)]
    write_slices(spark.createDataFrame(rows, EVENT), str(tmp_path / "in"), "t", [minute(40), minute(600)])
    run = lambda: run_to_table(
        closed_sessions(read_slices(spark, str(tmp_path / "in"), EVENT), ["k"], "t", "30 minutes", "1 hour", [F.max("id").alias("last")]),
        str(tmp_path / "out"), str(tmp_path / "cp"),
    )
    report = run()
    found = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("k", "session_start", "session_end", "n_rows", "last").collect()}
    assert found == {
        ("a", minute(0), minute(60), 2, 2), ("a", minute(61), minute(91), 1, 3),
        (None, minute(5), minute(35), 1, 4), ("b", minute(500), minute(530), 1, 5),
    }
    assert report.n_late == 0 and report.state_rows[-1] == 1  # the session of row 6 can still grow
    late = [(8, "a", minute(20)), (9, "b", minute(1010))]
    spark.createDataFrame(late, EVENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert run().n_late == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4
