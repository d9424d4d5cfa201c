"""Stored sketches, heavy keys, grouping sets, bucketed tables and JSON attributes."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybook.functions import storage
from tallybook.operators import duplicate_groups, exact_dedup
from tallybook.operators import sketches as sk
from tallybook.operators.sidecars import read_attributes
from tallybook.sources import write_bucketed


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_sketches_merge(spark):
    df = spark.range(0, 50_000, 1, 6).select((F.col("id") % 3).alias("g"), (F.col("id") % 20_000).alias("v"), (F.col("id") % 2).alias("load"))
    fine = storage.store(sk.distinct_sketches(df, ["g", "load"], "v"), "sketch")
    merged = {r.g: r for r in sk.distinct_of(sk.merge_distinct(fine, ["g"])).collect()}
    exact = {r.g: (r.n, r.d) for r in df.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("v").alias("d")).collect()}
    for g, (n, d) in exact.items():
        assert merged[g].n_rows == n and abs(merged[g].n_distinct - d) <= 0.05 * d
    nulls = spark.createDataFrame([(1, None)], "g int, v string")
    assert [(r.n_rows, r.n_distinct) for r in sk.distinct_of(sk.distinct_sketches(nulls, ["g"], "v")).collect()] == [(1, 0)]
    assert sk.merge_distinct(fine.limit(0), ["g"]).collect() == []


def test_quantile_sketches_merge(spark):
    df = spark.range(0, 100_000, 1, 7).select((F.col("id") % 2).alias("g"), (F.col("id") * 7919 % 100_003).alias("v"), (F.col("id") % 5).alias("load"))
    fine = storage.store(sk.quantile_sketches(df, ["g", "load"], "v"), "sketch")
    found = sk.quantiles_of(sk.merge_quantiles(fine, ["g"]), {"p10": 0.1, "p50": 0.5, "p999": 0.999})
    for r in found.collect():
        values = sorted(x.v for x in df.filter(F.col("g") == r.g).select("v").collect())
        assert r.n == len(values)
        for name, point in (("p10", 0.1), ("p50", 0.5), ("p999", 0.999)):
            below = sum(v < r[name] for v in values) / len(values)
            assert abs(below - point) <= 0.01


@pytest.mark.parametrize("seed", range(3))
def test_heavy_hitters_are_exact(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["hot", "warm", None, *map(str, range(3000))]), rng.choice([1, 2])) for _ in range(9000)]
    rows += [("hot", 1)] * 3000 + [("warm", 2)] * 200
    df = spark.createDataFrame(rows, "k string, j int").repartition(9)
    for share in (0.2, 0.01, 0.002):
        want = {x: n for x, n in Counter(rows).items() if n > share * len(rows)}
        assert {(r.k, r.j): r.n for r in sk.heavy_hitters(df, ["k", "j"], share).collect()} == want
    assert sk.heavy_hitters(df.limit(0), ["k"], 0.1).collect() == []
    assert sk.heavy_hitters(spark.range(100), ["id"], 0.5).collect() == []


def test_salted_join_is_the_join(spark):
    rng = random.Random(1)
    left = spark.createDataFrame([(rng.choice([1, 1, 1, 2, None, *range(3, 60)]), i, "x") for i in range(500)], "k int, id int, salt string")
    right = spark.createDataFrame([(k, f"r{k}", "y") for k in [1, 1, 2, 5, 77, None]], "k int, name string, heavy string")
    want = Counter(map(tuple, left.join(right, "k").select("k", "id", "salt", "name", "heavy").collect()))
    found = sk.salted_join(left, right, ["k"], share=0.05, salts=5)
    assert Counter(map(tuple, found.select("k", "id", "salt", "name", "heavy").collect())) == want


def test_grouping_sets(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice("xyz"), rng.randint(0, 9)) for _ in range(400)]
    df = spark.createDataFrame(rows, "p string, q int, r string, size bigint")
    sets = [["p", "q", "r"], ["q"], ["p", "r"], [], ["r"], ["q"]]
    want = Counter()
    for i, s in enumerate(sets):
        groups = {}
        for row in rows:
            key = tuple(v if c in s else None for c, v in zip("pqr", row))
            n, total = groups.get(key, (0, 0))
            groups[key] = (n + 1, total + row[3])
        want.update((i, *k, *v) for k, v in groups.items())
    assert Counter(map(tuple, sk.grouping_sets(df, sets, ["size"]).collect())) == want
    assert sk.grouping_sets(df.limit(0), sets, ["size"]).collect() == []
    assert "Expand" not in plan(sk.grouping_sets(df, sets, ["size"]))


def test_bucketed_tables_are_not_shuffled_again(spark):
    rows = [(f"o{i % 40}", f"p{i:03d}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "oid string, path string, size bigint")
    where = storage.scratch_path(spark, "bucketed")
    table = write_bucketed(df, f"bucketed_{where[-32:]}", where, 4)
    for job in (duplicate_groups(table), exact_dedup(table, ["path"]), table.join(duplicate_groups(table).hint("merge"), "oid")):
        assert "Exchange" not in plan(job)
    assert {tuple(r) for r in duplicate_groups(table).collect()} == {tuple(r) for r in duplicate_groups(df).collect()}
    assert {tuple(r) for r in exact_dedup(table, ["path"]).select("oid", "path").collect()} == {(f"o{i}", f"p{i:03d}") for i in range(40)}


def test_attributes(spark):
    rows = [
        (1, '{"k": 5, "s": "x"}'), (2, '{"k": "many"}'), (3, "{broken"), (4, None), (5, "{}"), (6, '{"k": null}'), (7, '{"k": 2.5}'),
        (8, '{"k": "12"}'), (9, ""), (10, '{"k": {"a": 1}}'), (11, '{"k": 99999999999999999999999}'),
    ]
    df = spark.createDataFrame(rows, "id int, props string").withColumn("variant", F.lit("own"))
    found = {r.id: r for r in read_attributes(df, "props", {"k": ("$.k", "bigint"), "s": ("$.s", "string")}).collect()}
    assert all(r.variant == "own" for r in found.values()) and len(found) == len(rows)
    assert (found[1].k, found[1].s, found[1].attribute_problem) == (5, "x", None)
    problems = {i: r.attribute_problem for i, r in found.items()}
    assert problems == {1: None, 2: "wrong type: k", 3: "not json", 4: None, 5: None, 6: None, 7: None, 8: None, 9: "not json", 10: "wrong type: k", 11: "wrong type: k"}
    assert found[8].k == 12 and found[4].k is None
