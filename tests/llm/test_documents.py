"""Operators on documents, against brute force."""

import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallybook.llm import decontaminate, mixing, quality, scoring, simhash
from tests.llm.data import DOCS, ROWS, docs, with_clashes

FOLDER = "/root/testdata/sf0.001"


def brute_fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots_of(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(n)]


def brute_components(rows, distance=3):
    prints = [brute_fingerprint(text) for _, text in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= distance]
    roots, least = roots_of(len(rows), links), defaultdict(list)
    for i, r in enumerate(roots):
        if rows[i][0] is not None:
            least[r].append(rows[i][0])
    return [(rows[i][0], prints[i], min(least[r], default=None)) for i, r in enumerate(roots)]


def as_found(df):
    return Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in df.collect())


def test_simhash_edge_cases(spark):
    for df in (docs(spark), with_clashes(docs(spark))):
        assert as_found(simhash.near_copies(df)) == Counter(brute_components([r[:2] for r in ROWS]))
    assert simhash.near_copies(docs(spark, [])).collect() == []


def test_simhash_on_table(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in table.collect()]
    changed = [(10_000 + i, " ".join(t.split()[:-1])) for i, t in rows[:40]]
    both = table.select("doc_id", "text").union(spark.createDataFrame(changed, "doc_id bigint, text string"))
    assert as_found(simhash.near_copies(both)) == Counter(brute_components(rows + changed))


@pytest.mark.parametrize("n", [2, 50, 700])
@pytest.mark.parametrize("distance", [0, 1, 3, 6])
def test_index_finds_all_pairs(n, distance):
    rng = np.random.default_rng(n + distance)
    base = rng.integers(0, 2**63, n, dtype=np.uint64)
    flips = np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, (4, n), dtype=np.uint64), axis=0)
    prints = np.unique(np.concatenate([base, base ^ flips]))
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    found = {(a, b) for x, y in simhash.near_pairs(prints, distance) for a, b in zip(x.tolist(), y.tolist())}
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    assert found == {(i, j) for i, j in zip(*[x.tolist() for x in np.nonzero(np.triu(apart <= distance, 1))])}


def test_large_groups_are_sliced_exactly(spark, monkeypatch):
    rng = np.random.default_rng(5)
    prints = np.unique(rng.integers(0, 2**14, 600).astype(np.int64) << 40)
    frame = spark.createDataFrame([(int(p),) for p in prints], "fp bigint")
    whole = {(r.node, r.root) for r in simhash.components(simhash.near_links(frame, 2)).collect()}
    monkeypatch.setattr(simhash, "SLICE_ROWS", 16)
    monkeypatch.setattr(simhash, "GROUP_ROWS", 100_000)
    assert {(r.node, r.root) for r in simhash.components(simhash.near_links(frame, 2)).collect()} == whole


def test_keep_one(spark):
    kept = simhash.keep_one(with_clashes(docs(spark)))
    assert kept.columns == with_clashes(docs(spark)).columns
    # 1-3 are copies; 4-6 have no words; 7 is repeated; the row without an id is alone
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 4, 7, 8, 9]
    assert simhash.keep_one(docs(spark, [])).count() == 0


def test_windows_edge_cases(spark):
    long_item = "the quick brown fox jumps over the lazy dog and then runs"
    items = [(1, long_item), (1, long_item), (2, "ONE"), (3, None), (4, ""), (None, "without an id"), (5, "amet lorem ipsum"), (6, "🦊 words")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for df in (docs(spark), with_clashes(docs(spark))):
        found = decontaminate.contamination(df, bench).collect()
        by = defaultdict(list)
        for r in found:
            by[r.doc_id].append((r.n_words, [tuple(s) for s in r.spans], r["items"]))
        assert by[1] == by[2] == by[3] == [(14, [(0, 12)], ["1"])]
        assert by[4] == by[5] == by[6] == [(0, [], [])]
        assert by[7] == [(1, [(0, 1)], ["2"])] * 2
        assert by[None] == [(5, [(2, 5)], [])]
        n_words, spans, named = by[8][0]
        assert (n_words, named, sum(e - b for b, e in spans)) == (100_000, ["5"], 19_999 * 3)
        assert by[9] == [(9, [(3, 5)], ["6"])]
    clean = decontaminate.remove_contaminated(with_clashes(docs(spark)), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [4, 5, 6]
    assert decontaminate.contamination(docs(spark, []), bench).count() == 0
    assert all(not r.spans for r in decontaminate.contamination(docs(spark), bench.limit(0)).collect())


def test_windows_in_slices(spark, monkeypatch):
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    whole = sorted(map(str, decontaminate.contamination(table, bench).collect()))
    monkeypatch.setattr(decontaminate, "SLICE_WINDOWS", 500)
    assert sorted(map(str, decontaminate.contamination(table, bench).collect())) == whole
    both = with_clashes(docs(spark)).unionByName(table.withColumns({c: F.lit("y") for c in set(with_clashes(docs(spark)).columns) - set(table.columns)}))
    left = sorted(r.doc_id or 0 for r in decontaminate.remove_contaminated(both, bench).collect())
    monkeypatch.setattr(decontaminate, "SLICE_WINDOWS", 10**6)
    assert left == sorted(r.doc_id or 0 for r in decontaminate.remove_contaminated(both, bench).collect()) and 0 < len(left) < both.count()


def brute_kneser_ney(trusted, asked, order):
    """log10 probability of the last byte of each n-gram of ``asked``."""
    grams = Counter(g for t in trusted for g in brute_grams(t, order))
    levels = {order: grams}
    for n in range(order - 1, 0, -1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])

    def discounts(counts):
        n = [sum(c == i for c in counts.values()) for i in (1, 2, 3, 4)]
        if not all(n):
            return [0.5, 1.0, 1.5]
        y = n[0] / (n[0] + 2 * n[1])
        return [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]

    taken = {n: discounts(levels[n]) for n in levels}
    heads = {n: defaultdict(list) for n in levels}
    for n, counts in levels.items():
        for g, c in counts.items():
            heads[n][g[:-1]].append(c)

    def p(g):
        n = len(g)
        lower = p(g[1:]) if n > 1 else 1 / 256
        counts = heads[n].get(g[:-1])
        if not counts:
            return lower
        d = taken[n]
        given = sum(d[min(c, 3) - 1] for c in counts)
        c = levels[n].get(g, 0)
        return ((c - d[min(c, 3) - 1] if c else 0) + given * lower) / sum(counts)

    return {g: math.log10(p(g)) for g in asked}


def brute_grams(text, order):
    padded = bytes(order - 1) + text.encode() + b"\0"
    return [padded[i : i + order] for i in range(len(padded) - order + 1)]


def test_kneser_ney_against_brute_force(spark):
    trusted = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "the end"] * 2 + ["that hat"]
    others = ["the cat ran", "xyz", ""]
    rows = [(t, 1) for t in trusted] + [(t, 0) for t in others]
    table = quality.log_probabilities(quality.count_grams(spark.createDataFrame(rows, "text string, trusted int")))
    got = {r.key: r.logp for r in table.collect()}
    asked = {g for t in trusted + others for g in brute_grams(t, quality.ORDER)}
    want = {int.from_bytes(g, "big"): v for g, v in brute_kneser_ney(trusted, asked, quality.ORDER).items()}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_quality_edge_cases(spark):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (7, 1, None), (None, 1, 0), (99, 1, 0)], "doc_id bigint, quality int, toxic int")
    for df in (docs(spark), with_clashes(docs(spark))):
        found = quality.judge(df, labels).collect()
        assert len(found) == len(ROWS)
        assert all((r.perplexity is None) == (r.n_bytes == 0) and r.limit > 0 for r in found)
        assert {r.doc_id for r in found if r.n_bytes == 0} == {4, 5} and not any(r.keep for r in found if r.n_bytes == 0)
        assert all(r.keep for r in found if r.doc_id == 1)
        kept = quality.keep_good(df, labels)
        assert kept.columns == df.columns and kept.count() == sum(r.keep for r in found)
    assert quality.judge(docs(spark, []), labels).count() == 0
    assert quality.keep_good(docs(spark), labels.limit(0)).count() == len(ROWS) - 2


def test_quality_against_brute_force(spark, monkeypatch):
    """Perplexity, limits and verdicts of a whole table, in many chunks."""
    monkeypatch.setattr(quality, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(quality, "SLAB", 3_000)
    table, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.lang, r.text) for r in table.collect()]
    good = {}
    for r in labels.collect():
        good[r.doc_id] = good.get(r.doc_id, True) and r.quality == 1 and r.toxic == 0
    fold = {i: spark_hash(i) % quality.FOLDS for i, ok in good.items() if ok}
    asked = {g for _, _, t in rows for g in brute_grams(t or "", quality.ORDER)}
    logp = brute_kneser_ney([t for i, _, t in rows if fold.get(i, 0) > 0], asked, quality.ORDER)
    perplexity = {i: 10 ** (-sum(logp[g] for g in brute_grams(t, quality.ORDER)) / (len(t.encode()) + 1)) for i, _, t in rows if t}
    lang = {i: x for i, x, _ in rows}

    def limit(of):
        held = sorted(perplexity[i] for i in fold if i in perplexity and lang[i] in of and fold[i] == 0)
        held = held or sorted(perplexity[i] for i in fold if i in perplexity and lang[i] in of)
        return held[math.ceil(quality.QUANTILE * len(held)) - 1] if held else None

    everything = limit(set(lang.values()))
    found = quality.judge(table.repartition(5), labels).collect()
    assert len(found) == len(rows)
    for r in found:
        wanted = limit({r.lang}) or everything
        assert r.perplexity == pytest.approx(perplexity[r.doc_id], rel=1e-5) and r.limit == pytest.approx(wanted, rel=1e-5)
        assert r.keep == (r.perplexity <= r.limit)
    assert 0 < sum(not r.keep for r in found) < len(found) / 2


def test_quality_shuffles_no_texts(spark):
    """Chunks lie in buckets, so only n-grams go to meet them; nothing is broadcast but labels and limits."""
    chunks = quality.in_chunks(docs(spark).select("doc_id", "text"))
    asked = quality.chunk_grams(chunks.select("chunk", F.coalesce("text", F.lit("")).alias("text"), F.lit(1).alias("trusted")))
    table = quality.log_probabilities(asked.groupBy("key").agg(F.sum("n").alias("n")))
    filled = chunks.withColumn("text", F.coalesce("text", F.lit("")))
    text = quality.add_up(filled, asked, table)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(chunk") == 1 and "Bucketed: true" in text, text


def test_quality_tells_labels_apart(spark):
    folder = "/root/testdata/sf0.01"
    table, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    share = {}
    rows = quality.judge(table, labels).join(labels, "doc_id").filter("toxic = 0").select("quality", "keep").collect()
    for q in (0, 1):
        kept = [r.keep for r in rows if r.quality == q]
        share[q] = sum(kept) / len(kept)
    assert share[1] > 0.97 and share[0] < 0.2


def brute_posteriors(texts, labels):
    """Naive Bayes on whole lists: (doc_id -> probabilities of the domains)."""
    domains, tokens = list(mixing.TARGETS), {i: set(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    hashed = {i: [bucket(w) for w in ws] for i, ws in tokens.items()}
    known = {i: d for i, d in labels.items() if d is not None and i in texts}
    learned = [i for i in known if spark_hash(i, 1) % 2 == 0]
    counts = {d: Counter(b for i in learned if known[i] == d for b in hashed[i]) for d in domains}
    each = [sum(known[i] == d for i in learned) for d in domains]
    priors = [math.log((c + 1) / (len(learned) + len(domains))) for c in each]

    @functools.cache
    def weights(b):
        seen = [counts[d][b] for d in domains]
        chance = [sum(seen) * c / max(len(learned), 1) for c in each]
        surprise = sum((x - e) ** 2 / (e + 0.5) for x, e in zip(seen, chance))
        return [(surprise / (surprise + mixing.SHRUNK)) ** 2 * math.log((x + 1) / (e + 1)) for x, e in zip(seen, chance)]

    scores = {i: [sum(weights(b)[k] for b in bs) for k in range(len(domains))] for i, bs in hashed.items()}

    def at(i, t, prior):
        x = [s / t + p for s, p in zip(scores[i], prior)]
        e = [math.exp(v - max(x)) for v in x]
        return [v / sum(e) for v in e]

    tried = [i for i in known if spark_hash(i, 1) % 2 == 1]
    best = (math.inf,)
    for t in mixing.TEMPERATURES:
        prior = priors
        for _ in range(100):
            p = {i: at(i, t, prior) for i in tried}
            loss = sum(-math.log(max(p[i][domains.index(known[i])], 1e-12)) for i in tried) / len(tried)
            best = min(best, (loss, t, prior))
            seen = [sum(x[k] for x in p.values()) for k in range(len(domains))]
            prior = [b + math.log((sum(known[i] == d for i in tried) + 1) / (s + 1)) for b, d, s in zip(prior, domains, seen)]
    return {i: at(i, *best[1:]) for i in texts}


def bucket(word):
    return xxhash.xxh64_intdigest(word.encode(), 42) % mixing.BUCKETS


def spark_hash(number, seed=None):
    """Spark's xxhash64 of a long, and a small whole number if given: each column's hash is the seed of the next; as F.pmod sees it, signed."""
    first = xxhash.xxh64_intdigest(number.to_bytes(8, "little", signed=True), 42)
    if seed is None:
        return first - (1 << 64) if first >> 63 else first
    return xxhash.xxh64_intdigest(seed.to_bytes(4, "little", signed=True), first)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_mixing_against_brute_force(spark, sf):
    folder = f"/root/testdata/{sf}"
    table = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", mixing.domain_of().alias("domain"))
    found = mixing.rates(table, labels, mixing.TARGETS).toPandas()
    p = found[[f"p_{d}" for d in mixing.TARGETS]].to_numpy()
    expected = brute_posteriors({r.doc_id: r.text for r in table.collect()}, {r.doc_id: r.domain for r in labels.collect()})
    assert np.abs(p - np.array([expected[i] for i in found.doc_id])).max() < 1e-7
    n = (found.copies * found.n_tokens).to_numpy(float)
    assert len(found) == table.count() and (found.rate >= 0).all()
    reached = (n * found.rate.to_numpy()) @ p / n.sum()
    targets = np.array(list(mixing.TARGETS.values()))
    assert np.abs(reached - targets).max() == pytest.approx(found.residual.max(), abs=1e-9)
    spread = n @ (found.rate.to_numpy() - 1) ** 2 / n.sum()
    assert found.residual.max() < 1e-6 or 0.7 * mixing.SPREAD < spread <= mixing.SPREAD + 1e-9, (spread, found.residual.max())
    assert sf == "sf0.001" or found.residual.max() < 1e-6
    truth = found.merge(labels.toPandas(), on="doc_id")
    best = truth[[f"p_{d}" for d in mixing.TARGETS]].to_numpy().argmax(axis=1)
    right = np.array(list(mixing.TARGETS))[best] == truth.domain.to_numpy()
    assert right.mean() > (0.85 if sf == "sf0.01" else 0.7)  # sf0.001 has 58 labels, half of them to learn from


def test_mixing_out_of_reach(spark):
    """One posterior for all: the shares cannot move, and the residual says so."""
    rows = [(i, "same words", "en", "a", 10) for i in range(6)]
    labels = spark.createDataFrame([(0, "clean"), (1, "toxic")], "doc_id bigint, domain string")
    found = mixing.rates(spark.createDataFrame(rows, DOCS), labels, {"clean": 0.9, "toxic": 0.1}).collect()
    shares = {(r.p_clean, r.p_toxic) for r in found}
    assert len(shares) == 1 and len({r.residual for r in found}) == 1
    left = max(abs(found[0].rate * p - t) for p, t in zip(next(iter(shares)), (0.9, 0.1)))
    assert found[0].residual == pytest.approx(left, abs=1e-6) and left > 0.1


def test_mixing_does_not_draw_a_few_over_and_over(spark):
    """Targets beyond what documents are like: rates change no more than SPREAD, and most documents stay."""
    rng = np.random.default_rng(3)
    p = rng.uniform(0.08, 0.16, 500)
    rows = [(1, int(rng.integers(1, 50)), float(1 - x), float(x)) for x in p]
    table = spark.createDataFrame(rows, "copies bigint, n_tokens bigint, p0 double, p1 double")
    n = np.array([r[1] for r in rows], float)
    for shares in ([0.95, 0.05], [0.5, 0.5], [1.0, 0.0]):
        multipliers, residual = mixing.descend(table, shares)
        rate = np.maximum(0, 1 - np.stack([1 - p, p], 1) @ multipliers)
        assert n @ (rate - 1) ** 2 / n.sum() <= mixing.SPREAD and (rate > 0).mean() > 0.4 and residual > 0.01
        both = np.stack([1 - p, p], 1)
        off = lambda r: np.linalg.norm((n * r) @ both / n.sum() - shares)
        assert off(rate) < off(np.ones(500))


def test_mixing_with_rates_at_zero(spark, monkeypatch):
    """Targets that force many rates to 0 are met as well, where rates may change that much."""
    monkeypatch.setattr(mixing, "SPREAD", 1e9)
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    rows = [(1, int(rng.integers(1, 50)), *map(float, x)) for x in p]
    table = spark.createDataFrame(rows, "copies bigint, n_tokens bigint, p0 double, p1 double, p2 double")
    n = np.array([r[1] for r in rows], float)
    for shares in ([0.9, 0.08, 0.02], [0.97, 0.02, 0.01], [1 / 3, 1 / 3, 1 / 3], [0.02, 0.03, 0.95]):
        multipliers, residual = mixing.descend(table, shares)
        rate = np.maximum(0, 1 - p @ multipliers)
        assert residual < 1e-6 and np.abs((n * rate) @ p / n.sum() - shares).max() < 1e-6


def test_mixing_edge_cases(spark):
    labels = spark.createDataFrame([(1, "clean"), (2, "toxic"), (2, "clean"), (8, "low"), (None, "low"), (9, None), (7, "other")], "doc_id bigint, domain string")
    for df in (docs(spark), with_clashes(docs(spark))):
        found = mixing.rates(df, labels, mixing.TARGETS).collect()
        assert sum(r.copies for r in found) == len(ROWS)
        assert {r.doc_id for r in found if r.n_tokens == 0} == {4, 5, 6}
        assert all(abs(r.p_clean + r.p_toxic + r.p_low - 1) < 1e-9 and r.rate >= 0 for r in found)
        mixed = mixing.mix(df, labels, mixing.TARGETS)
        assert set(mixed.columns) == {*df.columns, "rate", "times"} and all(r.times >= 1 for r in mixed.collect())
    assert mixing.rates(docs(spark, []), labels, mixing.TARGETS).count() == 0
    alone = mixing.rates(docs(spark), labels.limit(0), mixing.TARGETS).collect()
    assert len({(r.p_clean, r.p_toxic) for r in alone}) == 1
    with pytest.raises(ValueError):
        mixing.rates(docs(spark), labels, {"clean": 0.5})


def brute_base(rows):
    tokens = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(counts.values()), len(counts)
    return [(i, h, len(t), sum(counts[w] > 0 for w in t), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)) for (i, _), t, h in zip(rows, tokens, held)]


def key(row):
    return tuple((x is None, x) for x in row)


@pytest.mark.parametrize("rows", ["edge", "table"])
def test_scores_against_brute_force(spark, rows):
    df = docs(spark) if rows == "edge" else spark.read.parquet(f"{FOLDER}/documents.parquet")
    plain = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    found = scoring.language_model_scores(with_clashes(df)).collect()
    want = sorted(brute_base(plain), key=key)
    got = sorted(([*r][:6] for r in found), key=key)
    assert [g[:5] for g in map(list, got)] == [list(w[:5]) for w in want]
    assert all(g[5] == pytest.approx(w[5], abs=1e-6) for g, w in zip(got, want))
    assert all(r.score < 0 for r in found)
    assert sum(r.score for r in found if not r.held_out) > sum(r.base_score for r in found if not r.held_out)


def test_scores_of_empty_table_and_chunks(spark, monkeypatch):
    assert scoring.language_model_scores(docs(spark, [])).count() == 0
    df = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    whole = {r.doc_id: r.score for r in scoring.language_model_scores(df).collect()}
    monkeypatch.setattr(scoring, "CHUNK_WORDS", 300)
    for r in scoring.language_model_scores(df.repartition(3)).collect():
        assert r.score == pytest.approx(whole[r.doc_id], abs=1e-3)


def test_scores_do_not_depend_on_parts(spark, monkeypatch):
    """A long text, with unseen words, scores alike in whatever parts it and the training texts are taken."""
    rng = np.random.default_rng(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary, 700)), "en", "a", 1) for i in range(14)]
    rows += [(100, " ".join(rng.choice([*vocabulary, *(f"new{i}" for i in range(200))], 9000)), "en", "a", 1)]
    df, found = spark.createDataFrame(rows, DOCS), []
    for slab, counted in ((60_000, 1 << 30), (2_500, 1 << 30), (333, 5_000)):
        monkeypatch.setattr(scoring, "SLAB", slab)
        monkeypatch.setattr(scoring, "MOST_COUNTED", counted)
        found.append({r.doc_id: r.score for r in scoring.language_model_scores(df).collect()})
    for other in found[1:]:
        assert other == pytest.approx(found[0], abs=1e-6)


def test_token_probabilities_add_up():
    """Over all next symbols the paths of binary decisions share exactly 1."""
    from tallybook.llm import mixer

    code, length = mixer.codes([5, 1, 9, 2, 2, 7])
    tables = np.zeros((mixer.N, 1 << mixer.SLOT_BITS, 2), np.int64)
    seen = np.array([0, 2, 2, 5, 1, 2])
    mixer.count(scoring._events(seen, np.zeros(6, int), [], code, length), tables)
    evidence = mixer.logits(tables)
    total = 0.0
    for last in range(6):
        state = mixer.Texts(1)
        state.add(scoring._events(np.array([2, 5, last]), np.zeros(3, int), [], code, length), evidence)
        before = mixer.Texts(1)
        before.add(scoring._events(np.array([2, 5]), np.zeros(2, int), [], code, length), evidence)
        total += 10 ** (state.score[0] - before.score[0])
    assert total == pytest.approx(1, abs=1e-6)
