"""Quality rules by weak supervision, against brute force and against labels they never saw."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tallybook.llm import queries, rules
from tests.llm.data import ROWS, docs, with_clashes

FOLDER = "/root/testdata/sf0.001"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute_base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    failed = n < 50 or 100 * len(again) > 50 * n
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(again), failed)


def base_of(df):
    return Counter((r.doc_id, *[r[c] for c in BASE]) for r in df.collect())


def brute_posteriors(votes, good, prior, strength_share):
    """A document at a time, without patterns or matrices."""
    rules_n, n = len(votes[0]), len(votes)
    strength = strength_share * n
    rate = [[dict(zip((1, -1, 0), p)) for _ in range(rules_n)] for p in prior]
    share, last = good, None
    while True:
        chance = []
        for row in votes:
            like = [math.log(share), math.log(1 - share)]
            for c in (0, 1):
                like[c] += sum(math.log(rate[c][j][v]) for j, v in enumerate(row))
            chance.append(1 / (1 + math.exp(min(700, like[1] - like[0]))))
        if last and max(abs(a - b) for a, b in zip(chance, last)) < 1e-11:
            return chance
        last = chance
        for j in range(rules_n):
            new = []
            for c in (0, 1):
                w = chance if c == 0 else [1 - x for x in chance]
                total = sum(w) + strength
                new.append({v: (sum(x for x, r in zip(w, votes) if r[j] == v) + strength * p) / total for v, p in zip((1, -1, 0), prior[c])})
            new[0][-1] = min(new[0][-1], new[1][-1])
            new[1][1] = min(new[1][1], new[0][1])
            for c in (0, 1):
                whole = sum(new[c].values())
                rate[c][j] = {v: x / whole for v, x in new[c].items()}
        share = (sum(chance) + strength * good) / (n + strength)


def test_edge_cases(spark):
    for df in (docs(spark), with_clashes(docs(spark))):
        assert base_of(rules.judge(df)) == Counter((r[0], *brute_base(r[1])) for r in ROWS)
    assert rules.judge(docs(spark, [])).collect() == []
    nothing = rules.judge(docs(spark, [(None, None, None, None, None)])).collect()[0]
    assert (nothing.doc_id, nothing.n_words, nothing.base_failed, nothing.kept) == (None, 0, True, False)
    assert all(nothing[f"vote_{r.name}"] == 0 for r in rules.RULES)


@pytest.mark.parametrize("text", ["a a a a", "a b c a b c", "a b a b a", "x", "", "a b c d", "# a\n# a\n \n\n# a", "é é é é é", "a\x0bb\x0cc a b c"])
def test_base_counts(text):
    found = dict(zip(rules.COUNTS, rules.counts_of(text.encode())))
    assert tuple(found[c] for c in BASE[:5]) == brute_base(text)[:5]


def test_on_table_against_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    found = queries.op13_quality_rules(spark, FOLDER)
    assert base_of(found) == Counter((i, *brute_base(t)) for i, t in texts.items())
    rows = sorted(found.collect())
    votes = [[r[f"vote_{x.name}"] for x in rules.RULES] for r in rows]
    expected = brute_posteriors(votes, rules.PRIOR_GOOD, rules.PRIOR_VOTES, rules.STRENGTH)
    assert [r.quality for r in rows] == pytest.approx(expected, abs=1e-7)
    assert [r.kept for r in rows] == [not r.base_failed and p >= 0.5 for r, p in zip(rows, expected)]


def test_labels_it_never_saw(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    seen = queries.op13_quality_rules(spark, folder).join(labels, "doc_id").filter("not base_failed")
    judged = seen.select(labels.quality.alias("good"), "kept").collect()
    shares = {q: np.mean([r.kept for r in judged if r.good == q]) for q in (0, 1)}
    assert shares[1] >= 0.99 and shares[0] <= 0.05


def test_accuracies_are_recovered():
    rng = np.random.default_rng(5)
    n, right = 20_000, np.array([0.95, 0.9, 0.85, 0.8, 0.9])
    good = rng.random(n) < 0.85
    truth = np.where(good, 1, -1)[:, None]
    votes = np.where(rng.random((n, 5)) < right, truth, -truth) * (rng.random((n, 5)) < 0.8)
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    trust = rules.estimate(patterns, times)
    kept = trust.posterior(votes) >= 0.5
    all_pass = ~(votes < 0).any(1)
    assert np.mean(kept == good) > 0.95 > np.mean(all_pass == good) + 0.1
    assert sorted(np.argsort(trust.accuracy())[-1:]) == [0] and np.argmin(trust.accuracy()) == 3


def test_one_slight_fault_does_not_condemn():
    base = np.zeros((2, len(rules.RULES)), int)
    base[:, 0] = base[:, -1] = base[:, -2] = 1
    base[1, 3] = -1
    many = np.array([9_900, 100])
    assert (rules.estimate(base, many).posterior(base) >= 0.5).all()


def test_patterns_are_read_back():
    assert rules.votes_of([0, 4, 8], 2).tolist() == [[-1, -1], [0, 0], [1, 1]]
    assert rules.votes_of([], 3).shape == (0, 3)


def test_too_many_rules(spark):
    with pytest.raises(ValueError):
        rules.judge(docs(spark), rules.RULES * 2)
