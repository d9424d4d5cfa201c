"""Spelling variants, against brute force over all pairs of words."""

import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallybook.llm import queries, variants
from tests.llm.data import DOCS, ROWS, docs, with_clashes


def brute_words(rows, least_length=6, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(str.maketrans(variants.UPPER, variants.LOWER))
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= least_length:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def brute_near(words):
    near = {w: set() for w in words}
    for a, b in itertools.combinations(sorted(words), 2):
        if abs(len(a) - len(b)) < 2 and one_edit(a, b):
            near[a].add(b)
            near[b].add(a)
    return near


def brute(rows, **how):
    words = brute_words(rows, **how)
    near = brute_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return Counter((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def found(df):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_on_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = brute(rows)
    assert found(queries.op11_spelling_variants(spark, folder)) == expected
    assert sum(1 for r in expected if r[1]) > 0


def test_odd_rows(spark):
    for df in (docs(spark), with_clashes(docs(spark)).withColumns({c: F.lit("z") for c in ("n", "form", "root", "gram", "other", "doc", "run")})):
        assert found(variants.variants(df)) == brute([r[:2] for r in ROWS])
    assert variants.variants(docs(spark, [])).collect() == []
    assert variants.variants(docs(spark, [(1, None, None, None, None), (None, "", None, None, 0)])).collect() == []


def test_forms_lead_to_roots(spark):
    """A chain of forms, ties, a hot word that is a third of all, and capitals beyond A-Z."""
    times = {"colouring": 5, "colourinng": 1, "coloring": 30, "colorings": 200, "coloringss": 1200, "abcdef": 5, "abcdeg": 25, "abcdeh": 25, "Éclair": 6, "éclair": 40, "aaaaaa": 7, "aaaaaaa": 36}
    rows = [(None, " ".join([w] * n), "en", "a", 0) for w, n in times.items()]
    rows += [(None, " ".join(["hotword"] * 3000), "en", "a", 0)]
    got = found(variants.variants(spark.createDataFrame(rows, DOCS)))
    assert got == brute([r[:2] for r in rows])
    assert {r[0]: r[2] for r in got}["colouring"] == "coloringss"


@pytest.mark.parametrize("letters", ["ab", "abc", "abcdefé"])
def test_no_near_pair_is_lost(spark, letters):
    """Words of few letters repeat their bigrams, which is hardest on prefixes."""
    pick = random.Random(len(letters))
    words = {"".join(pick.choice(letters) for _ in range(pick.randint(4, 9))) for _ in range(500)}
    for w in list(words)[:150]:
        i = pick.randrange(len(w))
        words |= {w[:i] + w[i + 1 :], w[:i] + pick.choice(letters) + w[i:], w[:i] + pick.choice(letters) + w[i + 1 :]}
    words = sorted(w for w in words if len(w) >= 4)
    pairs = {(r.word, r.other) for r in variants.near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    assert pairs == {(a, b) for a, near in brute_near(words).items() for b in near}


def test_pivots_are_the_cheapest_disjoint_pair():
    pick = random.Random(3)
    for _ in range(300):
        places = sorted(pick.sample(range(12), pick.randint(3, 7)))
        prefix = [(p, pick.randint(1, 9)) for p in places]
        pairs = [(i, j) for i, j in itertools.combinations(range(len(prefix)), 2) if places[j] - places[i] >= 2]
        chosen = variants.pivots(prefix)
        assert tuple(chosen) in pairs
        assert sum(prefix[k][1] for k in chosen) == min(prefix[i][1] + prefix[j][1] for i, j in pairs)


def test_too_short(spark):
    with pytest.raises(ValueError):
        variants.variants(docs(spark), least_length=3)
