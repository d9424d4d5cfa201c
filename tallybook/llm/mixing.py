"""Rates at which documents are drawn so that domains get their share of tokens.

Documents belong to domains softly: a naive Bayes classifier, fitted to a table of
labels, gives each document a probability for each domain. Rates r >= 0 are then
fitted by projected gradient steps on a least-squares sum so that the expected tokens of each domain,
the sum of r x tokens x probability, meet their target. The gradient of a document's rate is its probabilities times one
multiplier for each domain. So gradients add up in the multipliers, and the rates are at any time the projection
max(0, 1 - probabilities x multipliers), in no need of being stored: a pass over the table gives the few sums that the next
step needs. DataFrame functions alone.

Every token counts, by the hash it falls under. The classifier is a table of BUCKETS rows, whatever the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store
from tallybook.llm.common import decide, free_name

MOST_LABELLED = 20_000  # labelled documents fitted to, at most, chosen by a hash of their id
BUCKETS = 1 << 16  # tokens share weights by their hash
SHRUNK = 50.0  # a token's squared surprise, over the domains, at which it has a quarter of its weight
TEMPERATURES = tuple(2.0**k for k in range(-2, 8))
CLOSE = 1e-7  # of all tokens; steps end when every domain is this near its target
CHANGE = 1e-9  # what the squares of changed rates count against those of missed targets
SPREAD = 1.0  # mean squared change of rates, by tokens, at most: as much as halves the effective number of tokens
SHORTER = tuple(0.5**k for k in range(1, 25))  # lengths tried where a step of length 1 goes too far

# Domains by the labels table: what quality and toxic say.
DOMAINS = ("clean", "toxic", "low")
TARGETS = {"clean": 0.92, "toxic": 0.05, "low": 0.03}


def domain_of(quality: str = "quality", toxic: str = "toxic") -> Column:
    """Domain of a row of labels; null if a label is."""
    low, bad = F.col(quality) == 0, F.col(toxic) == 1
    return F.when(bad & F.col(quality).isNotNull(), "toxic").when(low & ~bad, "low").when(~low & ~bad, "clean")


def _sum(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _buckets(rows: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """keys, n_tokens, at, bucket: a row for each distinct token between white space, and one of bucket -1 without any.

    Each text has one row at 0.
    """
    parts = rows.select(*keys, F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), r"[\x20\x09-\x0D]+").alias("parts"))
    # Counted below the explode: beside it, the count would be made anew for each token.
    counted = parts.withColumn("n_tokens", F.size(F.array_remove("parts", "")).cast("bigint"))
    tokens = counted.select(*keys, "n_tokens", F.posexplode(F.array_distinct("parts")).alias("at", "token"))
    bucket = F.when(F.col("token") == "", -1).otherwise(F.pmod(F.xxhash64("token"), F.lit(BUCKETS)))
    return tokens.select(*keys, "n_tokens", "at", bucket.cast("int").alias("bucket"))


class Classifier:
    """Weights (bucket, one column w0, w1, .. for each domain), prior logarithms, temperature."""

    def __init__(self, weights: DataFrame, priors: Sequence[float], domains: Sequence[str]):
        self.weights, self.priors, self.domains, self.temperature = weights, priors, domains, 1.0

    def scores(self, rows: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
        """keys, copies (of equal keys), n_tokens and s0, s1, .. of one copy."""
        # BUCKETS + 1 rows: the size is known beforehand.
        hits = _buckets(rows, keys, text).join(F.broadcast(self.weights), "bucket")
        copies = F.count_if(F.col("at") == 0)
        sums = [(F.sum(f"w{i}") / copies).alias(f"s{i}") for i in range(len(self.domains))]
        return hits.groupBy(*keys).agg(copies.alias("copies"), F.max("n_tokens").alias("n_tokens"), *sums)

    def posteriors(self, temperature: float) -> list[Column]:
        scores = [F.col(f"s{i}") / temperature + prior for i, prior in enumerate(self.priors)]
        high = F.greatest(*scores) if len(scores) > 1 else scores[0]
        parts = [F.exp(s - high) for s in scores]
        return [p / _sum(parts) for p in parts]


def fit(docs: DataFrame, labels: DataFrame, domains: Sequence[str], id_col: str, text_col: str) -> Classifier:
    """Naive Bayes on which tokens a text has, over all tokens of the labelled documents, by bucket.

    A bucket's weight for a domain is the logarithm of how often its tokens occur there against how often they would by chance,
    shrunk by how surprising that is: the many tokens seen a few times say little, and none is left out.

    ``labels`` has (doc_id, domain); ids with several domains, or none of ``domains``, are left out.
    Half of the labelled documents give the weights, the other half the temperature and priors
    that make the probabilities most likely: a long text does not become certain by its length alone.
    """
    known = labels.filter(F.col("domain").isin(*domains) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min("domain").alias("domain"), F.max("domain").alias("other")).filter("domain = other")
    here = docs.select(F.col(id_col).alias("doc_id")).join(known, "doc_id").select("doc_id", "domain").distinct()
    chosen = store(here.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST_LABELLED), "chosen")
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).alias("half")
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    rows = plain.join(F.broadcast(chosen), "doc_id").select("doc_id", F.xxhash64("text").alias("hash"), "domain", half, "text")
    rows = store(rows.distinct(), "labelled")

    learned = rows.filter("half = 0")
    counts = {r.domain: r["count"] for r in learned.groupBy("domain").count().collect()}
    n, each = sum(counts.values()), [counts.get(d, 0) for d in domains]
    priors = [math.log((c + 1) / (n + len(domains))) for c in each]
    kinds = range(len(domains))
    seen = _buckets(learned, ["domain"], "text").filter("bucket >= 0").groupBy("bucket")
    seen = seen.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)])
    all_buckets = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = all_buckets.join(seen, "bucket", "left").na.fill(0)
    chance = [F.col("n") * (c / max(n, 1)) for c in each]
    surprise = _sum([F.pow(F.col(f"n{i}") - e, 2) / (e + 0.5) for i, e in enumerate(chance)])
    trust = F.pow(surprise / (surprise + SHRUNK), 2)
    weights = [(trust * F.log((F.col(f"n{i}") + 1) / (e + 1))).alias(f"w{i}") for i, e in enumerate(chance)]
    none = rows.sparkSession.range(1).select(F.lit(-1).alias("bucket"), *[F.lit(0.0).alias(f"w{i}") for i in kinds])
    model = Classifier(store(filled.select("bucket", *weights).union(none), "weights"), priors, domains)

    # MOST_LABELLED rows of a few numbers at most.
    tried = model.scores(rows.filter("half = 1"), ["doc_id", "hash", "domain"], "text").collect()
    if tried:
        scores = np.array([[r[f"s{i}"] for i in kinds] for r in tried])
        true = np.array([domains.index(r.domain) for r in tried])
        model.temperature, model.priors = calibrate(scores, true, priors)
    return model


def calibrate(scores: np.ndarray, true: np.ndarray, priors: Sequence[float]) -> tuple[float, list[float]]:
    """The temperature, and the prior logarithms that go with it, under which the known domains are most likely.

    For each temperature the priors are moved until the probabilities of each domain add up to the number of its documents.
    """
    best = (math.inf, 1.0, list(priors))
    known = np.bincount(true, minlength=len(priors))
    for t in TEMPERATURES:
        prior = np.array(priors)
        for _ in range(100):
            z = scores / t + prior
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            loss = float(-np.log(np.maximum(p[np.arange(len(true)), true], 1e-12)).mean())
            best = min(best, (loss, t, prior.tolist()))
            prior = prior + np.log((known + 1) / (p.sum(axis=0) + 1))
    return best[1], best[2]


def rates(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, hash, copies, n_tokens, p_<domain>, .., rate, residual of each distinct (doc_id, text) of ``docs``.

    ``labels`` (doc_id, domain) teaches the domains named by ``targets``, whose values are shares of all tokens of ``docs`` and must add
    up to 1. Rates start at 1 and are as near to the targets as nonnegative rates come; ``residual``, one
    value for all rows, is the largest distance left, as a share of all tokens. It is near 0 unless targets are out of reach:
    a domain that no document can be of, posteriors that are all the same, or targets that only a few
    documents, drawn over and over, could meet. ``SPREAD`` bounds the mean squared change of the rates, so that these do not replace all others.
    ``hash`` tells texts of one id apart; ``copies`` counts equal rows, which
    share one rate. A null or empty text has no tokens and its rate is what the steps make of its prior. Without labels
    all probabilities are the same. An empty table gives an empty result. Other columns are not looked at.
    """
    domains = list(targets)
    if abs(sum(targets.values()) - 1) > 1e-9 or min(targets.values()) < 0:
        raise ValueError("targets must be shares that add up to 1")
    model = fit(docs, labels, domains, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
    scored = model.scores(rows, ["doc_id", "hash"], "text")
    shares = [p.alias(f"p{i}") for i, p in enumerate(model.posteriors(model.temperature))]
    table = store(scored.select("doc_id", "hash", "copies", "n_tokens", *shares), "posteriors")
    multipliers, residual = descend(table, [targets[d] for d in domains])
    named = [F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)]
    rate = _rate(multipliers).alias("rate")
    return table.select("doc_id", "hash", "copies", "n_tokens", *named, rate, F.lit(residual).alias("residual"))


def _rate(multipliers: Sequence[float]) -> Column:
    return F.greatest(F.lit(0.0), 1.0 - _sum([F.col(f"p{i}") * float(x) for i, x in enumerate(multipliers)]))


def descend(table: DataFrame, shares: Sequence[float]) -> tuple[np.ndarray, float]:
    """Multipliers at which the rates are nearest to the targets, and the largest distance left, as a share of all tokens.

    Minimised is the squared distance of the domains' totals from their targets plus ``change`` times the squared changes of the
    rates. ``change`` is CHANGE, which only makes the answer one, or, if the rates would then change by more than
    SPREAD, as small as keeps them to it. In the multipliers that is a convex function of a few numbers. Its
    gradient is the missed totals, its curvature the products of probabilities summed over documents with a rate above 0; steps
    are scaled by it, and taken shorter if they go too far. They end at the targets, or where no step goes down any more.
    """
    n = len(shares)
    pairs = [(i, j) for i in range(n) for j in range(i, n)]
    whole = table.agg(F.sum(F.col("copies") * F.col("n_tokens"))).first()[0]
    if not whole:
        return np.zeros(n), 0.0
    part = F.col("copies") * F.col("n_tokens") / float(whole)
    targets = np.array(shares)

    def half_squares(multipliers: np.ndarray) -> Column:
        return F.sum(part * _rate(multipliers) * _rate(multipliers)) / 2

    def look(multipliers: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Half the squares of the rates, totals of the domains, and the matrix over documents with a rate above 0."""
        at = table.select(part.alias("part"), *[f"p{i}" for i in range(n)], _rate(multipliers).alias("rate"))
        sums = [F.sum(F.col("part") * F.col("rate") * F.col("rate")) / 2]
        sums += [F.sum(F.col("part") * F.col("rate") * F.col(f"p{i}")) for i in range(n)]
        sums += [F.sum(F.when(F.col("rate") > 0, F.col("part") * F.col(f"p{i}") * F.col(f"p{j}")).otherwise(0.0)) for i, j in pairs]
        row = at.agg(*sums).first()
        matrix = np.zeros((n, n))
        for (i, j), x in zip(pairs, row[1 + n :]):
            matrix[i, j] = matrix[j, i] = x
        return row[0], np.array(row[1 : 1 + n]), matrix

    def solve(change: float, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Multipliers, totals and mean squared change of the rates."""
        squares, totals, matrix = look(at)
        unit = change * first
        value = lambda squares, x: squares + float(targets @ x) + unit / 2 * float(x @ x)
        now = value(squares, at)
        while np.abs(totals - targets - unit * at).max() > CLOSE:
            step = np.linalg.solve(matrix + unit * np.eye(n), totals - targets - unit * at)
            found = look(at + step)
            if not value(found[0], at + step) < now:
                tries = [at + step * length for length in SHORTER]
                row = table.agg(*[half_squares(x).alias(f"x{i}") for i, x in enumerate(tries)]).first()
                least, i = min((value(q, x), i) for i, (q, x) in enumerate(zip(row, tries)))
                if not least < now:
                    break
                step = step * SHORTER[i]
                found = look(at + step)
            moved = value(found[0], at + step)
            if not moved < now - 1e-14 * abs(now):
                break
            at, now, (squares, totals, matrix) = at + step, moved, found
        return at, totals, 2 * squares - 2 * float(totals.sum()) + 1

    first = float(np.trace(look(np.zeros(n))[2])) / n
    best = solve(CHANGE, np.zeros(n))
    if best[2] > SPREAD:
        low, high = math.log(CHANGE), 0.0
        best = solve(1.0, np.zeros(n))
        while high - low > 0.1:
            middle = (low + high) / 2
            found = solve(math.exp(middle), best[0])
            if found[2] > SPREAD:
                low = middle
            else:
                high, best = middle, found
    return best[0], float(np.abs(best[1] - targets).max())


def mix(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are drawn, with ``rate`` and ``times``, how often each is to be taken.

    ``times`` is the rate rounded up or down by a hash of id and text, in proportion to
    what is lost or gained; rows to be taken zero times are left out. A column of ``docs`` of either name is replaced.
    """
    drawn = rates(docs, labels, targets, id_col, text_col)
    chance = F.pmod(F.xxhash64("doc_id", "hash", F.lit(17)), F.lit(1 << 20)) / float(1 << 20)
    plain = docs.drop("rate", "times")
    key = free_name(plain, "text_hash")
    drawn = drawn.select(
        F.col("doc_id").alias(id_col), F.col("hash").alias(key), "rate", F.floor(F.col("rate") + chance).alias("times")
    )
    joined = decide(plain.withColumn(key, F.xxhash64(text_col)), drawn.filter("times > 0"), [id_col, key], "inner")
    return joined.drop(key)
