"""Quality rules as weak supervision: rules vote or abstain, and their accuracies are learned.

Each rule looks at one measure of a text and votes good, votes bad, or abstains.
No rule decides alone. What rules say together tells how far each can be trusted: how
often it votes what on good and on bad documents is estimated by
expectation-maximisation without any label, and a document is kept by its posterior
probability of being good.

The model needs only how often each pattern of votes occurs. With ten rules there are at
most 3^10 = 59,049 patterns, whatever the corpus, and they are counted over all documents.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store

# The symbols that are counted.
SYMBOLS = b"#*$%&|<>"

# Frequent short words of the languages of the corpus.
FREQUENT = frozenset(
    "the of and to in is that it for was on are as with be by this at or an from "
    "de la le les et des en un une du que est pour dans qui par sur pas "
    "der die und das den von zu mit ist im für auf nicht ein eine dem "
    "el los las y por con para una su se lo al del es no".encode().split(b" ")
)

MOST_RULES = 10  # 3^10 = 59,049 patterns of votes are the most the model gathers

# Where the estimate starts, and what it is drawn to: the share of good documents, and how often a
# rule votes good, votes bad or abstains on good and on bad documents.
PRIOR_GOOD = 0.9
PRIOR_VOTES = ((0.3, 0.005, 0.695), (0.2, 0.2, 0.6))
STRENGTH = 0.2  # the starting values count for so large a share of all documents
CLOSE = 1e-10
MOST_STEPS = 10_000  # a bound against rounding that never settles; reached, it raises an error


@dataclass(frozen=True)
class Rule:
    """Votes bad outside ``fair``, good within ``good`` (none: never), else abstains, as it does without a measure."""

    name: str
    measure: str
    fair: tuple[float, float]
    good: tuple[float, float] | None = None

    def vote(self) -> Column:
        value = F.col(self.measure)
        vote = F.when((value < self.fair[0]) | (value > self.fair[1]), -1)
        return (vote.when(value.between(*self.good), 1) if self.good else vote).otherwise(0)


# A measure far out of range breaks two rules, so that one slight fault alone condemns no document.
RULES = (
    Rule("word_length", "chars_per_word", (2.0, 14.0), (3.0, 9.0)),
    Rule("some_symbols", "symbols_per_word", (0.0, 0.1)),
    Rule("many_symbols", "symbols_per_word", (0.0, 0.3)),
    Rule("digits", "digits_per_char", (0.0, 0.3)),
    Rule("marks", "marks_per_word", (0.0, 0.2)),
    Rule("capitals", "upper_share", (0.0, 0.3)),
    Rule("repeated_lines", "repeated_lines", (0.0, 0.4)),
    Rule("repeated_words", "repeated_words", (0.0, 0.4)),
    Rule("ended_lines", "ended_lines", (0.2, 1.0), (0.6, 1.0)),
    Rule("frequent_words", "frequent_words", (0.02, 1.0), (0.08, 1.0)),
)

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_ended", "n_digits", "n_marks", "n_upper", "n_letters", "n_frequent",
)

_UPPER = bytes(range(0x41, 0x5B))
_LOWER = bytes(range(0x61, 0x7B))
_NO_POINTS = bytes.maketrans(b'.,;:!?"()', b" " * 9)


def repeated_windows(words: Sequence[bytes], size: int = 3) -> int:
    """Words in windows of ``size`` words that occur twice or more, the first occurrence included."""
    n = len(words)
    if n <= size:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, n)
    window = code[: n - size + 1]
    for k in range(1, size):  # renumbered each time, so the product cannot overflow
        window = np.unique(window * len(ids) + code[k : n - size + 1 + k], return_inverse=True)[1]
    often = np.flatnonzero(np.bincount(window)[window] > 1)
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[often + k] = True
    return int(covered.sum())


def counts_of(text: bytes | None) -> tuple[int, ...]:
    """The COUNTS of a text; all zero for null."""
    text = text or b""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    upper = len(text) - len(text.translate(None, _UPPER))
    return (
        len(words),
        len(b"".join(words).decode("utf-8", "replace")),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_windows(words),
        len(lines),
        sum(line.rstrip().endswith((b".", b"!", b"?", b":", b";", b'"', b")")) for line in lines),
        len(text) - len(text.translate(None, b"0123456789")),
        text.count(b"!") + text.count(b"?"),
        upper,
        upper + len(text) - len(text.translate(None, _LOWER)),
        sum(map(FREQUENT.__contains__, text.lower().translate(_NO_POINTS).split())),
    )


def with_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and COUNTS of each row; whole texts, where they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.array([counts_of(t.as_py()) for t in texts], np.int64).reshape(-1, len(COUNTS))
            columns = [pa.array(np.ascontiguousarray(found[:, i])) for i in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *COUNTS])

    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS))


def measures() -> dict[str, Column]:
    """What rules look at; null, and so no vote, where a text is too short to tell."""

    def share(part: str, whole: str, least: int = 1) -> Column:
        return F.when(F.col(whole) >= least, F.col(part) / F.col(whole))

    return {
        "chars_per_word": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "digits_per_char": share("n_digits", "word_chars"),
        "marks_per_word": share("n_marks", "n_words"),
        "upper_share": share("n_upper", "n_letters", 20),
        "repeated_lines": share("n_dup_lines", "n_lines", 2),
        "repeated_words": share("n_repeat_words", "n_words", 20),
        "ended_lines": share("n_ended", "n_lines"),
        "frequent_words": share("n_frequent", "n_words", 20),
    }


@dataclass(frozen=True)
class Trust:
    """Share of good documents, and how often each rule votes good, votes bad, abstains: ``votes[class, rule, vote]``, good class first."""

    good: float
    votes: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes (1, -1, or 0 for none)."""
        of = np.log(self.votes[0] / self.votes[1])
        odds = (votes > 0) @ of[:, 0] + (votes < 0) @ of[:, 1] + (votes == 0) @ of[:, 2]
        return 1 / (1 + np.exp(-np.clip(odds + np.log(self.good / (1 - self.good)), -700, 700)))

    def accuracy(self) -> np.ndarray:
        """Probability that a rule's vote is right, of each rule."""
        right = self.good * self.votes[0, :, 0] + (1 - self.good) * self.votes[1, :, 1]
        cast = self.good * self.votes[0, :, :2].sum(1) + (1 - self.good) * self.votes[1, :, :2].sum(1)
        return right / cast


def estimate(votes: np.ndarray, times: np.ndarray) -> Trust:
    """Expectation-maximisation over patterns of votes and how often each occurs.

    The starting values count as STRENGTH of the documents (one, of an empty table, so they are its result). That keeps the
    classes from being something else than good and bad: rules seldom vote bad on good documents. A rule
    cannot turn against its vote: a bad vote is never taken as a sign of good, nor a good one as a sign of bad.
    """
    weight = times.astype(float)
    prior = np.repeat(np.array(PRIOR_VOTES)[:, None, :], votes.shape[1], axis=1)
    strength = STRENGTH * weight.sum() or 1.0
    shown = np.stack([votes > 0, votes < 0, votes == 0], axis=2).astype(float)
    trust = Trust(PRIOR_GOOD, prior)
    for _ in range(MOST_STEPS):
        chance = trust.posterior(votes)
        of_class = np.stack([weight * chance, weight * (1 - chance)])
        total = of_class.sum(1) + strength
        rates = (np.einsum("cp,prv->crv", of_class, shown) + strength * prior) / total[:, None, None]
        rates[0, :, 1] = np.minimum(rates[0, :, 1], rates[1, :, 1])
        rates[1, :, 0] = np.minimum(rates[1, :, 0], rates[0, :, 0])
        rates /= rates.sum(2, keepdims=True)
        new = Trust(float((of_class[0].sum() + strength * PRIOR_GOOD) / (weight.sum() + strength)), rates)
        moved = max(abs(new.good - trust.good), np.abs(rates - trust.votes).max())
        trust = new
        if moved < CLOSE:
            return trust
    raise RuntimeError("accuracies did not settle")


def _pattern(rules: Sequence[Rule]) -> Column:
    """The votes of a row as one number, a digit to the base of 3 for each rule."""
    return reduce(lambda code, rule: code * 3 + rule.vote() + 1, rules, F.lit(0)).cast("int")


def votes_of(patterns: Sequence[int], n_rules: int) -> np.ndarray:
    """Rows of votes (1, -1, 0) from their numbers."""
    code = np.asarray(patterns, np.int64).reshape(-1, 1)
    return code // 3 ** np.arange(n_rules - 1, -1, -1) % 3 - 1


def judge(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """doc_id, COUNTS, vote_<rule> of each rule, quality (posterior of good), base_failed, kept.

    One row for each row of ``docs``. ``base_failed`` says that a text has fewer than 50 words, or that over half of
    its words stand in repeated 3-word windows; such a text is not kept, and any other if ``quality``
    is at least ``least``. Rules are learned over all rows, those that fail the base too.

    A null or empty text has no words: all counts are 0, no rule votes, ``base_failed`` holds.
    Rows with a null id, repeated rows and equal texts are judged each for itself and count each.
    Ties at ``least`` are kept. An empty table gives an empty result. Other columns are not looked at.
    """
    if not 0 < len(rules) <= MOST_RULES:
        raise ValueError(f"1 to {MOST_RULES} rules")
    counted = with_counts(docs, id_col, text_col).withColumns(measures()).withColumn("pattern", _pattern(rules))
    table = store(counted.select("doc_id", *COUNTS, "pattern"), "counts")
    # At most 3^len(rules) rows, however many documents there are.
    seen = table.groupBy("pattern").count().collect()
    votes = votes_of([r.pattern for r in seen], len(rules))
    trust = estimate(votes, np.array([r["count"] for r in seen], np.int64))
    names = [f"vote_{rule.name}" for rule in rules]
    judged = [
        (r.pattern, *map(int, row), float(p)) for r, row, p in zip(seen, votes, trust.posterior(votes))
    ]
    schema = ", ".join(["pattern int", *[f"{n} int" for n in names], "quality double"])
    known = docs.sparkSession.createDataFrame(judged, schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        table.join(F.broadcast(known), "pattern")
        .drop("pattern")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )

