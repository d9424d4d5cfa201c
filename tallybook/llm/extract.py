"""Main text of web pages by a linear-chain conditional random field.

A page is a chain of text blocks. Each block has features of the tags and class
names above it and of its text; the chain has weights for keeping and for changing
the label from one block to the next. Weights are fitted to labelled pages by
maximum likelihood; the best labelling of a page is found by Viterbi.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.llm.blocks import Block, blocks_of

MOST_LABELLED = 2000  # labelled pages fitted to, at most
ROUNDS = 120
PENALTY = 0.002  # of squared weights


def features(block: Block) -> list[str]:
    text = block.text
    words = text.count(" ") + 1
    share = block.linked / max(1, len(text))
    found = [
        *block.around,
        f"words{min(words, 100).bit_length()}",
        f"linked{round(3 * min(share, 1))}",
        f"end{text[-1] if text[-1] in '.!?:,;' else ''}",
    ]
    if any(c in text for c in "©®|»«›‹→•"):
        found.append("sign")
    if sum(c.isdigit() for c in text[:200]) * 4 > min(len(text), 200):
        found.append("digits")
    return found


@dataclass
class Chain:
    """Scores of label 1 (main text) against 0: of features, of the four steps (from, to), and of starting in 1."""

    weight: dict[str, float]
    step: list[list[float]]
    start: float

    def decode(self, rows: Sequence[Sequence[str]]) -> list[int]:
        """The best labels of a page's blocks; of equal ones, main text."""
        weight, ((t00, t01), (t10, t11)) = self.weight.get, self.step
        zero, one, back = 0.0, self.start, []
        for i, row in enumerate(rows):
            own = sum(weight(f, 0.0) for f in row)
            if i:
                from0, from1 = (0 if zero + t00 > one + t10 else 1), (0 if zero + t01 > one + t11 else 1)
                back.append((from0, from1))
                zero, one = (zero + t00 if from0 == 0 else one + t10), (zero + t01 if from1 == 0 else one + t11)
            one += own
        labels = [int(one >= zero)] if rows else []
        for pair in reversed(back):
            labels.append(pair[labels[-1]])
        return labels[::-1]


def fit(pages: Sequence[tuple[Sequence[Sequence[str]], Sequence[int]]], rounds: int = ROUNDS) -> Chain:
    """Weights of greatest likelihood for pages given as (features of each block, labels)."""
    pages = [p for p in pages if p[0]]
    names = {f: i for i, f in enumerate(sorted({f for rows, _ in pages for row in rows for f in row}))}
    longest = max((len(rows) for rows, _ in pages), default=1)
    gold, there = np.zeros((len(pages), longest), int), np.zeros((len(pages), longest), bool)
    cell, feature = [], []
    for p, (rows, labels) in enumerate(pages):
        gold[p, : len(rows)], there[p, : len(rows)] = labels, True
        for t, row in enumerate(rows):
            cell += [p * longest + t] * len(row)
            feature += [names[f] for f in row]
    cell, feature = np.array(cell, int), np.array(feature, int)
    both = there[:, 1:]
    size = len(names) + 5
    theta, speed, power = np.zeros(size), np.zeros(size), np.zeros(size)
    for turn in range(1, rounds + 1):
        own = np.zeros((len(pages), longest, 2))
        own[..., 1] = np.bincount(cell, theta[feature], gold.size).reshape(gold.shape)
        own[:, 0, 1] += theta[-1]
        step = theta[-5:-1].reshape(2, 2)
        ahead, behind = own.copy(), np.zeros_like(own)
        for t in range(1, longest):
            ahead[:, t] = np.where(there[:, t, None], own[:, t] + np.logaddexp.reduce(ahead[:, t - 1, :, None] + step, axis=1), ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            nexts = np.logaddexp.reduce(step + (own[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
            behind[:, t] = np.where(there[:, t + 1, None], nexts, 0)
        whole = np.logaddexp.reduce(ahead[:, -1], axis=1)
        main = np.where(there, np.exp(ahead[..., 1] + behind[..., 1] - whole[:, None]), 0)
        miss = np.where(there, gold, 0) - main
        slope = np.empty(size)
        slope[:-5] = np.bincount(feature, miss.ravel()[cell], len(names))
        pair = ahead[:, :-1, :, None] + step + (own + behind)[:, 1:, None, :] - whole[:, None, None, None]
        pair = np.where(both[..., None, None], np.exp(np.minimum(pair, 0)), 0).sum(axis=(0, 1))
        seen = np.array([[(both & (gold[:, :-1] == a) & (gold[:, 1:] == b)).sum() for b in (0, 1)] for a in (0, 1)])
        slope[-5:-1], slope[-1] = (seen - pair).ravel(), miss[:, 0].sum()
        slope = slope / max(1, len(pages)) - PENALTY * theta
        speed, power = 0.9 * speed + 0.1 * slope, 0.99 * power + 0.01 * slope**2
        theta += 0.15 * (speed / (1 - 0.9**turn)) / (np.sqrt(power / (1 - 0.99**turn)) + 1e-8)
    return Chain({f: float(theta[i]) for f, i in names.items()}, theta[-5:-1].reshape(2, 2).tolist(), float(theta[-1]))


def train(labelled: DataFrame, html_col: str = "html", main_col: str = "main", most: int = MOST_LABELLED) -> Chain:
    """A chain fitted to at most ``most`` labelled pages; ``main`` holds a boolean for each of a page's blocks.

    Pages whose labels do not fit their blocks are left out.
    """
    pages = []
    for row in labelled.select(html_col, main_col).limit(most).toLocalIterator():
        rows = [features(b) for b in blocks_of(row[0] or "")]
        if row[1] is not None and len(rows) == len(row[1]):
            pages.append((rows, [int(x) for x in row[1]]))
    return fit(pages)


def main_text(html: str | None, chain: Chain) -> str:
    """The page's main blocks, one a line."""
    blocks = blocks_of(html) if html else []
    labels = chain.decode([features(b) for b in blocks])
    return "\n".join(b.text for b, main in zip(blocks, labels) if main)


def extract(pages: DataFrame, chain: Chain, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row of ``pages``.

    Null or empty html, and pages without main text, have an empty text. Repeated
    rows repeat. Other columns are not looked at. Character references are decoded, white space
    in a block is one space, blocks are joined by a line feed; nothing is cut off.
    """
    sent = pages.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), sent.value) for x in batch.column(2)]
            # A reference to half a surrogate pair is no character.
            texts = [t if t.isascii() else t.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") for t in texts]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    plain = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return plain.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
