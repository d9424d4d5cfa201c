"""Bit predictors in hashed contexts, mixed by gated weights that adapt within a text.

A symbol is a path of binary decisions. Each decision is predicted in ``N`` contexts,
from how often it went either way there in training; contexts share tables of a fixed size by
hash. The predictions, as logits, are added up with weights. A gate, by the kind
of symbol and how many contexts have been seen, chooses the weights. Weights start alike for every text
and follow the text's own errors, block by block, and so does a last table that maps
the mixed probability to the one that proves right. A text's score depends on nothing
but the text and the trained counts.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

N = 4  # contexts of a decision
SLOT_BITS = 20  # of each context's table
GATES = 8  # two kinds of symbols, 0 to 3 contexts seen beyond the first
BINS = 24  # of the last table, over logits from -8 to 8
START = np.array([0.4, 0.3, 0.3, 0.25], np.float32)
RATE = 0.004
INERTIA = 24.0  # decisions the last table starts with in each bin
BLOCK = 64  # symbols after which weights follow
_MIX = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def codes(weights: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Huffman code and length of each symbol."""
    heap = [(w, i, (i,)) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    code, length = [0] * len(weights), [0] * len(weights)
    tie = len(weights)
    while len(heap) > 1:
        (wa, _, a), (wb, _, b) = heapq.heappop(heap), heapq.heappop(heap)
        for bit, side in ((0, a), (1, b)):
            for i in side:
                code[i] |= bit << length[i]
                length[i] += 1
        heapq.heappush(heap, (wa + wb, tie, a + b))
        tie += 1
    return np.array(code, np.int64), np.maximum(np.array(length, np.int64), 1)


def mixed_hash(*parts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(parts[0]), np.uint64)
    for part in parts:
        out = (out ^ part.astype(np.uint64)) * _MIX
        out ^= out >> np.uint64(29)
    return out


@dataclass
class Events:
    """Symbols in order: code, its length, contexts [N, symbols], kind 0 or 1, and the text each belongs to."""

    code: np.ndarray
    length: np.ndarray
    contexts: np.ndarray
    kind: np.ndarray
    text: np.ndarray

    def decisions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """symbol, node and way taken of each binary decision."""
        symbol = np.repeat(np.arange(len(self.code)), self.length)
        ends = np.cumsum(self.length)
        depth = np.arange(len(symbol)) - np.repeat(ends - self.length, self.length)
        left = self.length[symbol] - depth
        path = self.code[symbol] >> left
        way = (self.code[symbol] >> (left - 1)) & 1
        return symbol, path | (np.int64(1) << depth), way

    def slots(self, symbol: np.ndarray, node: np.ndarray) -> list[np.ndarray]:
        at = node.astype(np.uint64) * _STEP
        return [((c[symbol] + at) * _MIX >> np.uint64(64 - SLOT_BITS)).view(np.int64) for c in self.contexts]

    def followed_by(self, more: Events) -> Events:
        both = lambda a, b: np.concatenate([a, b], axis=-1)
        return Events(*(both(getattr(self, f), getattr(more, f)) for f in ("code", "length", "contexts", "kind", "text")))

    def taken(self, order: np.ndarray) -> Events:
        return Events(self.code[order], self.length[order], self.contexts[:, order], self.kind[order], self.text[order])


def count(events: Events, tables: np.ndarray) -> None:
    """Adds the events to ``tables`` [N, slots, 2]."""
    symbol, node, way = events.decisions()
    for table, slot in zip(tables, events.slots(symbol, node)):
        np.add.at(table.reshape(-1), 2 * slot + way, table.dtype.type(1))


def logits(tables: np.ndarray) -> np.ndarray:
    """Evidence of each slot, 0 where nothing was seen."""
    return np.log((tables[..., 1] + 0.4) / (tables[..., 0] + 0.4)).astype(np.float32)


class Texts:
    """State of ``n`` texts that are scored at once: weights, last table, and log10 probability so far."""

    def __init__(self, n: int):
        self.weights = np.repeat(START, n * GATES).reshape(N, -1)
        middle = (np.arange(BINS) - (BINS - 1) / 2) * (16 / (BINS - 1))
        self.hits = np.tile(INERTIA / (1 + np.exp(-middle)), n)
        self.seen = np.full(n * BINS, INERTIA)
        self.score = np.zeros(n)

    def add(self, events: Events, evidence: np.ndarray) -> None:
        """Scores events; a text's events come in order, and a call ends a block of every text."""
        n, symbols = len(self.score), len(events.code)
        if not symbols:
            return
        first = np.flatnonzero(np.r_[True, events.text[1:] != events.text[:-1]])
        sizes = np.diff(np.r_[first, symbols])
        block = (np.arange(symbols) - np.repeat(first, sizes)) // BLOCK
        order = np.argsort(block, kind="stable")
        events, block = events.taken(order), block[order]
        symbol, node, way = events.decisions()
        ends = np.cumsum(np.bincount(block, events.length)).astype(np.int64)
        inputs = [table[slot] for table, slot in zip(evidence, events.slots(symbol, node))]
        way, text = way.astype(np.float32), events.text[symbol]
        gate = (events.text * GATES + 4 * events.kind)[symbol] + sum((x != 0).view(np.int8) for x in inputs[1:])
        likely, begin = np.empty(len(symbol)), 0
        for end in ends.tolist():
            part = slice(begin, end)
            x, g, y = [i[part] for i in inputs], gate[part], way[part]
            logit = self.weights[0][g] * x[0]
            for i in range(1, N):
                logit += self.weights[i][g] * x[i]
            np.minimum(np.maximum(logit, -8, out=logit), 8, out=logit)
            p = 1 / (1 + np.exp(-logit))
            cell = text[part] * BINS + np.rint((logit + 8) * ((BINS - 1) / 16)).astype(np.int64)
            likely[part] = (p + self.hits[cell] / self.seen[cell]) / 2
            miss, low, high = (y - p) * RATE, int(g.min()), int(g.max()) + 1
            g = g - low
            for i in range(N):
                self.weights[i, low:high] += np.bincount(g, miss * x[i], high - low)
            low, high = int(cell.min()), int(cell.max()) + 1
            cell -= low
            self.hits[low:high] += np.bincount(cell, y, high - low)
            self.seen[low:high] += np.bincount(cell, minlength=high - low)
            begin = end
        likely = np.clip(likely, 1e-6, 1 - 1e-6)
        self.score += np.bincount(text, np.log10(np.where(way > 0, likely, 1 - likely)), n)
