"""Benchmark passages in documents, by a prefix-filtered join of item-sized windows.

A window is ``size`` consecutive words of an item (or the whole of a shorter
item). A document holds a window only if it holds every shingle of it, so
one shingle is prefix enough: the rarest in the corpus, by counts over all
documents. Documents are probed with the windows' prefix shingles alone; a
hit says where the window would have to start, it must fit there between the
document's first and last word, and is then compared word by word.

The windows are sent to the documents, so no text is shuffled. They are counted
first and dealt to slices of a bounded size. A slice is built, sent, used and taken back before the
next one is looked at, so neither the driver nor a task ever holds more than one; what each finds is a
table of hits, and the tables are put together at the end.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store
from tallybook.llm.common import decide, free_name

SHINGLE = 3
SLICE_WINDOWS = 100_000  # (window, item) rows sent to each task at once, about 100 bytes each

# Bytes below 128 that are no part of a word once A-Z is lower case.
_NO_WORD = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_SPACED = bytes(32 if b in _NO_WORD else b for b in range(256))


def bench_words(text: bytes | None) -> list[bytes]:
    """Runs of a-z, 0-9 and anything beyond ASCII, A-Z in lower case; none for null."""
    return text.lower().translate(_SPACED).split() if text else []


def windows_of(items: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """item (string), win (words joined by a space): distinct windows of each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = bench_words(text)
                found = {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else ()
                wins = pa.array(list(found), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(wins), pa.string()), wins], names=["item", "win"])

    plain = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, "item string, win string").distinct()


class Probe:
    """Windows ready to be found in documents. Words are numbers from 1; 0 is any other word."""

    def __init__(self, rows: Sequence[tuple[str | None, str]]):
        self.word: dict[bytes, int] = {}
        of: dict[str, list[str]] = defaultdict(list)
        for item, win in rows:
            of[win].append(item)
        self.windows = []
        for win, found in of.items():
            words = [self.word.setdefault(w, len(self.word) + 1) for w in win.encode().split(b" ")]
            self.windows.append((np.array(words), [i for i in found if i is not None]))
        self.base = len(self.word) + 1
        self.at: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.codes: dict[int, np.ndarray] = {}

    def _shingles(self, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of each shingle whose words all occur in the windows."""
        known = ids > 0
        full = np.ones(max(0, len(ids) - size + 1), bool)
        for i in range(size):
            full &= known[i : i + len(full)]
        starts = np.flatnonzero(full)
        code = np.zeros(len(starts), np.int64)
        for i in range(size):
            code = code * self.base + ids[starts + i]
        return starts, code

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.word.get, words, repeat(0)), np.int64, len(words))

    def all_shingles(self) -> None:
        """Takes every shingle of the windows as one to look for, for counting."""
        found: dict[int, set[int]] = defaultdict(set)
        for words, _ in self.windows:
            size = min(SHINGLE, len(words))
            found[size].update(self._shingles(words, size)[1].tolist())
        self.codes = {size: np.array(sorted(codes)) for size, codes in found.items()}

    def take_rarest(self, seen: dict[tuple[int, int], int]) -> None:
        """Keeps for each window its rarest shingle, by its count in the documents."""
        for number, (words, _) in enumerate(self.windows):
            size = min(SHINGLE, len(words))
            starts, codes = self._shingles(words, size)
            _, code, start = min((seen.get((size, c), 0), c, s) for s, c in zip(starts.tolist(), codes.tolist()))
            self.at.setdefault(size, {}).setdefault(code, []).append((start, number))
        self.codes = {size: np.array(sorted(codes)) for size, codes in self.at.items()}

    def hits(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """size, starts and codes of the shingles looked for."""
        for size, wanted in self.codes.items():
            starts, codes = self._shingles(ids, size)
            place = np.minimum(np.searchsorted(wanted, codes), len(wanted) - 1)
            same = wanted[place] == codes
            yield size, starts[same], codes[same]

    def find(self, words: list[bytes]) -> tuple[set[tuple[int, int]], set[str]]:
        """(start, end) of all window occurrences, and the items they come from."""
        ids = self.ids(words)
        spans, items = set(), set()
        for size, starts, codes in self.hits(ids):
            for place, code in zip(starts.tolist(), codes.tolist()):
                for offset, number in self.at[size][code]:
                    window, found = self.windows[number]
                    begin = place - offset
                    if begin >= 0 and begin + len(window) <= len(ids) and np.array_equal(ids[begin : begin + len(window)], window):
                        spans.add((begin, begin + len(window)))
                        items.update(found)
        return spans, items


def _counted(texts: DataFrame, probe: Probe) -> dict[tuple[int, int], int]:
    """How often the documents hold each shingle of the windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], int] = defaultdict(int)
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                for size, _, codes in probe.hits(probe.ids(bench_words(text.as_py()))):
                    for code, n in zip(*[x.tolist() for x in np.unique(codes, return_counts=True)]):
                        total[size, code] += n
        yield pa.RecordBatch.from_pydict(
            {"size": [k[0] for k in total], "code": [k[1] for k in total], "n": list(total.values())},
            schema=pa.schema([("size", pa.int32()), ("code", pa.int64()), ("n", pa.int64())]),
        )

    counts = texts.mapInArrow(run, "size int, code bigint, n bigint").groupBy("size", "code").agg(F.sum("n").alias("n"))
    return {(r.size, r.code): r.n for r in counts.toLocalIterator()}


def probes(docs: DataFrame, text_col: str, items: DataFrame, item_col: str, item_text: str, size: int) -> Iterator[tuple[Probe, bool]]:
    """A probe for each slice of the items' windows, one at a time, and whether it is the only one; an empty one without windows."""
    windows = store(windows_of(items, item_col, item_text, size), "windows")
    slices = max(1, -(-windows.count() // SLICE_WINDOWS))
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    for i in range(slices):
        part = windows.filter(F.pmod(F.xxhash64("item", "win"), F.lit(slices)) == i)
        probe = Probe([(r.item, r.win) for r in part.toLocalIterator()])  # SLICE_WINDOWS rows, more or less
        if probe.windows:
            probe.all_shingles()
            probe.take_rarest(_counted(texts, probe))
        yield probe, slices == 1


SPANS = "array<struct<begin bigint, end bigint>>"
FOUND = f"doc_id bigint, hash bigint, n_words bigint, items array<string>, spans {SPANS}"


def _find(rows: DataFrame, sent: Broadcast, hits_only: bool) -> DataFrame:
    """FOUND of each row (doc_id, hash, text), or of those with a hit."""
    out = pa.schema([
        ("doc_id", pa.int64()), ("hash", pa.int64()), ("n_words", pa.int64()), ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list] = {f.name: [] for f in out}
            for key, mark, text in zip(*[batch.column(i).to_pylist() for i in (0, 1)], batch.column(2).cast(pa.binary())):
                words = bench_words(text.as_py())
                spans, items = sent.value.find(words)
                if spans or not hits_only:
                    values = (key, mark, len(words), sorted(items), [{"begin": b, "end": e} for b, e in merged(spans)])
                    for name, value in zip(found, values):
                        found[name].append(value)
            yield pa.RecordBatch.from_pydict(found, schema=out)

    return rows.select("doc_id", "hash", "text").mapInArrow(run, FOUND)


def _together(rows: DataFrame) -> DataFrame:
    """doc_id, n_words, items, spans from FOUND and the further ``more_items`` and ``more_spans`` (null: none) of other slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, spans, more_items, more_spans = (batch.column(c).to_pylist() for c in ("items", "spans", "more_items", "more_spans"))
            all_items = [sorted({*a, *(x for part in b or () for x in part)}) for a, b in zip(items, more_items)]
            all_spans = [merged({(x["begin"], x["end"]) for part in [a, *(b or ())] for x in part}) for a, b in zip(spans, more_spans)]
            as_pairs = pa.array([[{"begin": b, "end": e} for b, e in x] for x in all_spans], batch.column("spans").type)
            columns = [batch.column("doc_id"), batch.column("n_words"), pa.array(all_items, pa.list_(pa.string())), as_pairs]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "items", "spans"])

    return rows.mapInArrow(run, f"doc_id bigint, n_words bigint, items array<string>, spans {SPANS}")


def contamination(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text", size: int = 10,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, spans, items.

    ``spans`` are the (begin, end) word ranges that hit windows cover, merged where
    they touch or overlap; ``items`` the distinct ids, as sorted strings, of the items with occurring windows. A
    null or empty text, on either side, has no words and no windows. Items of equal
    words are all named. A null item id marks words but is not named. Repeated
    rows give repeated results. No items: nothing is hit. Other columns are not looked at.
    """
    send = docs.sparkSession.sparkContext.broadcast
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.col(text_col).cast("string").alias("text"))
    every, hits = None, []
    for probe, alone in probes(docs, text_col, items, item_col, item_text, size):
        sent = send(probe)
        if alone:
            return _find(rows, sent, False).drop("hash")
        if every is None:
            every = store(_find(rows, sent, False), "found")
        else:
            hits.append(store(_find(rows, sent, True), "hits"))
        sent.destroy()
    # Repeated rows have found the same, which a set holds once.
    more = reduce(DataFrame.unionByName, hits).groupBy("doc_id", "hash")
    more = more.agg(F.collect_set("items").alias("more_items"), F.collect_set("spans").alias("more_spans"))
    return _together(decide(every, more, ["doc_id", "hash"], "left"))


def merged(spans: set[tuple[int, int]]) -> list[list[int]]:
    """Ranges in order, joined where they touch or overlap."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return out


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def remove_contaminated(
    docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", size: int = 10
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no window of an item.

    A null or empty text is clean. Rows are judged by their text, so repeated rows share their lot. Without items all
    rows stay. All columns are kept, whatever their names.
    """
    send = docs.sparkSession.sparkContext.broadcast
    at, hits = docs.columns.index(text_col), []
    rows = docs.select(F.lit(None).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).cast("string").alias("text"))

    def clean(sent: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(at).cast(pa.binary())
                yield batch.filter(pa.array([not sent.value.find(bench_words(t.as_py()))[0] for t in texts], pa.bool_()))

        return docs.mapInArrow(run, docs.schema)

    for probe, alone in probes(docs, text_col, items, item_col, item_text, size):
        sent = send(probe)
        if alone:
            return clean(sent)
        hits.append(store(_find(rows, sent, True).select("hash"), "hits"))
        sent.destroy()
    key = free_name(docs, "text_hash")
    out = reduce(DataFrame.unionByName, hits).select(F.col("hash").alias(key)).distinct()
    return decide(docs.withColumn(key, F.xxhash64(text_col)), out, [key], "left_anti").drop(key)
