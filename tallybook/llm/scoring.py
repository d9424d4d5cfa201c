"""Texts scored by a language model of online logistic context mixing.

The model gives every token sequence a probability. A token is a class and a word
in it: frequent words are classes of their own, the others share one by their
ending; the end of a text and words not seen in training are classes too, and an
unseen word is then spelled byte by byte. Classes and bytes are coded by paths of
binary decisions, which ``mixer`` predicts; the word within its class follows its training count.

Texts are cut into chunks with a vocabulary each. The vocabularies are counted by
word, the counts joined back to them, and every chunk is coded by its own; so no task and not the
driver holds the whole vocabulary. The predictors' tables have a fixed size.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store
from tallybook.llm import mixer
from tallybook.llm.common import words_of

CHUNK_WORDS = 200_000  # distinct words of a chunk
CHUNK_TOKENS = 4_000_000
OWN_CLASS = 1022  # most frequent words, each a class
ENDINGS = 512  # classes of the other words
KINDS = 4096  # more than there are classes
END, UNKNOWN, FIRST = 0, 1, 2  # classes: end of text, unseen word, first of the words
AGAIN = -1  # class UNKNOWN too, but the word came before in its text and is not spelled
SPELLED_BY = (1, 2, 3, 5)  # bytes before that predict the next one of an unseen word
SLAB = 60_000  # tokens looked at together; a longer text is taken in parts, which changes nothing in its score
MOST_COUNTED = 1 << 30  # decisions counted in a task's tables before they are handed on
PIECE = 1 << 14  # slots of a table that travel together
FOLDS, HELD_OUT = 7, 2


def held_out(id_col: str) -> Column:
    """Whether a text is kept out of training: CRC-32 of its id as text, modulo 7, is 2. A null id is the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


CHUNK = "chunk bigint, doc_ids array<bigint>, held array<boolean>, bytes array<bigint>, sizes array<int>, ids binary, words string, counts array<int>"


def chunks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each chunk of texts: their ids, numbers of tokens and word numbers, the words, and the words' counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, kept = TaskContext.get().partitionId() << 32, Chunk()
        for batch in batches:
            for key, held, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary())):
                kept.add(key, held, text.as_py())
                if len(kept.numbers) >= CHUNK_WORDS or kept.tokens >= CHUNK_TOKENS:
                    yield kept.row(number)
                    number, kept = number + 1, Chunk()
        if kept.sizes:
            yield kept.row(number)

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held"), text.alias("text"))
    return plain.mapInArrow(run, CHUNK)


def _packed(numbers: np.ndarray) -> bytes:
    """Non-negative numbers below 2^31: their first bytes, their second ones and so on, compressed."""
    return zlib.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel().astype(np.int64)


class Chunk:
    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.ids, self.sizes, self.doc_ids, self.held, self.bytes = [], [], [], [], []
        self.trained: list[np.ndarray] = []
        self.tokens = 0

    def add(self, key: int | None, held: bool, text: bytes) -> None:
        numbers = self.numbers
        words = words_of(text)
        ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int32)
        self.ids.append(ids)
        self.sizes.append(len(ids))
        self.doc_ids.append(key)
        self.held.append(held)
        self.bytes.append(len(text))
        if not held:
            self.trained.append(ids)
        self.tokens += len(ids)

    def row(self, number: int) -> pa.RecordBatch:
        n = len(self.numbers)
        trained = np.concatenate(self.trained) if self.trained else np.zeros(0, np.int32)
        ids = np.concatenate(self.ids)
        columns = [
            pa.array([number], pa.int64()),
            pa.array([self.doc_ids], pa.list_(pa.int64())),
            pa.array([self.held], pa.list_(pa.bool_())),
            pa.array([self.bytes], pa.list_(pa.int64())),
            pa.array([self.sizes], pa.list_(pa.int32())),
            pa.array([_packed(ids)], pa.binary()),
            pa.array([b"\n".join(self.numbers)], pa.binary()).cast(pa.string()),
            pa.array([np.bincount(trained, minlength=n).astype(np.int32)], pa.list_(pa.int32())),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["chunk", "doc_ids", "held", "bytes", "sizes", "ids", "words", "counts"])


NO_PAST = np.zeros(3, np.int64)


def _events(
    classes: np.ndarray, text: np.ndarray, spelled: list[bytes], code: np.ndarray, length: np.ndarray, past: np.ndarray = NO_PAST
) -> mixer.Events:
    """Events of tokens by class; a token of class UNKNOWN, not AGAIN, takes the next of ``spelled``.

    ``past`` has the three classes before, of the first token's text.
    """
    n, new = len(classes), np.flatnonzero(classes == UNKNOWN)
    classes = np.where(classes == AGAIN, UNKNOWN, classes)
    line = np.r_[np.where(past == AGAIN, UNKNOWN, past), classes]
    owner = np.r_[np.repeat(text[:1], 3), text]
    before, before2, before3 = (np.where(owner[3:] == owner[3 - k : n + 3 - k], line[3 - k : n + 3 - k], 0) for k in (1, 2, 3))
    one = np.ones(n, np.int64)
    contexts = np.stack([mixer.mixed_hash(one), mixer.mixed_hash(2 * one, before), mixer.mixed_hash(3 * one, before, before2), mixer.mixed_hash(4 * one, before2, before3)])
    kind = np.zeros(n, np.int64)
    if not spelled:
        return mixer.Events(code[classes], length[classes], contexts, kind, text)
    own = _spelling(spelled)
    places = np.repeat(new, own[2])
    order = np.argsort(np.r_[np.arange(n), places], kind="stable")

    def both(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.concatenate([a, b], axis=-1)[..., order]

    eight = np.full(len(own[0]), 8, np.int64)
    return mixer.Events(both(code[classes], own[0]), both(length[classes], eight), both(contexts, own[1]), both(kind, eight // 8), both(text, text[places]))


def _past(classes: np.ndarray, text: np.ndarray, at: int) -> np.ndarray:
    """The three classes before ``at`` in the same text, 0 where there is none."""
    past = NO_PAST.copy()
    for k in (1, 2, 3):
        if at >= k and text[at - k] == text[at]:
            past[3 - k] = classes[at - k]
    return past


def _spelling(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the words, each with a space behind it, their contexts, and the words' lengths."""
    raw = np.frombuffer(b" ".join(words) + b" ", np.uint8).astype(np.int64)
    past = [np.r_[np.full(i, 32), raw[:-i]][: len(raw)] for i in range(1, max(SPELLED_BY) + 1)]
    for nearer, farther in zip(past, past[1:]):  # what lies before the word counts as a space
        farther[nearer == 32] = 32
    salt = np.full(len(raw), 5, np.int64)
    contexts = [mixer.mixed_hash(salt + i, *past[:i]) for i in SPELLED_BY]
    return raw, np.stack(contexts), np.array([len(w) + 1 for w in words])


CODED = "doc_id bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, base double, within double, classes binary, once binary, spelled binary"


def code_texts(prepared: DataFrame, counts: DataFrame, totals: dict[int, int], tokens: int, words: int, texts: int) -> DataFrame:
    """Each text with its base score, the score of its words within their classes, and its classes.

    ``once`` has the places of words seen once in training, which stand for unseen ones there; it is empty for held-out texts.
    A chunk's own words stay behind: the join returns their counts, and the words themselves only where unseen.
    """
    listed = prepared.select("chunk", F.posexplode(F.arrays_zip(F.split("words", "\n", -1).alias("w"), F.col("counts").alias("n"))).alias("at", "x"))
    listed = listed.select("chunk", "at", F.col("x.w").alias("word"))
    joined = listed.join(counts, "word", "left")
    known = F.when(F.col("c").isNotNull(), F.struct((F.col("at").cast("bigint") * KINDS + F.col("class")).alias("at"), "c"))
    unseen = F.when(F.col("c").isNull(), F.struct("at", "word"))
    by_chunk = joined.groupBy(F.col("chunk").alias("of")).agg(F.collect_list(known).alias("known"), F.collect_list(unseen).alias("unseen"))
    whole = np.ones(FIRST + OWN_CLASS + ENDINGS)
    for kind, total in totals.items():
        whole[kind] = max(total, 1)
    floor = np.log10(tokens + words + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        found = right.column("known").combine_chunks().flatten()
        names = {x["at"]: x["word"].encode() for x in right.column("unseen")[0].as_py()}
        size = len(found) + len(names)
        c, kind = np.zeros(size, np.int64), np.full(size, UNKNOWN, np.int16)
        at, of = np.divmod(found.field("at").to_numpy(), KINDS)
        c[at], kind[at] = found.field("c").to_numpy(), of
        base = np.log10(c + 1) - floor
        within = np.where(c > 0, np.log10(np.maximum(c, 1) / whole[kind]), 0)
        ids = _unpacked(row["ids"])
        out, begin = [], 0
        for key, held, n_bytes, size in zip(row["doc_ids"], row["held"], row["bytes"], row["sizes"]):
            own = ids[begin : begin + size]
            begin += size
            classes = kind[own]
            once = np.flatnonzero(c[own] == 1).astype(np.int32)
            unknown = np.flatnonzero(classes == UNKNOWN)
            again, gained = _repeats(own[unknown].tolist())
            classes[unknown[again]] = AGAIN
            out.append({
                "doc_id": key, "held_out": held, "n_bytes": n_bytes, "n_tokens": size + 1,
                "n_known": int((c[own] > 0).sum()) + (texts > 0), "base": float(base[own].sum() + np.log10(texts + 1) - floor),
                "within": float(within[own].sum() + gained), "classes": classes.tobytes(), "once": b"" if held else once.tobytes(),
                "spelled": b" ".join(names[i] for i in own[classes == UNKNOWN].tolist()),
            })
        return pa.Table.from_pylist(out, schema=_schema())

    return prepared.drop("words", "counts").groupBy("chunk").cogroup(by_chunk.groupBy("of")).applyInArrow(run, CODED)


def _repeats(words: list[int]) -> tuple[list[int], float]:
    """Of a text's unseen words, the places of those that came before, and log10 probability of what is new or which word returns.

    Whether a word returns follows how often one did so far, and which one, how often it came.
    """
    seen: dict[int, int] = {}
    again, logp = [], 0.0
    for i, word in enumerate(words):
        before = seen.get(word, 0)
        returned = len(again) + 0.5
        if before:
            logp += math.log10(returned / (i + 1) * before / i)
            again.append(i)
        else:
            logp += math.log10(1 - returned / (i + 1)) if i else 0.0
        seen[word] = before + 1
    return again, logp


def _schema() -> pa.Schema:
    kinds = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in CODED.split(", "))])


def _pieces(tables: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = tables.reshape(-1, PIECE * 2)
    for i in range(0, len(flat), 64):
        used = [j for j in range(i, min(i + 64, len(flat))) if flat[j].any()]
        bits = [zlib.compress(flat[j].tobytes(), 1) for j in used]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(bits, pa.binary())], names=["piece", "counts"])


def train(coded: DataFrame, counts: DataFrame, code: np.ndarray, length: np.ndarray, tasks: int) -> np.ndarray:
    """Evidence [N, slots] of all training texts.

    The texts are counted in ``tasks`` tasks, each into tables of the fixed
    size; pieces of tables are added up by place.
    """

    def of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, counted = np.zeros((mixer.N, 1 << mixer.SLOT_BITS, 2), np.int32), 0
        for batch in batches:
            waiting, size = [], 0
            for i in range(batch.num_rows + 1):
                last = i == batch.num_rows
                if not last:
                    learned = np.append(np.frombuffer(batch.column("classes")[i].as_py(), np.int16), END).astype(np.int64)
                    learned[np.frombuffer(batch.column("once")[i].as_py(), np.int32)] = UNKNOWN
                    waiting.append(learned)
                    size += len(learned)
                if waiting and (last or size >= SLAB):
                    lengths = [len(w) for w in waiting]
                    flat, text = np.concatenate(waiting), np.repeat(np.arange(len(waiting)), lengths)
                    for k in range(0, len(flat), SLAB):
                        part = slice(k, k + SLAB)
                        counted += int(length[flat[part]].sum())
                        if counted > MOST_COUNTED:  # before a slot could overflow
                            yield from _pieces(tables)
                            tables[:], counted = 0, 0
                        mixer.count(_events(flat[part], text[part], [], code, length, _past(flat, text, k)), tables)
                    waiting, size = [], 0
        yield from _pieces(tables)

    def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((mixer.N, 1 << mixer.SLOT_BITS, 2), np.int32)
        for batch in batches:
            words = batch.column(0).cast(pa.binary()).to_pylist()
            for i in range(0, len(words), 4096):
                raw, contexts, sizes = _spelling(words[i : i + 4096])
                same = np.zeros(len(raw), np.int64)
                mixer.count(mixer.Events(raw, same + 8, contexts, same + 1, same), tables)
        yield from _pieces(tables)

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(PIECE * 2, np.int64)
        for bits in table.column("counts"):
            total += np.frombuffer(zlib.decompress(bits.as_py()), np.int32)
        evidence = mixer.logits(total.reshape(-1, 2)).astype(np.float16)
        return pa.table({"piece": table.column("piece").slice(0, 1), "evidence": pa.array([evidence.tobytes()], pa.binary())})

    texts = coded.filter("NOT held_out").select("classes", "once").coalesce(tasks).mapInArrow(of_texts, "piece int, counts binary")
    words = counts.filter("c = 1").select("word").coalesce(tasks).mapInArrow(of_words, "piece int, counts binary")
    pieces = texts.union(words).groupBy("piece").applyInArrow(add, "piece int, evidence binary")
    evidence = np.zeros((mixer.N << mixer.SLOT_BITS) // PIECE * PIECE, np.float32).reshape(-1, PIECE)
    for row in pieces.toLocalIterator():  # the tables' fixed size, 2 bytes a slot
        evidence[row.piece] = np.frombuffer(row.evidence, np.float16)
    return evidence.reshape(mixer.N, -1)


def score_texts(coded: DataFrame, evidence: np.ndarray, code: np.ndarray, length: np.ndarray) -> DataFrame:
    """doc_id and score of each coded text."""
    sent = coded.sparkSession.sparkContext.broadcast(evidence.astype(np.float16))
    names = ["doc_id", "held_out", "n_bytes", "n_tokens", "n_known", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = sent.value.astype(np.float32)
        for batch in batches:
            n = batch.num_rows
            scores = batch.column("within").to_numpy().copy()
            sizes = batch.column("n_tokens").to_numpy()
            order, i = np.argsort(sizes, kind="stable"), 0  # texts of like length together
            while i < n:
                j, filled = i, 0
                while j < n and (j == i or filled + sizes[order[j]] <= SLAB):
                    filled += sizes[order[j]]
                    j += 1
                rows = order[i:j]
                state = mixer.Texts(len(rows))
                classes = [np.append(np.frombuffer(batch.column("classes")[r].as_py(), np.int16), END).astype(np.int64) for r in rows.tolist()]
                words = [w for r in rows.tolist() for w in batch.column("spelled")[r].as_py().split()]
                flat, text = np.concatenate(classes), np.repeat(np.arange(len(rows)), [len(c) for c in classes])
                waiting = None
                for k in range(0, len(flat), SLAB):  # more than one only for a text that is alone
                    part = flat[k : k + SLAB]
                    unknown = int((part == UNKNOWN).sum())
                    events = _events(part, text[k : k + SLAB], words[:unknown], code, length, _past(flat, text, k))
                    events = events if waiting is None else waiting.followed_by(events)
                    if k + SLAB < len(flat):  # whole blocks only; the rest goes with the next part
                        whole = len(events.code) // mixer.BLOCK * mixer.BLOCK
                        waiting, events = events.taken(np.arange(whole, len(events.code))), events.taken(np.arange(whole))
                    state.add(events, tables)
                    words = words[unknown:]
                scores[rows] += state.score
                i = j
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(scores)], names=[*names, "score"])

    kinds = "doc_id bigint, held_out boolean, n_bytes bigint, n_tokens bigint, n_known bigint, base double, score double"
    return coded.mapInArrow(run, kinds)


def language_model_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte of each row of ``docs``.

    The model learns from the rows that are not held out and scores all. A null or empty
    text is the end token alone and has no bits per byte. Repeated rows repeat, and count
    as often in training. If all rows are held out nothing is known. An empty table gives an empty result. Other
    columns are not looked at.
    """
    spark = docs.sparkSession
    prepared = store(chunks(docs, id_col, text_col), "chunks")
    pairs = F.explode(F.arrays_zip(F.split("words", "\n", -1).alias("word"), F.col("counts").alias("n")))
    seen = prepared.select(pairs.alias("x")).select("x.*").filter("n > 0")
    sums = store(seen.groupBy("word").agg(F.sum("n").alias("c")), "words")
    texts = prepared.select(F.size(F.filter("held", lambda h: ~h)).alias("n")).agg(F.sum("n")).first()[0] or 0
    n, v, once = sums.agg(F.sum("c"), F.count(F.lit(1)), F.count_if(F.col("c") == 1)).first()
    tokens, words = (n or 0) + texts, v + (texts > 0)
    top = sums.orderBy(F.desc("c"), "word").limit(OWN_CLASS).collect()
    own = spark.createDataFrame([(r.word, FIRST + i) for i, r in enumerate(top)], "word string, own int")
    ending = FIRST + OWN_CLASS + F.pmod(F.xxhash64(F.substring("word", -2, 2)), F.lit(ENDINGS))
    counts = sums.join(F.broadcast(own), "word", "left").select("word", "c", F.coalesce("own", ending).cast("smallint").alias("class"))
    counts = store(counts, "counts")
    totals = {r["class"]: r.n for r in counts.groupBy("class").agg(F.sum("c").alias("n")).collect()}
    weights = [texts + 1, once + 1] + [totals.get(k, 0) + 1 for k in range(FIRST, FIRST + OWN_CLASS + ENDINGS)]
    code, length = mixer.codes(weights)
    coded = store(code_texts(prepared, counts, totals, tokens, words, texts), "coded")
    evidence = train(coded, counts, code, length, max(1, spark.sparkContext.defaultParallelism))
    scored = score_texts(coded, evidence, code, length)
    bits = F.when(F.col("n_bytes") > 0, -F.col("score") * float(np.log2(10)) / F.col("n_bytes"))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), "score", bits.alias("bits_per_byte"),
    )
