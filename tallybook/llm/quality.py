"""Quality of documents by an interpolated modified Kneser-Ney model of trusted text.

The model's tokens are bytes and its n-grams five bytes long, so an n-gram is a whole
number, nothing is out of vocabulary, and the number of distinct n-grams stays far
behind the length of the corpus. Documents are written in chunks of a bounded size. One pass gives the distinct n-grams of
each chunk with their counts in trusted text. From these, joins between count
tables, sharded by n-gram, give the probability of each n-gram that occurs
anywhere; the same kind of join takes them back to the chunks, where they are added up for each
document. The texts lie bucketed by chunk and are not shuffled, and no table of n-grams is ever sent whole.
The limits are quantiles of the perplexity of trusted documents that were held out, for each language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.joins import join_null_safe
from tallybook.functions.storage import scratch_path, store
from tallybook.llm.common import decide, free_name

ORDER = 5
QUANTILE = 0.99  # of held-out trusted documents of a language, at most this share lies below its limit
FOLDS = 3  # fold 0 of the trusted documents is held out of the model
SLAB = 1 << 21  # bytes looked at together
CHUNK_BYTES = 16 << 20  # texts that share a list of n-grams; a longer text is a chunk of its own
ROW_BYTES = 64  # that a row counts for besides its text


def grams(text: bytes, order: int = ORDER) -> Iterator[np.ndarray]:
    """The n-grams of a text that zero bytes precede and one follows, a slab at a time."""
    padded = np.frombuffer(bytes(order - 1) + text + b"\0", np.uint8)
    for i in range(0, len(text) + 1, SLAB):
        piece = padded[i : i + SLAB + order - 1].astype(np.int64)
        keys = np.zeros(len(piece) - order + 1, np.int64)
        for j in range(order):
            keys = (keys << 8) | piece[j : j + len(keys)]
        yield keys


def _merge(kept: tuple[np.ndarray, np.ndarray], slabs: list[np.ndarray], weight: int) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = np.unique(np.concatenate(slabs), return_counts=True)
    every, place = np.unique(np.concatenate([kept[0], keys]), return_inverse=True)
    return every, np.bincount(place, np.concatenate([kept[1], counts * weight])).astype(np.int64)


def in_chunks(rows: DataFrame, text: str = "text") -> DataFrame:
    """The rows with a ``chunk`` number, as a table bucketed by it: each task's rows in their order, up to CHUNK_BYTES a chunk."""
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, number, size = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            chunk = np.empty(batch.num_rows, np.int64)
            for i, n_bytes in enumerate(pc.binary_length(batch.column(names.index(text)).cast(pa.binary())).to_pylist()):
                n_bytes = (n_bytes or 0) + ROW_BYTES
                if size and size + n_bytes > CHUNK_BYTES:
                    number, size = number + 1, 0
                chunk[i], size = first + number, size + n_bytes
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chunk)], names=[*names, "chunk"])

    session, where = rows.sparkSession, scratch_path(rows.sparkSession, "chunks")
    chunked = rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("chunk", T.LongType())]))
    # Each task writes its own chunks. Read by bucket, all rows of a chunk are in one task, with nothing shuffled. A bucket
    # may hold many chunks: they are worked on one after the other.
    buckets, table = int(session.conf.get("spark.sql.shuffle.partitions")), "chunks_" + where[-32:]
    chunked.write.bucketBy(buckets, "chunk").option("path", where).option("compression", "zstd").saveAsTable(table)
    return session.table(table)


def chunk_grams(texts: DataFrame) -> DataFrame:
    """chunk, key, n: distinct n-grams of ``text`` in each ``chunk``, with their count in rows that are ``trusted``.

    Rows of a chunk that are not neighbours may give a key several times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        kept, waiting, sizes, at = (none, none), {0: [], 1: []}, [0, 0], None

        def rows() -> pa.RecordBatch:
            nonlocal kept
            for trusted, slabs in waiting.items():
                if slabs:
                    kept = _merge(kept, slabs, trusted)
                waiting[trusted], sizes[trusted] = [], 0
            found, kept = kept, (none, none)
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(found[0]), at or 0), *found)], names=["chunk", "key", "n"])

        for batch in batches:
            plain = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist())
            for chunk, text, trusted in plain:
                if chunk != at:
                    yield rows()
                    at = chunk
                for keys in grams(text.as_py()):
                    waiting[trusted].append(keys)
                    sizes[trusted] += len(keys)
                    if sizes[trusted] >= SLAB:
                        kept = _merge(kept, waiting[trusted], trusted)
                        waiting[trusted], sizes[trusted] = [], 0
        yield rows()

    return texts.select("chunk", "text", "trusted").mapInArrow(run, "chunk bigint, key bigint, n bigint")


def count_grams(texts: DataFrame) -> DataFrame:
    """key, n: distinct n-grams of ``text``, with their count in rows that are ``trusted``."""
    return chunk_grams(texts.withColumn("chunk", F.lit(0).cast("bigint"))).groupBy("key").agg(F.sum("n").alias("n"))


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, from how many n-grams occur once to four times."""
    row = counts.agg(*[F.count_if(F.col("c") == i) for i in (1, 2, 3, 4)]).first()
    if not all(row):
        return [0.5, 1.0, 1.5]  # too few n-grams to estimate from
    y = row[0] / (row[0] + 2 * row[1])
    return [min(max(i - (i + 1) * y * row[i] / row[i - 1], 0.05), i - 0.05) for i in (1, 2, 3)]


def _tail(key: str, order: int) -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << 8 * order) - 1).cast("bigint"))


def log_probabilities(counted: DataFrame, order: int = ORDER) -> DataFrame:
    """key, logp: log10 probability of each n-gram's last byte after the others.

    ``counted`` has the n-grams asked for with their trusted counts (key, n). The highest order uses
    counts, lower ones the number of distinct bytes that precede; each order takes off its
    discounts and gives them to the next lower, the lowest to all 256 bytes alike.
    """
    tables = {order: counted.filter("n > 0").select("key", F.col("n").alias("c"))}
    for n in range(order - 1, 0, -1):
        tables[n] = store(tables[n + 1].groupBy(_tail("key", n).alias("key")).agg(F.count(F.lit(1)).alias("c")), f"grams{n}")
    known = None
    for n in range(1, order + 1):
        small, middle, large = _discounts(tables[n])
        taken = F.when(F.col("c") == 1, small).when(F.col("c") == 2, middle).otherwise(large)
        context = F.shiftright("key", 8).alias("context")
        heads = tables[n].groupBy(context).agg(F.sum("c").alias("total"), F.sum(taken).alias("given"))
        asked = counted.select(_tail("key", n).alias("key")).distinct()
        rows = asked.join(tables[n], "key", "left").withColumn("context", F.shiftright("key", 8)).join(heads, "context", "left")
        if known is None:
            rows = rows.withColumn("lower", F.lit(1 / 256))
        else:
            rows = rows.withColumn("tail", _tail("key", n - 1)).join(known, "tail")
        own = F.when(F.col("c").isNotNull(), F.col("c") - taken).otherwise(0.0)
        p = F.when(F.col("total").isNull(), F.col("lower")).otherwise((own + F.col("given") * F.col("lower")) / F.col("total"))
        known = store(rows.select(F.col("key").alias("tail"), p.alias("lower")), f"lower{n}")
    return known.select(F.col("tail").alias("key"), F.log10("lower").alias("logp"))


def add_up(chunks: DataFrame, asked: DataFrame, probabilities: DataFrame) -> DataFrame:
    """``chunks`` with ``logp``, the sum over the n-grams, in place of ``text`` and ``chunk``.

    ``asked`` (chunk, key) is joined with the probabilities by key and goes back to its chunk.
    """
    known = asked.select("chunk", "key").join(probabilities, "key").select("chunk", "key", F.col("logp").cast("float").alias("logp"))
    names = [c for c in chunks.columns if c not in ("text", "chunk")]
    schema = T.StructType([*[chunks.schema[c] for c in names], T.StructField("logp", T.DoubleType())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys, first = np.unique(right.column("key").to_numpy(), return_index=True)
        logp = right.column("logp").to_numpy()[first]
        sums = np.zeros(len(left))
        for i, text in enumerate(left.column("text").combine_chunks().cast(pa.binary())):
            for found in grams(text.as_py()):
                sums[i] += logp[np.searchsorted(keys, found)].sum(dtype=np.float64)
        return pa.table([*[left.column(c) for c in names], pa.array(sums)], names=[*names, "logp"])

    return chunks.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(run, schema)


@dataclass
class Columns:
    id: str = "doc_id"
    text: str = "text"
    lang: str = "lang"


def row_hash(names: Columns) -> Column:
    """Tells rows of one id apart by text and language."""
    return F.xxhash64(F.col(names.text), F.col(names.lang))


def judge(docs: DataFrame, labels: DataFrame, names: Columns = Columns(), quantile: float = QUANTILE) -> DataFrame:
    """doc_id, lang, row_hash, n_bytes, perplexity, limit, keep of each row of ``docs``.

    Trusted are documents whose labels (doc_id, quality, toxic) all say quality 1 and toxic 0; a
    null says neither. A document is kept if its perplexity is at most its language's
    limit: the quantile over held-out trusted documents, or over all trusted ones if none
    is held out. A language without trusted documents, null included, has the limit of all languages
    together; without any trusted document everything is kept that has a text. An order of which trusted text has no n-gram
    occurring once, twice, three or four times takes off 0.5, 1 and 1.5, as its discounts cannot be estimated. Null and empty texts
    are rejected. A perplexity equal to the limit is kept. Repeated rows share their lot and count as often as they come. Other
    columns are not looked at.
    """
    text = F.coalesce(F.col(names.text).cast("string"), F.lit(""))
    rows = docs.select(F.col(names.id).alias("doc_id"), F.col(names.lang).alias("lang"), row_hash(names).alias("row_hash"), text.alias("text"))
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    trusted = labels.groupBy("doc_id").agg(F.min(F.coalesce(good, F.lit(False))).alias("good")).filter("good AND doc_id IS NOT NULL")
    trusted = trusted.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int").alias("fold"))
    marked = decide(rows, trusted, ["doc_id"], "left").withColumn("n_bytes", F.octet_length("text").cast("bigint"))
    chunks = in_chunks(marked.select("doc_id", "lang", "row_hash", "fold", "n_bytes", "text"))
    learned = F.coalesce(F.col("fold") > 0, F.lit(False)).cast("int").alias("trusted")
    asked = store(chunk_grams(chunks.select("chunk", "text", learned)), "asked")
    counted = store(asked.groupBy("key").agg(F.sum("n").alias("n")), "counted")
    summed = store(add_up(chunks, asked, log_probabilities(counted)), "scored")
    scored = summed.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), -F.col("logp") / (F.col("n_bytes") + 1))))

    sure = scored.filter("fold IS NOT NULL AND perplexity IS NOT NULL")

    def limit(held: Column) -> Column:
        return F.percentile_approx(F.when(held, F.col("perplexity")), quantile, 10_000)

    both = F.coalesce(limit(F.col("fold") == 0), limit(F.lit(True))).alias("limit")
    limits = sure.groupBy("lang").agg(both)
    overall = sure.agg(both).first()[0]
    placed = join_null_safe(scored, F.broadcast(limits) if limits.count() <= 10_000 else limits, ["lang"], "left")
    bound = F.coalesce("limit", F.lit(float("inf") if overall is None else overall))
    keep = F.coalesce(F.col("perplexity") <= bound, F.lit(False))
    return placed.select("doc_id", "lang", "row_hash", "n_bytes", "perplexity", bound.alias("limit"), keep.alias("keep"))


def keep_good(docs: DataFrame, labels: DataFrame, names: Columns = Columns(), quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` keeps."""
    key = free_name(docs, "row_hash")
    out = judge(docs, labels, names, quantile).filter("NOT keep").select(F.col("doc_id").alias(names.id), F.col("row_hash").alias(key))
    return decide(docs.withColumn(key, row_hash(names)), out.distinct(), [names.id, key], "left_anti").drop(key)
