"""C1-C6 on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import completeness as c
from tallybook.queries.registry import DOCS, query
from tallybook.sources.tables import documents_manifest


@query(
    "C1",
    """
SELECT g.doc_id
FROM (SELECT unnest(generate_series((SELECT min(doc_id) FROM documents), (SELECT max(doc_id) FROM documents))) AS doc_id) g
ANTI JOIN labels l ON l.doc_id = g.doc_id""",
)
def missing_labels(t):
    bounds = t.documents.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return c.missing_ordinals(t.labels, [], "doc_id", bounds=bounds)


@query(
    "C1",
    """
WITH bounds AS (
  SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem GROUP BY l_orderkey),
wanted AS (SELECT l_orderkey, unnest(generate_series(lo, hi)) AS l_linenumber FROM bounds)
SELECT w.l_orderkey, CAST(w.l_linenumber AS BIGINT) AS l_linenumber
FROM wanted w ANTI JOIN lineitem l ON l.l_orderkey = w.l_orderkey AND l.l_linenumber = w.l_linenumber""",
)
def missing_lines(t):
    return c.missing_ordinals(t.lineitem, ["l_orderkey"], "l_linenumber")


@query(
    "C1",
    """
WITH present AS (
  SELECT doc_id FROM labels UNION SELECT min(doc_id) - 1 FROM documents UNION SELECT max(doc_id) + 1 FROM documents),
gaps AS (SELECT doc_id + 1 AS first, lead(doc_id) OVER (ORDER BY doc_id) - 1 AS last FROM present)
SELECT first, last, last - first + 1 AS n FROM gaps WHERE first <= last""",
)
def missing_label_ranges(t):
    bounds = t.documents.agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return c.missing_ranges(t.labels, [], "doc_id", bounds=bounds)


@query(
    "C2",
    """
WITH present AS (SELECT DISTINCT doc_id FROM labels),
marked AS (SELECT doc_id, doc_id - row_number() OVER (ORDER BY doc_id) AS island FROM present)
SELECT min(doc_id) AS start, max(doc_id) AS "end", max(doc_id) - min(doc_id) + 1 AS n
FROM marked GROUP BY island""",
)
def label_islands(t):
    return c.ordinal_islands(t.labels, [], "doc_id")


@query(
    "C2",
    """
WITH present AS (SELECT DISTINCT l_partkey, l_orderkey FROM lineitem),
marked AS (
  SELECT *, l_orderkey - row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS island FROM present)
SELECT l_partkey, min(l_orderkey) AS start, max(l_orderkey) AS "end", max(l_orderkey) - min(l_orderkey) + 1 AS n
FROM marked GROUP BY l_partkey, island""",
)
def part_order_islands(t):
    return c.ordinal_islands(t.lineitem, ["l_partkey"], "l_orderkey")


@query(
    "C3",
    """
SELECT source, count(*) FILTER (source = 'src' || (doc_id % 20)) AS n_kept,
       count(*) FILTER (source <> 'src' || (doc_id % 20)) AS n_broken
FROM documents GROUP BY source""",
)
def routing_check(t):
    expected = F.concat(F.lit("src"), F.pmod("doc_id", F.lit(20)).cast("string"))
    return c.routing_check(t.documents, "source", expected)


# Blocks of five ids; how many there should be is declared by the documents.
@query(
    "C4",
    """
SELECT g.bucket
FROM (SELECT unnest(generate_series(0, (SELECT max(doc_id) FROM documents) // 5)) AS bucket) g
ANTI JOIN (SELECT doc_id // 5 AS bucket FROM labels) l ON l.bucket = g.bucket""",
)
def missing_buckets(t):
    declared = t.documents.select(F.expr("doc_id div 5 + 1").alias("total"))
    return c.missing_shards(t.labels.select(F.expr("doc_id div 5").alias("bucket")), "bucket", "total", declared=declared)


@query(
    "C4",
    """
WITH present AS (
  SELECT doc_id // 5 AS bucket FROM labels UNION SELECT -1 UNION SELECT max(doc_id) // 5 + 1 FROM documents),
gaps AS (SELECT bucket + 1 AS first, lead(bucket) OVER (ORDER BY bucket) - 1 AS last FROM present)
SELECT first, last, last - first + 1 AS n FROM gaps WHERE first <= last""",
)
def missing_bucket_ranges(t):
    declared = t.documents.select(F.expr("doc_id div 5 + 1").alias("total"))
    buckets = t.labels.select(F.expr("doc_id div 5").alias("bucket"))
    return c.missing_shard_ranges(buckets, "bucket", "total", declared=declared)


@query(
    "C5",
    """
SELECT doc_id // 100 AS block, count(*) AS n_rows, round(count(*) / 100, 8) AS fill FROM labels GROUP BY 1""",
)
def label_fill(t):
    blocks = t.labels.select(F.floor(F.col("doc_id") / 100).alias("block"))
    return c.shard_fill(blocks, ["block"], 100).withColumn("fill", F.round("fill", 8))


@query(
    "C6",
    f"""
WITH {DOCS}, last_big AS (
  SELECT lang, max(doc_id) FILTER (size >= 10000) AS last_big_ordinal FROM docs GROUP BY lang)
SELECT d.lang, max(last_big_ordinal) AS last_big_ordinal,
       count(*) FILTER (doc_id <= last_big_ordinal) AS n_before,
       count(*) FILTER (doc_id <= last_big_ordinal AND size >= 10000) AS n_big_before,
       count(*) FILTER (NOT coalesce(doc_id <= last_big_ordinal, FALSE)) AS n_after,
       count(*) FILTER (NOT coalesce(doc_id <= last_big_ordinal, FALSE) AND size >= 10000) AS n_big_after
FROM docs d JOIN last_big b ON b.lang = d.lang GROUP BY d.lang""",
)
def size_cap_audit(t):
    return c.size_cap_audit(documents_manifest(t.documents), ["lang"], "doc_id", 10_000)
