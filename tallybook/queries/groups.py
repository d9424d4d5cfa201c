"""G1-G7 on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.storage import store
from tallybook.operators import groups as g
from tallybook.plans.splits import leak_free_split
from tallybook.queries.registry import DOCS, query
from tallybook.sources.tables import documents_manifest


@query(
    "G1",
    """
WITH children AS (SELECT o_custkey, count(DISTINCT o_orderpriority) AS n_children FROM orders GROUP BY o_custkey)
SELECT o_custkey, o_orderpriority, o_orderkey, n_children,
       row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey) AS member_no,
       count(*) OVER (PARTITION BY o_custkey) AS n_members
FROM orders JOIN children USING (o_custkey)""",
)
def customer_orders(t):
    return g.entity_hierarchy(t.orders, "o_custkey", "o_orderpriority", ["o_orderkey"])


@query(
    "G2",
    """
SELECT l_partkey, count(DISTINCT l_suppkey) AS n_parents
FROM lineitem GROUP BY l_partkey HAVING count(DISTINCT l_suppkey) > 1""",
)
def shared_parts(t):
    return g.shared_children(t.lineitem, "l_suppkey", ["l_partkey"])


@query(
    "G2",
    """
SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS n_parents
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(DISTINCT l_suppkey) > 1""",
)
def shared_lines(t):
    return g.shared_children(t.lineitem, "l_suppkey", ["l_orderkey", "l_linenumber"])


# Documents are linked when they have a whole line in common, blank lines aside.
SQL_COMPONENTS = """lines AS (
  SELECT DISTINCT doc_id, sha256(line) AS via
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE regexp_matches(line, '\\S')),
star AS (
  SELECT DISTINCT l.doc_id AS a, m.b FROM lines l
  JOIN (SELECT via, min(doc_id) AS b FROM lines GROUP BY via) m ON m.via = l.via WHERE m.b < l.doc_id),
edges AS (SELECT a, b FROM star UNION SELECT b AS a, a AS b FROM star),
spread(node, label) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.b, s.label FROM spread s JOIN edges e ON e.a = s.node WHERE s.label < e.b),
components AS (SELECT node AS doc_id, min(label) AS component FROM spread GROUP BY node)"""


def _lines(documents: DataFrame) -> DataFrame:
    """doc_id and hash of each line of each whole text; null for a blank line.

    Written out, as components and splits read it several times: texts are read
    and hashed once.
    """
    line = documents.select("doc_id", F.explode_outer(F.split("text", "\n")).alias("line"))
    return store(
        line.select("doc_id", F.when(F.col("line").rlike(r"\S"), F.unhex(F.sha2("line", 256))).alias("via")), "lines"
    )


@query("G3", f"WITH RECURSIVE {SQL_COMPONENTS} SELECT doc_id, component FROM components")
def linked_docs(t):
    return g.linked_groups(_lines(t.documents), "doc_id", "via")


BUCKET = "CAST('0x' || substr(sha256(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT) % 100"
SPLIT = "CASE WHEN bucket < 80 THEN 'train' WHEN bucket < 90 THEN 'val' ELSE 'test' END"


@query(
    "G4",
    f"""
WITH hashed AS (SELECT doc_id, CAST({BUCKET.format(key='doc_id')} AS INTEGER) AS bucket FROM documents)
SELECT doc_id, bucket, {SPLIT} AS split FROM hashed""",
)
def doc_split(t):
    return g.group_split(t.documents.select("doc_id"), "doc_id")


@query(
    "G5",
    f"""
WITH {DOCS}, hashed AS (SELECT *, {BUCKET.format(key='doc_id')} AS bucket FROM docs),
placed AS (SELECT oid, {SPLIT} AS split FROM hashed),
seen AS (SELECT oid, split, count(*) AS n_rows, count(*) OVER (PARTITION BY oid) AS n_splits FROM placed GROUP BY oid, split)
SELECT * FROM seen WHERE n_splits > 1""",
)
def split_leakage(t):
    docs = documents_manifest(t.documents)
    return g.split_leakage(g.group_split(docs, "doc_id"), "oid")


# Split by component: every line, and so every copied text, stays in one split.
@query(
    "G4",
    f"""
WITH RECURSIVE {SQL_COMPONENTS},
hashed AS (SELECT doc_id, component, CAST({BUCKET.format(key='component')} AS INTEGER) AS bucket FROM components)
SELECT doc_id, component, bucket, {SPLIT} AS split FROM hashed""",
)
def linked_doc_split(t):
    lines = _lines(t.documents)
    return g.group_split(g.linked_groups(lines, "doc_id", "via"), F.col("component").cast("string"))


@query(
    "G5",
    f"""
WITH RECURSIVE {SQL_COMPONENTS},
hashed AS (SELECT doc_id, component, {BUCKET.format(key='component')} AS bucket FROM components),
placed AS (SELECT DISTINCT l.via, {SPLIT} AS split FROM lines l JOIN hashed h ON h.doc_id = l.doc_id),
leaks AS (SELECT via FROM placed GROUP BY via HAVING count(*) > 1)
SELECT (SELECT count(DISTINCT via) FROM lines) AS n_groups, (SELECT count(*) FROM leaks) AS n_leaking""",
)
def leak_free_check(t):
    lines = _lines(t.documents)
    placed = leak_free_split(lines, "doc_id", "via").filter("via IS NOT NULL")
    splits = placed.select("via", "split").distinct().groupBy("via").agg(F.count(F.lit(1)).alias("n_splits"))
    return splits.agg(F.count(F.lit(1)).alias("n_groups"), F.count_if(F.col("n_splits") > 1).alias("n_leaking"))


# What the split by component really gives: one large component can hold most documents.
@query(
    "G4",
    f"""
WITH RECURSIVE {SQL_COMPONENTS},
hashed AS (SELECT doc_id, component, {BUCKET.format(key='component')} AS bucket FROM components),
placed AS (SELECT component, {SPLIT} AS split, count(*) AS n FROM hashed GROUP BY component, bucket)
SELECT split, count(*) AS n_components, CAST(sum(n) AS BIGINT) AS n_docs, max(n) AS largest_component,
       round(sum(n) / (SELECT count(*) FROM components), 8) AS share
FROM placed GROUP BY split""",
)
def reached_shares(t):
    split = g.group_split(g.linked_groups(_lines(t.documents), "doc_id", "via"), F.col("component").cast("string"))
    sizes = split.groupBy("split", "component").agg(F.count(F.lit(1)).alias("n"))
    reached = sizes.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_components"), F.sum("n").alias("n_docs"), F.max("n").alias("largest_component")
    )
    return reached.withColumn("share", F.round(F.col("n_docs") / t.documents.agg(F.count(F.lit(1))).scalar(), 8))


@query(
    "G6",
    f"""
WITH {DOCS}, ranked AS (
  SELECT path, oid, lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY oid, path) AS INTEGER) AS rank FROM docs)
SELECT * FROM ranked WHERE rank <= 100""",
)
def capped_sample(t):
    return g.capped_sample(documents_manifest(t.documents).select("path", "oid", "lang"), "lang", 100)


@query(
    "G7",
    f"""
WITH {DOCS}, ranked AS (
  SELECT path, oid, lang, row_number() OVER (PARTITION BY lang ORDER BY oid, path) AS r,
         count(*) OVER (PARTITION BY lang) AS n FROM docs)
SELECT path, oid, lang, CASE WHEN r <= n * 80 // 100 THEN 'train' WHEN r <= n * 90 // 100 THEN 'val' ELSE 'test' END AS split
FROM ranked""",
)
def stratified_split(t):
    docs = store(documents_manifest(t.documents).select("path", "oid", "lang"), "docs")
    return g.stratified_split(docs, "lang")
