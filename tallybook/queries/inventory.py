"""I1-I12 on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.functions.joins import join_summary
from tallybook.operators import inventory as i
from tallybook.queries.registry import DOCS, query
from tallybook.sources.tables import documents_manifest, pages_addresses

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "I1",
    f"""
WITH {DOCS}
SELECT lang, source, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS n_bytes FROM docs GROUP BY lang, source""",
)
def doc_inventory(t):
    return i.class_inventory(documents_manifest(t.documents), ["lang", "source"])


@query(
    "I2",
    f"""
WITH {DOCS}
SELECT lang, source, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS n_bytes,
       CAST(grouping(lang) + grouping(source) AS INTEGER) AS level
FROM docs GROUP BY ROLLUP (lang, source)""",
)
def inventory_rollup(t):
    return i.inventory_rollup(documents_manifest(t.documents), ["lang", "source"])


@query(
    "I3",
    """
SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'error') AS error,
       count(*) FILTER (event_type = 'purchase') AS purchase, count(*) FILTER (event_type = 'signup') AS signup,
       count(*) FILTER (event_type = 'view') AS view,
       count(*) FILTER (event_type IS NULL OR event_type NOT IN ('click', 'error', 'purchase', 'signup', 'view')) AS other
FROM events GROUP BY user_id""",
)
def event_pivot(t):
    return i.modality_pivot(t.events, ["user_id"], "event_type", EVENT_TYPES)


@query(
    "I4",
    f"""
WITH {DOCS}
SELECT lang, count(size) AS n, min(size) AS min_size, max(size) AS max_size, round(avg(size), 4) AS avg_size,
       round(quantile_cont(CAST(size AS DOUBLE), 0.5), 4) AS p50,
       round(quantile_cont(CAST(size AS DOUBLE), 0.95), 4) AS p95
FROM docs GROUP BY lang""",
)
def size_stats(t):
    stats = i.size_stats(documents_manifest(t.documents), ["lang"])
    return stats.withColumns({c: F.round(c, 4) for c in ("avg_size", "p50", "p95")})


# The one-pass form, on the largest table. Any value it gives is within 1/10000
# of the wanted rank, so there is no single SQL answer.
@query("I4")
def size_stats_approximate(t):
    return i.size_stats(t.lineitem, ["l_returnflag"], size="l_extendedprice", approximate=True)


# Whether the approximate percentiles are within 1/10000 of the wanted rank.
@query(
    "I4",
    """
SELECT l_returnflag, count(l_extendedprice) AS n, true AS p50_is_near, true AS p95_is_near
FROM lineitem GROUP BY l_returnflag""",
)
def size_stats_approximate_rank(t):
    lines = t.lineitem.select("l_returnflag", "l_extendedprice")
    stats = i.size_stats(lines, ["l_returnflag"], size="l_extendedprice", approximate=True)
    ranked = join_summary(lines, stats.select("l_returnflag", "p50", "p95"), ["l_returnflag"])
    price, n = F.col("l_extendedprice"), F.count("l_extendedprice")

    def near(name: str, point: float):
        below, upto = F.count_if(price < F.col(name)), F.count_if(price <= F.col(name))
        return ((below <= (point + 1e-4) * n + 1) & (upto >= (point - 1e-4) * n - 1)).alias(f"{name}_is_near")

    return ranked.groupBy("l_returnflag").agg(n.alias("n"), near("p50", 0.5), near("p95", 0.95))


@query(
    "I4",
    """
SELECT l_returnflag, count(*) AS n, min(cents) AS min_size, max(cents) AS max_size, round(avg(cents), 4) AS avg_size,
       round(quantile_cont(CAST(cents AS DOUBLE), 0.5), 4) AS p50,
       round(quantile_cont(CAST(cents AS DOUBLE), 0.95), 4) AS p95
FROM (SELECT l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem) GROUP BY l_returnflag""",
)
def price_stats(t):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    stats = i.size_stats(t.lineitem.select("l_returnflag", cents.alias("cents")), ["l_returnflag"], size="cents")
    return stats.withColumns({c: F.round(c, 4) for c in ("avg_size", "p50", "p95")})


@query(
    "I5",
    f"""
WITH {DOCS}
SELECT CASE WHEN size > 0 THEN CAST(length(bin(size)) - 1 AS INTEGER) END AS power, count(*) AS n_rows,
       CAST(sum(size) AS BIGINT) AS n_bytes
FROM docs GROUP BY 1""",
)
def size_histogram(t):
    return i.size_histogram(documents_manifest(t.documents))


@query(
    "I6",
    f"""
WITH {DOCS}, q AS (
  SELECT lang, quantile_cont(CAST(size AS DOUBLE), 0.25) AS q1, quantile_cont(CAST(size AS DOUBLE), 0.75) AS q3
  FROM docs GROUP BY lang)
SELECT path, size, lang, round(q1 - 1.5 * (q3 - q1), 4) AS low_fence, round(q3 + 1.5 * (q3 - q1), 4) AS high_fence
FROM docs JOIN q USING (lang)
WHERE size < q1 - 1.5 * (q3 - q1) OR size > q3 + 1.5 * (q3 - q1)""",
)
def size_outliers(t):
    found = i.size_outliers(documents_manifest(t.documents), ["lang"])
    return found.select(
        "path", "size", "lang", *[F.round(c, 4).alias(c) for c in ("low_fence", "high_fence")]
    )


@query(
    "I7",
    f"""
WITH {DOCS}, ranked AS (
  SELECT path, oid, size, doc_id, lang, source,
         CAST(row_number() OVER (PARTITION BY lang ORDER BY size DESC, path) AS INTEGER) AS rank FROM docs)
SELECT * FROM ranked WHERE rank <= 10""",
)
def largest_k(t):
    return i.largest_k(documents_manifest(t.documents), ["lang"], 10)


@query(
    "I8",
    """
WITH counts AS (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)
SELECT lang, n, round((SELECT sum(n) FROM counts) / ((SELECT count(*) FROM counts) * n), 8) AS weight FROM counts""",
)
def class_weights(t):
    return i.class_weights(t.documents, "lang").withColumn("weight", F.round("weight", 8))


@query(
    "I8",
    """
WITH counts AS (SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY source, lang),
totals AS (SELECT source, sum(n) AS total, count(*) AS classes FROM counts GROUP BY source)
SELECT source, lang, n, round(total / (classes * n), 8) AS weight FROM counts JOIN totals USING (source)""",
)
def class_weights_by_source(t):
    return i.class_weights(t.documents, "lang", within=["source"]).withColumn("weight", F.round("weight", 8))


@query(
    "I9",
    r"""
WITH tails AS (
  SELECT regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 1) AS host,
         regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 4) AS tail FROM pages),
counts AS (
  SELECT nullif(host, '') AS host,
         CASE WHEN tail = '' THEN 'none' WHEN tail = '/' THEN 'slash' WHEN tail LIKE '?%' THEN 'query'
              WHEN tail LIKE '#%' THEN 'fragment' ELSE 'other' END AS kind, count(*) AS n
  FROM tails GROUP BY 1, 2),
shares AS (SELECT host, kind, n, n / sum(n) OVER (PARTITION BY host) AS share FROM counts)
SELECT host, kind, n, round(share, 8) AS share, share < 0.5 AS is_minority FROM shares""",
)
def url_suffix_audit(t):
    tail = F.col("tail")
    kind = (
        F.when(tail == "", "none")
        .when(tail == "/", "slash")
        .when(tail.startswith("?"), "query")
        .when(tail.startswith("#"), "fragment")
        .otherwise("other")
    )
    return i.format_audit(pages_addresses(t.pages), "host", kind=kind).withColumn("share", F.round("share", 8))


@query(
    "I10",
    r"""
WITH parts AS (
  SELECT regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 1) AS host,
         regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 3) AS name FROM pages)
SELECT name, count(DISTINCT host) AS n_places, count(*) AS n_rows
FROM parts WHERE name <> '' GROUP BY name HAVING count(DISTINCT host) > 1""",
)
def ordinal_collisions(t):
    return i.name_collisions(pages_addresses(t.pages), F.col("ordinal").cast("string"), F.col("host"))


@query("I11")
def distinct_estimate(t):
    return i.distinct_estimate(documents_manifest(t.documents), ["lang"])


# Whether the estimate is within three times its standard error of the exact count.
@query(
    "I11",
    f"""
WITH {DOCS} SELECT lang, count(*) AS n_rows, count(DISTINCT oid) AS n_oids, true AS is_near FROM docs GROUP BY lang""",
)
def distinct_estimate_error(t):
    docs = documents_manifest(t.documents).select("lang", "oid")
    exact = docs.groupBy("lang", "oid").agg(F.count(F.lit(1)).alias("n")).groupBy("lang")
    exact = exact.agg(F.sum("n").alias("n_rows"), F.count("oid").alias("n_oids"))
    found = join_summary(exact, i.distinct_estimate(docs, ["lang"], rsd=0.05).drop("n_rows"), ["lang"])
    is_near = F.abs(F.col("n_oids_estimate") - F.col("n_oids")) <= 3 * 0.05 * F.col("n_oids")
    return found.select("lang", "n_rows", "n_oids", is_near.alias("is_near"))


@query(
    "I12",
    """
SELECT d.lang, count(*) AS n_rows, count(l.doc_id) AS n_labelled, round(count(l.doc_id) / count(*), 8) AS share
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON l.doc_id = d.doc_id GROUP BY d.lang""",
)
def label_coverage(t):
    labelled = t.labels.select("doc_id").distinct().withColumn("label", F.lit(1))
    marked = t.documents.select("doc_id", "lang").join(labelled, "doc_id", "left")
    return i.label_coverage(marked, ["lang"]).withColumn("share", F.round("share", 8))
