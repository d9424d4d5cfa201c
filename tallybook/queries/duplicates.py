"""D1-D7 on the given tables."""

from __future__ import annotations

from tallybook.operators import duplicates as d
from tallybook.queries.registry import DOCS, query
from tallybook.sources.tables import documents_manifest


@query(
    "D1",
    f"""
WITH {DOCS}
SELECT oid, count(*) AS n, min(path) AS first_path FROM docs GROUP BY oid HAVING count(*) > 1""",
)
def dup_groups(t):
    return d.duplicate_groups(documents_manifest(t.documents))


@query(
    "D2",
    f"""
WITH {DOCS}, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY oid ORDER BY lang, doc_id, path) AS rn FROM docs)
SELECT path, oid, size, doc_id, lang, source FROM numbered WHERE rn = 1""",
)
def exact_dedup(t):
    return d.exact_dedup(documents_manifest(t.documents), order=["lang", "doc_id", "path"])


@query(
    "D3",
    f"""
WITH {DOCS}, per_oid AS (
  SELECT lang, oid, count(*) AS n, sum(size) AS logical, max(size) AS physical FROM docs GROUP BY lang, oid)
SELECT lang, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_oids,
       CAST(sum(logical) AS BIGINT) AS logical_bytes, CAST(sum(physical) AS BIGINT) AS physical_bytes,
       CAST(sum(logical) - sum(physical) AS BIGINT) AS saved_bytes
FROM per_oid GROUP BY lang""",
)
def dedup_savings(t):
    return d.dedup_savings(documents_manifest(t.documents), "lang")


@query(
    "D4",
    f"""
WITH {DOCS}, held AS (SELECT DISTINCT oid, source FROM docs WHERE source IS NOT NULL),
several AS (SELECT oid, count(*) AS n_partitions FROM held GROUP BY oid HAVING count(*) > 1)
SELECT h.oid, source, n_partitions FROM held h JOIN several s ON h.oid IS NOT DISTINCT FROM s.oid""",
)
def cross_source_dups(t):
    return d.cross_partition_duplicates(documents_manifest(t.documents), "source")


@query(
    "D5",
    f"""
WITH {DOCS}
SELECT oid, count(DISTINCT source) AS n_values FROM docs GROUP BY oid HAVING count(DISTINCT source) > 1""",
)
def conflicting_sources(t):
    return d.identity_conflicts(documents_manifest(t.documents), "source")


@query(
    "D6",
    """
WITH marked AS (
  SELECT *, CASE WHEN event_type IS NOT DISTINCT FROM lag(event_type) OVER w THEN 0 ELSE 1 END AS is_new
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM marked)
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS first_event_id,
       arg_max(event_id, (ts, event_id)) AS last_event_id, count(*) AS length
FROM numbered GROUP BY user_id, run, event_type HAVING count(*) >= 2""",
)
def event_runs(t):
    runs = d.duplicate_runs(t.events, ["user_id"], ["ts", "event_id"], value="event_type", min_length=2)
    return runs.drop("first_ts", "last_ts")


@query(
    "D7",
    f"""
WITH {DOCS}, held AS (SELECT DISTINCT source, oid FROM docs)
SELECT a.source AS group_a, b.source AS group_b, count(*) AS n_shared
FROM held a JOIN held b ON a.oid = b.oid AND a.source < b.source
GROUP BY a.source, b.source""",
)
def source_overlap(t):
    return d.origin_overlap(documents_manifest(t.documents), "source")
