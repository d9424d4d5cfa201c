"""X2-X12 on the given tables: streams with event time, snapshots, joins on time, stored summaries, bucketed tables, JSON attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.joins import join_summary
from tallybook.functions.storage import scratch_path, store
from tallybook.operators import sketches as sk
from tallybook.operators.duplicates import duplicate_groups, exact_dedup
from tallybook.operators.sidecars import read_attributes
from tallybook.operators.snapshots import manifest_diff, write_snapshot
from tallybook.operators.temporal import asof_join, interval_join
from tallybook.queries.registry import DOCS, Tables, query
from tallybook.sources.manifests import write_bucketed
from tallybook.sources.tables import documents_manifest
from tallybook.streaming.events import closed_sessions, first_seen, read_slices, run_to_table, write_slices

SLICES = 6  # batches that the events arrive in


def _arriving(t: Tables, events: DataFrame, again: int = 0) -> DataFrame:
    """Events as a stream, in slices of time."""
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    where = scratch_path(t.spark, "slices")
    cuts = [first + (last - first) * i / SLICES for i in range(1, SLICES)] if first else []
    write_slices(events, where, "ts", cuts, again)
    return read_slices(t.spark, where, ", ".join(f"{name} {kind}" for name, kind in events.dtypes))


def _micros(time: str, name: str) -> Column:
    return F.unix_micros(time).alias(name)


def _written(t: Tables, stream: DataFrame, schema: str) -> DataFrame:
    out, checkpoint = scratch_path(t.spark, "out"), scratch_path(t.spark, "progress")
    run_to_table(stream, out, checkpoint)
    return t.spark.read.schema(schema).parquet(out)


@query("X2", "SELECT event_id, epoch_us(ts) AS ts_us, user_id, event_type FROM events")
def first_deliveries(t):
    """Events of the last 6 hours of each batch are delivered again with the next one; each comes out once."""
    stream = _arriving(t, t.events.select("event_id", "ts", "user_id", "event_type"), again=6 * 3600)
    found = _written(t, first_seen(stream, ["event_id"], "ts", "1 day"), "event_id bigint, ts timestamp, user_id bigint, event_type string")
    return found.select("event_id", _micros("ts", "ts_us"), "user_id", "event_type")


@query(
    "X4",
    """
WITH marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 4 HOURS THEN 0 ELSE 1 END AS is_new
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(is_new) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked),
sessions AS (
  SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 4 HOURS AS session_end, count(*) AS n_rows,
         count(DISTINCT event_type) FILTER (event_type = 'purchase') AS bought
  FROM numbered GROUP BY user_id, session)
SELECT user_id, epoch_us(session_start) AS start_us, epoch_us(session_end) AS end_us, n_rows, bought FROM sessions
WHERE session_end <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 DAY FROM events)""",
)
def streamed_sessions(t):
    """Sessions of each user that are closed when the last batch has come."""
    stream = _arriving(t, t.events.select("event_id", "ts", "user_id", "event_type"))
    bought = F.max(F.when(F.col("event_type") == "purchase", 1).otherwise(0)).cast("bigint").alias("bought")
    schema = "user_id bigint, session_start timestamp, session_end timestamp, n_rows bigint, bought bigint"
    found = _written(t, closed_sessions(stream, ["user_id"], "ts", "4 hours", "1 day", [bought]), schema)
    return found.select("user_id", _micros("session_start", "start_us"), _micros("session_end", "end_us"), "n_rows", "bought")


# The later snapshot: copies removed, long texts filed elsewhere, doubled exclamation marks made single.
@query(
    "X3",
    f"""
WITH {DOCS},
old AS (SELECT path, oid, size, row_number() OVER (PARTITION BY path ORDER BY oid, size) AS nth FROM docs),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY lang, doc_id, path) AS rn FROM docs) WHERE rn = 1),
refiled AS (
  SELECT CASE WHEN octet_length(encode(d.text)) > 5000 THEN 'long/' || d.doc_id ELSE k.path END AS path,
         sha256(replace(d.text, '!!', '!')) AS oid,
         CAST(octet_length(encode(replace(d.text, '!!', '!'))) AS BIGINT) AS size
  FROM kept k JOIN documents d ON k.doc_id = d.doc_id),
new AS (SELECT path, oid, size, row_number() OVER (PARTITION BY path ORDER BY oid, size) AS nth FROM refiled),
unequal AS (
  SELECT old.path AS old_path, old.oid AS old_oid, old.size AS old_size, old.nth AS old_nth,
         new.path, new.oid, new.size, new.nth
  FROM old FULL OUTER JOIN new ON old.path = new.path AND old.nth = new.nth
  WHERE old.oid IS DISTINCT FROM new.oid OR old.size IS DISTINCT FROM new.size),
gone AS (SELECT *, row_number() OVER (PARTITION BY old_oid ORDER BY old_path, old_nth) AS k FROM unequal WHERE path IS NULL),
come AS (SELECT *, row_number() OVER (PARTITION BY oid ORDER BY path, nth) AS k FROM unequal WHERE old_path IS NULL)
SELECT 'changed' AS change, path, old_path, oid, old_oid, size, old_size FROM unequal WHERE path = old_path
UNION ALL
SELECT CASE WHEN g.old_path IS NULL THEN 'added' WHEN c.path IS NULL THEN 'removed' ELSE 'moved' END,
       c.path, g.old_path, c.oid, g.old_oid, c.size, g.old_size
FROM gone g FULL OUTER JOIN come c ON g.old_oid = c.oid AND g.k = c.k""",
)
def snapshot_diff(t):
    docs = documents_manifest(t.documents)
    kept = exact_dedup(docs, order=["lang", "doc_id", "path"]).select("path", "doc_id")
    plain = F.replace("text", F.lit("!!"), F.lit("!"))
    refiled = kept.join(t.documents.select("doc_id", "text"), "doc_id").select(
        F.when(F.octet_length("text") > 5000, F.concat(F.lit("long/"), "doc_id")).otherwise(F.col("path")).alias("path"),
        F.sha2(plain, 256).alias("oid"),
        F.octet_length(plain).cast("bigint").alias("size"),
    )
    before, after = scratch_path(t.spark, "before"), scratch_path(t.spark, "after")
    write_snapshot(docs, before, fanout=8)
    write_snapshot(refiled, after, like=before)
    return manifest_diff(t.spark, before, after)


@query(
    "X5",
    """
SELECT p.event_id, p.user_id, v.event_id AS view_event_id, epoch_us(p.ts) - epoch_us(v.ts) AS since_us
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v ON p.user_id = v.user_id AND p.ts >= v.ts""",
)
def view_before_purchase(t):
    """Each purchase with the user's last view before it."""
    of = lambda kind: t.events.filter(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    found = asof_join(of("purchase"), of("view"), ["user_id"], "ts", "ts", tie=["event_id"], prefix="view_")
    since = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("view_ts").cast("timestamp"))
    return found.select("event_id", "user_id", "view_event_id", since.alias("since_us"))


@query(
    "X5",
    """
SELECT e.event_id, c.event_id AS click_event_id, c.user_id AS click_user_id
FROM events e ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'click') c ON e.ts > c.ts""",
)
def click_before_event(t):
    """Each event with the last click of anyone before it: all rows have one key."""
    clicks = t.events.filter(F.col("event_type") == "click").select("event_id", "user_id", "ts")
    found = asof_join(t.events.select("event_id", "ts"), clicks, [], "ts", "ts", tie=["event_id"], strict=True, prefix="click_")
    return found.select("event_id", "click_event_id", "click_user_id")


@query(
    "X6",
    """
WITH spans AS (
  SELECT event_id, user_id, ts, ts + to_minutes(CAST(floor(value) AS BIGINT)) AS till FROM events)
SELECT a.user_id, a.event_id, b.event_id AS other_event_id
FROM spans a JOIN spans b ON a.user_id = b.user_id AND a.event_id < b.event_id
 AND a.ts < b.till AND b.ts < a.till AND a.ts < a.till AND b.ts < b.till""",
)
def overlapping_events(t):
    """Two events of a user that overlap, where an event lasts as many minutes as its value."""
    spans = t.events.select(
        "event_id", "user_id", "ts",
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor("value").cast("int"))).alias("till"),
    )
    found = interval_join(spans, spans, ["user_id"], ("ts", "till"), ("ts", "till"), width=30 * 60 * 1_000_000, prefix="other_")
    return found.filter("event_id < other_event_id").select("user_id", "event_id", "other_event_id")


def _loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Documents as a manifest in two loads, by source."""
    docs = documents_manifest(t.documents).select("oid", "lang", "source", "size")
    late = F.coalesce(F.pmod(F.xxhash64("source"), F.lit(2)) == 1, F.lit(False))
    return docs.filter(late), docs.filter(~late)


# Stored sketches of two loads by language and source, merged to languages: near the exact number, and the same as built at once.
@query(
    "X7",
    f"""
WITH {DOCS} SELECT lang, count(*) AS n_rows, count(DISTINCT oid) AS n_oids, true AS is_near, true AS as_at_once FROM docs GROUP BY lang""",
)
def merged_distinct(t):
    loads = [store(sk.distinct_sketches(load, ["lang", "source"], "oid"), "sketches") for load in _loads(t)]
    merged = sk.distinct_of(sk.merge_distinct(loads[0].unionByName(loads[1]), ["lang"]))
    docs = documents_manifest(t.documents).select("lang", "oid")
    at_once = sk.distinct_of(sk.distinct_sketches(docs, ["lang"], "oid")).select("lang", F.col("n_distinct").alias("direct"))
    exact = docs.distinct().groupBy("lang").agg(F.count("oid").alias("n_oids"))
    found = join_summary(join_summary(merged, at_once, ["lang"]), exact, ["lang"])
    error = 3 * 1.04 / 64  # three standard errors
    return found.select(
        "lang", "n_rows", "n_oids", (F.abs(F.col("n_distinct") - F.col("n_oids")) <= error * F.col("n_oids") + 1).alias("is_near"),
        (F.abs(F.col("n_distinct") - F.col("direct")) <= error * F.col("n_oids") + 1).alias("as_at_once"),
    )


# Quantile sketches of lines by flag and status, merged to flags: whether ranks are within 1 %.
@query(
    "X8",
    """
SELECT l_returnflag, count(*) AS n, true AS p50_is_near, true AS p99_is_near FROM lineitem GROUP BY l_returnflag""",
)
def merged_quantiles(t):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents")
    lines = t.lineitem.select("l_returnflag", "l_linestatus", cents)
    fine = store(sk.quantile_sketches(lines, ["l_returnflag", "l_linestatus"], "cents"), "sketches")
    found = sk.quantiles_of(sk.merge_quantiles(fine, ["l_returnflag"]), {"p50": 0.5, "p99": 0.99})
    ranked = join_summary(lines, found, ["l_returnflag"])

    def near(name: str, point: float) -> Column:
        below, upto = F.count_if(F.col("cents") < F.col(name)), F.count_if(F.col("cents") <= F.col(name))
        n = F.count(F.lit(1))
        return ((below <= (point + 0.01) * n + 1) & (upto >= (point - 0.01) * n - 1)).alias(f"{name}_is_near")

    return ranked.groupBy("l_returnflag").agg(F.max("n").alias("n"), near("p50", 0.5), near("p99", 0.99))


@query(
    "X9",
    """
SELECT user_id, count(*) AS n FROM events GROUP BY user_id HAVING count(*) > 0.005 * (SELECT count(*) FROM events)""",
)
def heavy_users(t):
    return sk.heavy_hitters(t.events, ["user_id"], 0.005)


@query(
    "X9",
    """
SELECT e.event_id, e.event_type, k.n_users FROM events e
JOIN (SELECT event_type, count(DISTINCT user_id) AS n_users FROM events GROUP BY event_type) k ON e.event_type = k.event_type""",
)
def salted_types(t):
    """Every event type is heavy."""
    users = t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("n_users"))
    return sk.salted_join(t.events.select("event_id", "event_type"), users, ["event_type"], share=0.05, salts=8)


@query(
    "X10",
    f"""
WITH {DOCS}, grouped AS (
  SELECT grouping(lang) AS no_lang, grouping(source) AS no_source, lang, source, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS size
  FROM docs GROUP BY GROUPING SETS ((lang, source), (source), (lang), ()))
SELECT CAST(CASE WHEN no_lang = 0 AND no_source = 0 THEN 0 WHEN no_source = 0 THEN 1 WHEN no_lang = 0 THEN 2 ELSE 3 END AS INTEGER) AS set_no,
       lang, source, n_rows, size FROM grouped""",
)
def docs_cube(t):
    docs = documents_manifest(t.documents).select("lang", "source", "size")
    found = sk.grouping_sets(docs, [["lang", "source"], ["source"], ["lang"], []], ["size"])
    return found.select("set_no", "lang", "source", "n_rows", "size")


# Documents bucketed by content: copies, first copies and payload checks without another shuffle.
@query(
    "X11",
    f"""
WITH {DOCS}, copies AS (SELECT oid, count(*) AS n, min(path) AS first_path FROM docs GROUP BY oid HAVING count(*) > 1)
SELECT d.oid, d.path, c.n FROM docs d JOIN copies c ON c.oid = d.oid""",
)
def bucketed_copies(t):
    docs = documents_manifest(t.documents).select("oid", "path", "size")
    where = scratch_path(t.spark, "bucketed")
    table = write_bucketed(docs, f"bucketed_{where[-32:]}", where, buckets=8)
    groups = duplicate_groups(table).select("oid", "n")
    return table.select("oid", "path").join(groups.hint("merge"), "oid")


@query(
    "X12",
    """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS attribute_problem FROM events""",
)
def event_attributes(t):
    found = read_attributes(t.events.select("event_id", "props"), "props", {"k": ("$.k", "bigint")})
    return found.select("event_id", "k", "attribute_problem")
