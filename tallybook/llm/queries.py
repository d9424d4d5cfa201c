"""The operators of this subpackage on the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.joins import join_null_safe
from tallybook.functions.storage import store
from tallybook.llm import (
    cascade, chat, decontaminate, extract, hnsw, labelled, mixing, quality, rules, scoring, simhash,
    variants, warc, whitening,
)
from tallybook.sources.tables import read_table


@dataclass(frozen=True)
class LlmQuery:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's probability under the model of those that are not held out."""
    return scoring.language_model_scores(read_table(spark, sf_dir, "documents"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found among all vectors for each whose vec_id is divisible by 100."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return hnsw.search(hnsw.build_index(vectors, 10), vectors.filter(F.col("vec_id") % 100 == 0), 10)


LABELLED_PAGES = 900


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page, by a chain trained on labelled pages."""
    samples = spark.createDataFrame(labelled.pages(LABELLED_PAGES), "html string, main array<boolean>")
    return extract.extract(read_table(spark, sf_dir, "pages"), extract.train(samples))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10-word windows of all benchmark items in all documents."""
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


OP4_SQL = r"""
WITH RECURSIVE lower_docs AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
docs AS (SELECT row_no, doc_id, coalesce(w, []) AS w FROM lower_docs),
items AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS k,
         array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT row_no, s, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM docs, sizes, unnest(range(1, len(w) - k + 2)) AS t(s) WHERE len(w) >= k),
hits AS (SELECT row_no, s, places.k, item FROM places JOIN windows ON places.win = windows.win AND places.k = windows.k),
covered AS (
  SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT row_no, s, k FROM hits), unnest(range(s, s + k)) AS t(p) GROUP BY 1),
named AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT row_no, item FROM hits WHERE item IS NOT NULL) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (row_no) LEFT JOIN named USING (row_no)
"""


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record for every page, written to ZIP packages and read back by ranges."""
    packages = warc.write_packages(read_table(spark, sf_dir, "pages"))
    found = warc.read_records(packages, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rate for every document at which the domains of the labels table get their target shares of tokens."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", mixing.domain_of().alias("domain"))
    return mixing.rates(read_table(spark, sf_dir, "documents"), labels, mixing.TARGETS).drop("hash")


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among all documents: 3-word shingles, at most 3 differing bits."""
    found = simhash.near_copies(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it is kept."""
    found = quality.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "n_bytes", "perplexity", "limit", "keep")


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that looks like the template, through the event log, the template and back."""
    rows = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    planted = spark.range(2).select(
        F.lit(-7).cast("bigint"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said)
    )
    formatted = store(chat.render(chat.fold(chat.log_of(rows.union(planted)))), "formatted")
    found = chat.digests(chat.read_back(formatted))
    lengths = formatted.select("conv_id", F.char_length("formatted").cast("bigint").alias("formatted_chars"))
    return join_null_safe(found, lengths, ["conv_id"])


OP9_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '###', '\h'), '</turn>', '\t') AS body,
         replace(replace(replace(replace(role, '\', '\\'), '###', '\h'), '</turn>', '\t'), ':', '\c') AS head FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(head) + length(body) + 14) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged by the rules."""
    rules = spark.createDataFrame(list(URL_RULES), "host string, path string, action string")
    return cascade.judge(read_table(spark, sf_dir, "pages"), rules)


OP10_SQL = r"""
WITH rules(host, path, action) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
  SELECT row_number() OVER () AS row_no, page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
best AS (
  SELECT row_no, arg_max(rules.host || rules.path, length(rules.host || rules.path)) AS rule,
         arg_max(action, length(rules.host || rules.path)) AS action
  FROM parts JOIN rules ON (parts.host = rules.host OR ends_with(parts.host, '.' || rules.host))
       AND starts_with(parts.path, rules.path)
  GROUP BY row_no)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN best USING (row_no)
"""


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of all documents, its near words, its form and its root."""
    return variants.variants(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the four leading components of all distinct vectors."""
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"), 4)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, the rules' votes, and whether it is kept by what they are worth together."""
    return rules.judge(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, LlmQuery] = {
    "op1_lm_scoring": LlmQuery(op1_lm_scoring),
    "op2_nearest_neighbours": LlmQuery(op2_nearest_neighbours),
    "op3_html_extraction": LlmQuery(op3_html_extraction),
    "op4_benchmark_decontamination": LlmQuery(op4_benchmark_decontamination, OP4_SQL),
    "op5_warc": LlmQuery(op5_warc),
    "op6_mixing": LlmQuery(op6_mixing),
    "op7_simhash_near_dedup": LlmQuery(op7_simhash_near_dedup),
    "op8_quality_classifier": LlmQuery(op8_quality_classifier),
    "op9_chat_formatting": LlmQuery(op9_chat_formatting, OP9_SQL),
    "op10_url_filters": LlmQuery(op10_url_filters, OP10_SQL),
    "op11_spelling_variants": LlmQuery(op11_spelling_variants),
    "op12_whitening": LlmQuery(op12_whitening),
    "op13_quality_rules": LlmQuery(op13_quality_rules),
}
