"""M1-M5 on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.functions.paths import parse_path
from tallybook.functions.storage import scratch_path
from tallybook.operators.inventory import class_inventory
from tallybook.operators.validation import validate, validate_manifest, verify_payloads
from tallybook.queries.registry import DOCS, query
from tallybook.sources.manifests import write_manifest
from tallybook.sources.pointers import POINTER_VERSION, read_pointer
from tallybook.sources.tables import documents_manifest, pages_addresses


@query("M1", f"WITH {DOCS} SELECT path, oid, size FROM docs")
def manifest_docs(t):
    return documents_manifest(t.documents).select("path", "oid", "size")


# Every document as a pointer file's text. Four faults are planted by language: French ones lack the last line break,
# Spanish ones shout the hash, German ones of odd id have an unknown version; texts of over 9,999 bytes say "many".
@query(
    "M1",
    f"""
WITH {DOCS}
SELECT path,
       CASE WHEN lang = 'de' AND doc_id % 2 = 1 THEN 'https://example.org/v0' ELSE 'https://git-lfs.github.com/spec/v1' END AS version,
       CASE WHEN lang = 'es' THEN upper(oid) ELSE oid END AS oid,
       CASE WHEN size <= 9999 THEN size END AS size,
       lang <> 'fr' AND lang <> 'es' AND size <= 9999 AS well_formed,
       CASE WHEN lang = 'de' AND doc_id % 2 = 1 THEN 'bad version' WHEN lang = 'es' THEN 'bad oid' WHEN size > 9999 THEN 'bad size'
            WHEN size <= 0 THEN 'size not positive' WHEN lang = 'fr' THEN 'bad layout' END AS reason
FROM docs""",
)
def read_pointers(t):
    docs = documents_manifest(t.documents)
    odd = (F.col("lang") == "de") & (F.pmod("doc_id", F.lit(2)) == 1)
    version = F.when(odd, "https://example.org/v0").otherwise(POINTER_VERSION)
    oid = F.when(F.col("lang") == "es", F.upper("oid")).otherwise(F.col("oid"))
    size = F.when(F.col("size") <= 9999, F.col("size").cast("string")).otherwise("many")
    text = F.concat(F.lit("version "), version, F.lit("\noid sha256:"), oid, F.lit("\nsize "), size, F.when(F.col("lang") == "fr", "").otherwise("\n"))
    found = read_pointer(docs.select("path", text.alias("value"))).withColumn("path_problem", F.lit(None).cast("string"))
    return validate_manifest(found).select("path", "version", "oid", "size", "well_formed", "reason")


# Every document under a path of one of three layouts, with faults: French names disagree with their folder, Spanish paths fit no rule.
@query(
    "M2",
    """
WITH laid AS (
  SELECT doc_id, lang, TRY_CAST(replace(source, 'src', '') AS INTEGER) AS shard FROM documents)
SELECT doc_id,
       CASE lang WHEN 'en' THEN 'pmc_vqa' WHEN 'de' THEN 'oral_images' WHEN 'fr' THEN 'fluo_sc' ELSE 'elsewhere' END AS origin,
       CASE lang WHEN 'fr' THEN 'CLI' END AS modality,
       CASE lang WHEN 'de' THEN 'benign' WHEN 'fr' THEN 'MEL' END AS label,
       CASE lang WHEN 'en' THEN shard END AS shard,
       CASE lang WHEN 'en' THEN 39 END AS shard_total,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN CAST(doc_id AS INTEGER) END AS ordinal,
       CASE WHEN lang IN ('en', 'de', 'fr') THEN 'jpg' END AS ext,
       CASE WHEN lang = 'fr' AND doc_id % 3 = 0 THEN 'name disagrees' WHEN lang NOT IN ('en', 'de', 'fr') THEN 'no rule' END AS path_problem
FROM laid""",
)
def parse_paths(t):
    number = F.col("doc_id").cast("string")
    shard = F.lpad(F.regexp_replace("source", "src", ""), 5, "0")
    name = F.when(F.pmod("doc_id", F.lit(3)) == 0, "NEV").otherwise("MEL")
    path = (
        F.when(F.col("lang") == "en", F.concat(F.lit("pmc_vqa/train-"), shard, F.lit("-of-00039/pmc_train_"), number, F.lit(".jpg")))
        .when(F.col("lang") == "de", F.concat(F.lit("oral_images/benign_lesions/"), number, F.lit(".jpg")))
        .when(F.col("lang") == "fr", F.concat(F.lit("fluo_sc/CLI/MEL/CLI_"), name, F.lit("_"), number, F.lit(".jpg")))
        .otherwise(F.concat(F.lit("elsewhere/"), number, F.lit(".jpg")))
    )
    found = parse_path(t.documents.select("doc_id", path.alias("path")))
    return found.select("doc_id", "origin", "modality", "label", "shard", "shard_total", "ordinal", "ext", "path_problem")


@query(
    "M2",
    r"""
SELECT page_id, nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 1), '') AS host,
       nullif(regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 2), '') AS lang,
       TRY_CAST(regexp_extract(url, '^https?://([^/]+)/([a-z]{2})/(\d+)(.*)$', 3) AS BIGINT) AS ordinal
FROM pages""",
)
def parse_url(t):
    return pages_addresses(t.pages).select("page_id", "host", "lang", "ordinal")


@query(
    "M3",
    """
SELECT doc_id, CASE WHEN text IS NULL OR octet_length(encode(text)) = 0 THEN 'empty'
                    WHEN lang IS NULL OR lang = '' THEN 'no lang'
                    WHEN n_chars IS NULL OR n_chars <> length(text) THEN 'length differs'
                    WHEN octet_length(encode(text)) <> n_chars THEN 'bytes differ'
               END AS reason
FROM documents""",
)
def validate_docs(t):
    checks = [
        ("empty", F.octet_length("text") == 0),
        ("no lang", F.coalesce(F.col("lang") == "", F.lit(True))),
        ("length differs", F.char_length("text") != F.col("n_chars")),
        ("bytes differ", F.octet_length("text") != F.col("n_chars")),
    ]
    return validate(t.documents, checks).select("doc_id", "reason")


@query(
    "M4",
    f"""
WITH {DOCS}
SELECT lang, count(*) AS n_rows, CAST(sum(size) AS BIGINT) AS n_bytes FROM docs GROUP BY lang""",
)
def manifest_roundtrip(t):
    out = scratch_path(t.spark, "manifest")
    docs = documents_manifest(t.documents)
    write_manifest(docs, out, partition="lang", order=("doc_id", "path"))
    return class_inventory(t.spark.read.schema(docs.schema).parquet(out), ["lang"])


# Declared size is the number of characters and payloads are the texts that have
# a label, so texts beyond ASCII come out as of wrong size, unlabelled as missing.
@query(
    "M5",
    """
WITH declared AS (
  SELECT doc_id, sha256(text) AS oid, n_chars AS size FROM documents),
payloads AS (
  SELECT doc_id, sha256(text) AS actual_oid, octet_length(encode(text)) AS actual_size
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
SELECT d.doc_id, CASE WHEN p.actual_size IS NULL THEN 'missing'
                      WHEN p.actual_size <> d.size THEN 'wrong size'
                      WHEN p.actual_oid <> d.oid THEN 'wrong hash'
                      ELSE 'ok' END AS status
FROM declared d LEFT JOIN payloads p ON p.doc_id = d.doc_id""",
)
def verify_docs(t):
    declared = t.documents.select("doc_id", F.sha2("text", 256).alias("oid"), F.col("n_chars").alias("size"))
    stored = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi").select(
        "doc_id", F.sha2("text", 256).alias("actual_oid"), F.octet_length("text").alias("actual_size")
    )
    return verify_payloads(declared, stored, key="doc_id")
