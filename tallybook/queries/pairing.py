"""P1-P4 on the given tables: a user turn and the assistant turn after it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.operators import pairing as p
from tallybook.queries.registry import query

SQL_TURNS = """turns AS (
  SELECT conv_id, turn, role, sha256(text) AS oid, CAST(octet_length(encode(text)) AS BIGINT) AS size FROM conversations),
asked AS (SELECT *, turn AS slot FROM turns WHERE role = 'user'),
answered AS (SELECT *, turn - 1 AS slot FROM turns WHERE role = 'assistant')"""


def _turns(t, role: str, shift: int) -> DataFrame:
    return t.conversations.filter(F.col("role") == role).select(
        "conv_id",
        (F.col("turn") - shift).alias("slot"),
        "turn",
        F.sha2("text", 256).alias("oid"),
        F.octet_length("text").cast("bigint").alias("size"),
    )


def _pairs(t, keep) -> DataFrame:
    return p.matched_pairs(_turns(t, "user", 0), _turns(t, "assistant", 1), ["conv_id", "slot"], ["turn"], keep)


@query(
    "P1",
    f"""
WITH {SQL_TURNS}
SELECT a.conv_id, a.slot, a.oid AS left_oid, b.oid AS right_oid, a.size AS left_size, b.size AS right_size,
       count(*) OVER (PARTITION BY a.conv_id, a.slot) AS n_right
FROM asked a JOIN answered b ON b.conv_id = a.conv_id AND b.slot = a.slot""",
)
def turn_pairs(t):
    return _pairs(t, ["oid", "size"])


# Answers keyed by conversation alone: most conversations have several.
@query(
    "P1",
    f"""
WITH {SQL_TURNS}, numbered AS (SELECT conv_id, turn, count(*) OVER (PARTITION BY conv_id) AS n_right FROM answered)
SELECT * FROM numbered WHERE n_right > 1""",
)
def repeated_answers(t):
    return p.repeated_partners(_turns(t, "assistant", 1).select("conv_id", "turn"), ["conv_id"])


@query(
    "P2",
    f"""
WITH {SQL_TURNS}
SELECT CASE WHEN b.slot IS NULL THEN 'left only' WHEN a.slot IS NULL THEN 'right only' ELSE 'both' END AS status,
       count(*) AS n
FROM (SELECT DISTINCT conv_id, slot FROM asked) a
FULL JOIN (SELECT DISTINCT conv_id, slot FROM answered) b ON b.conv_id = a.conv_id AND b.slot = a.slot
GROUP BY 1""",
)
def turn_coverage(t):
    role = F.col("role")
    side = F.when(role == "user", "left").when(role == "assistant", "right")
    slot = F.when(role == "assistant", F.col("turn") - 1).otherwise(F.col("turn"))
    turns = t.conversations.select("conv_id", "role", slot.alias("slot"))
    return p.pair_coverage(turns, ["conv_id", "slot"], side)


@query(
    "P3",
    f"""
WITH {SQL_TURNS}
SELECT a.conv_id, a.turn, 'left' AS side FROM asked a ANTI JOIN answered b ON b.conv_id = a.conv_id AND b.slot = a.slot
UNION ALL
SELECT b.conv_id, b.turn, 'right' AS side FROM answered b ANTI JOIN asked a ON b.conv_id = a.conv_id AND b.slot = a.slot""",
)
def unanswered_turns(t):
    asked, answered = _turns(t, "user", 0), _turns(t, "assistant", 1)
    return p.unpaired(asked, answered, ["conv_id", "slot"]).select("conv_id", "turn", "side")


@query(
    "P4",
    f"""
WITH {SQL_TURNS}
SELECT a.conv_id, count(*) AS n_pairs, round(avg(CASE WHEN a.size <> 0 THEN b.size / a.size END), 6) AS mean_ratio,
       count(*) FILTER (b.size < a.size) AS n_right_smaller
FROM asked a JOIN answered b ON b.conv_id = a.conv_id AND b.slot = a.slot GROUP BY a.conv_id""",
)
def reply_length_ratio(t):
    return p.pair_size_ratio(_pairs(t, ["size"]), ["conv_id"]).withColumn("mean_ratio", F.round("mean_ratio", 6))
