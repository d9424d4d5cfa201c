"""Chat transcripts from event logs, by DataFrame functions alone.

A log holds streamed pieces (``delta``), replacements (``edit``) and new tries
(``regenerate``) of messages. Events are partitioned by conversation, sorted by
sequence number and folded to one text for each message; the messages are then
rendered with a template whose control strings cannot come from a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The template. A turn is HEAD role MID text TAIL.
HEAD, MID, TAIL = "### ", ": ", "</turn>\n"


def escaped(text: Column) -> Column:
    """The text without ``###`` and ``</turn>``; ``unescaped`` gives it back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(doubled, F.lit("###"), F.lit("\\h")), F.lit("</turn>"), F.lit("\\t"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit("\\c"))


def unescaped(text: Column) -> Column:
    """Undoes ``escaped`` and ``escaped_role``: between double backslashes, a single one starts a mark."""

    def plain(part: Column) -> Column:
        for mark, meaning in (("\\h", "###"), ("\\t", "</turn>"), ("\\c", ":")):
            part = F.replace(part, F.lit(mark), F.lit(meaning))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def fold(events: DataFrame) -> DataFrame:
    """conv_id, message, role, text: final messages of events (conv_id, seq, message, role, kind, text).

    ``delta`` appends its text, ``edit`` puts its text in place of all before it,
    ``regenerate`` starts the message anew with its text, and takes back all
    events so far of later messages of the conversation, which answered the old
    one. A message all of whose events were taken back is gone. Null texts and
    roles are empty; a message has the role of its last event. Events of equal
    seq go by kind, text and role; a null seq comes first. Events that repeat whole (all of
    conversation, message, seq, kind, text, role) count once, as a log may deliver an event twice. Null conv_id is a conversation of its
    own, a null message sorts first. Any other kind counts as ``delta``. No events
    give no messages. Other columns are not looked at.
    """
    parts = [F.coalesce(c, F.lit("")).alias(c) for c in ("kind", "text", "role")]
    rows = events.select("conv_id", "message", F.struct(F.col("seq").cast("bigint").alias("seq"), *parts).alias("e"))
    steps = rows.groupBy("conv_id", "message").agg(
        F.array_sort(F.collect_set("e")).alias("steps"),  # an event delivered twice is one event
        F.max(F.when(F.col("e.kind") == "regenerate", F.col("e.seq"))).alias("anew"),
    )
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    valid = steps.withColumn("void", F.max("anew").over(before)).select(
        "conv_id", "message", F.expr("if(void IS NULL, steps, filter(steps, e -> e.seq > void))").alias("steps")
    )
    resets = F.expr("array_max(filter(steps, e -> e.kind IN ('edit', 'regenerate')))")
    left = valid.filter(F.size("steps") > 0).withColumn("reset", resets)
    lasting = F.expr("if(reset IS NULL, steps, filter(steps, e -> e >= reset))")
    return left.select(
        "conv_id",
        "message",
        F.element_at("steps", -1)["role"].alias("role"),
        F.array_join(F.transform(lasting, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss: the transcript of each conversation's messages, in their order.

    ``loss`` lists (begin, chars), in code points of ``formatted``, of the texts of
    role ``learn``: the text without its header and tail, as escaped in it.
    """
    cell = F.concat(F.lit(HEAD), escaped_role(F.col("role")), F.lit(MID))
    rows = messages.select("conv_id", "message", "role", cell.alias("head"), escaped(F.col("text")).alias("body"))
    chars = F.char_length("head") + F.char_length("body") + len(TAIL)
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(chars.cast("bigint")).over(before), F.lit(0).cast("bigint"))
    placed = rows.withColumn("start", start)
    span = F.struct((F.col("start") + F.char_length("head")).alias("begin"), F.char_length("body").cast("bigint").alias("chars"))
    turn = F.struct("message", F.concat("head", "body", F.lit(TAIL)).alias("turn"))
    return (
        placed.groupBy("conv_id")
        .agg(
            F.array_sort(F.collect_list(turn)).alias("turns"),
            F.array_sort(F.collect_list(F.when(F.col("role") == learn, span))).alias("loss"),
        )
        .select("conv_id", F.array_join(F.col("turns")["turn"], "").alias("formatted"), "loss")
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turn_no (from 0), role, text, learned of each turn of ``render``'s output."""
    turns = formatted.select(
        "conv_id", F.posexplode(F.split("formatted", "</turn>\n", -1)).alias("turn_no", "turn"), F.size("loss").alias("n")
    ).filter(F.col("turn") != "")
    before = Window.partitionBy("conv_id").orderBy("turn_no").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum((F.char_length("turn") + len(TAIL)).cast("bigint")).over(before), F.lit(0).cast("bigint"))
    mid = F.instr("turn", MID)
    parsed = turns.withColumn("start", start).select(
        "conv_id",
        "turn_no",
        F.expr(f"substring(turn, {len(HEAD) + 1}, instr(turn, '{MID}') - {len(HEAD) + 1})").alias("role"),
        F.expr(f"substring(turn, instr(turn, '{MID}') + {len(MID)})").alias("text"),
        (F.col("start") + mid + len(MID) - 1).alias("begin"),
    )
    spans = formatted.select(F.col("conv_id").alias("_c"), F.explode("loss").alias("s")).select("_c", "s.*")
    spans = spans.withColumnsRenamed({"begin": "_begin", "chars": "_chars"})
    masked = parsed.join(spans, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("begin") == F.col("_begin")), "left")
    return masked.select(
        "conv_id",
        "turn_no",
        unescaped(F.col("role")).alias("role"),
        unescaped(F.col("text")).alias("text"),
        F.when(F.col("_begin").isNotNull(), unescaped(F.expr("substring(text, 1, int(_chars))"))).alias("learned"),
    )


def log_of(conversations: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as an event log ``fold`` turns back into it.

    Assistant turns are a first try, a regeneration and two streamed pieces; other turns a
    draft and its edit. Turns are ordered by turn, role and text, so turns of one
    number stay apart; nulls sort first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select(
        "conv_id",
        F.row_number().over(order).cast("bigint").alias("message"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("t"),
    )
    half = F.floor(F.char_length("t") / 2).cast("int")
    head, tail = F.substring("t", F.lit(1), half), F.substring("t", half + 1, F.char_length("t"))

    def event(step: int, kind: str, text: Column) -> Column:
        return F.struct(F.lit(step).alias("step"), F.lit(kind).alias("kind"), text.alias("text"))

    tried = F.array(event(0, "delta", head), event(1, "regenerate", F.lit("")), event(2, "delta", head), event(3, "delta", tail))
    edited = F.array(event(0, "delta", head), event(1, "edit", F.col("t")))
    steps = rows.select("conv_id", "message", "role", F.explode(F.when(F.col("role") == "assistant", tried).otherwise(edited)).alias("s"))
    return steps.select("conv_id", "message", (F.col("message") * 4 + F.col("s.step")).alias("seq"), "role", "s.kind", "s.text")


def digests(turns: DataFrame) -> DataFrame:
    """n_turns, turns_sha256, loss_chars and loss_sha256 of each conversation of ``read_back``'s turns."""
    turn = F.struct("turn_no", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("t"), "learned")
    rows = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    learned = F.array_join(F.col("turns")["learned"], "")
    return rows.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.col("turns")["t"], ""), 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
    )
