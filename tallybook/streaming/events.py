"""Streams with event time. State is kept only as long as rows that need it can still come."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class StreamReport:
    """What a run read: rows in, rows too late to be used, and rows of state after each batch."""

    n_read: int
    n_late: int
    state_rows: tuple[int, ...]


def _watermarked(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """A watermark needs instants: times without a zone are taken in the session's zone."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)


def first_seen(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row to arrive of each combination of ``keys``.

    A key is remembered until the watermark (the latest ``time`` seen less ``delay``) has passed its row's time plus ``delay``;
    repeats that come within that are dropped, and the state is as large as the keys of so long a
    stretch, not of all time. Rows older than the watermark are dropped and counted as late. Null keys
    equal each other. Rows with a null time are never late and their key is not forgotten, so
    they are better taken out before.
    """
    return _watermarked(stream, time, delay).dropDuplicatesWithinWatermark(list(keys))


def closed_sessions(
    stream: DataFrame, keys: Sequence[str], time: str, gap: str, delay: str, measures: Sequence[Column] = ()
) -> DataFrame:
    """Keys, session_start, session_end, n_rows and ``measures`` of sessions that nothing can extend any more.

    Rows of equal keys with at most ``gap`` between them are one session, which ends ``gap`` after its last
    row. It is given out once the watermark has reached its end, and its state is dropped. Null keys are one
    group; rows with a null time are in no session.
    """
    opened = F.session_window(time, gap).alias("session")
    # Sessions are merged from parts made in each task, so a busy key is one row for each task and session.
    found = _watermarked(stream, time, delay).groupBy(opened, *keys).agg(F.count(F.lit(1)).alias("n_rows"), *measures)
    starts = [F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end")]
    return found.select(*keys, *starts, *[c for c in found.columns if c not in ("session", *keys)])


def run_to_table(stream: DataFrame, out: str, checkpoint: str) -> StreamReport:
    """Reads all that is there now, batch by batch, into a Parquet table at ``out``, and stops.

    Called again with the same ``checkpoint`` it goes on where it stopped: what was written is neither lost nor written
    twice, state included. The report is of this run only.
    """
    query = (
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    steps = query.recentProgress
    states = [[s for s in p["stateOperators"]] for p in steps]
    return StreamReport(
        sum(p["numInputRows"] for p in steps),
        sum(s["numRowsDroppedByWatermark"] for ops in states for s in ops),
        tuple(sum(s["numRowsTotal"] for s in ops) for ops in states),
    )


def write_slices(df: DataFrame, where: str, time: str, cuts: Sequence[object], again: int = 0) -> None:
    """Writes ``df`` below ``where`` in slices of ``time``, one after another, as a log would arrive.

    ``cuts`` are the times at which a new slice begins. ``again`` delivers rows of the last so many seconds before a cut a second
    time, in the slice after it. A slice is one file, so cut as fine as one task can write. Rows with a null time come with the first.
    """
    edges = [None, *cuts, None]
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        at = F.col(time)
        inside = F.lit(True)
        if low is not None:
            inside = inside & (at >= F.lit(low))
        if high is not None:
            inside = inside & (F.coalesce(at < F.lit(high), F.lit(i == 0)))
        rows = df.filter(inside)
        if low is not None and again:
            late = F.lit(low).cast("timestamp")
            rows = rows.unionByName(df.filter((at < late) & (at >= late - F.make_interval(secs=F.lit(again)))))
        rows.coalesce(1).write.mode("append").parquet(where)


def read_slices(spark: SparkSession, where: str, schema: str) -> DataFrame:
    """What ``write_slices`` wrote as a stream, one slice a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(where)
