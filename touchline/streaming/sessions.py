"""Matches as sessions: a match is final when its events have stopped for a while.

Events are credited to the match they name, however late they come; sessions that events later than
the watermark belong to, or that are open when a feed ends, are made whole from the stored feed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators import metrics
from touchline.sources import files, records
from touchline.streaming.counters import trigger
from touchline.streaming.joined import distinct_records

#: Number of events in a session.
EVENTS = "events"


def match_sessions(events: DataFrame, gap: str, delay: str) -> DataFrame:
    """Final counters per (match, player), emitted once the player's match has gone quiet."""
    marked = events.withWatermark("ts", delay)
    keys = [F.session_window("ts", gap).alias("session"), "matchId", "playerId"]
    counts = metrics.count_events(marked, {**metrics.all_counters(), EVENTS: "true"}, keys)
    return metrics.with_ratios(counts).select(
        F.col("session.start").alias("first_ts"), F.col("session.end").alias("closed_ts"),
        "matchId", "playerId", EVENTS, *metrics.COUNTERS, *metrics.ratios())


def whole_sessions(closed: DataFrame, events: DataFrame, gap: str) -> DataFrame:
    """The streamed sessions, made whole from the stored ``events``.

    A player's sessions in a match stay as they were streamed if their counters and numbers of events
    add up to those of all stored events. Otherwise some are open, or events came late, and all of that
    player's sessions in that match are made anew; only those events are read into sessions.
    """
    counters = {**metrics.all_counters(), EVENTS: "true"}
    keys = metrics.KEYS
    streamed = closed.groupBy(*keys).agg(F.struct(*[F.sum(c).alias(c) for c in counters])
                                         .alias("streamed"))
    stored = metrics.count_events(events, counters).select(
        *keys, F.struct(*[F.col(c) for c in counters]).alias("stored"))
    both = stored.join(streamed, keys, "left")
    same = both.where("stored = streamed").select(*keys)
    differing = both.where("streamed IS NULL OR stored <> streamed").select(*keys)
    again = match_sessions(events.join(differing, keys, "left_semi"), gap, "0 seconds")
    return closed.join(same, keys, "left_semi").unionByName(again.select(closed.columns))


def match_intake(lines: DataFrame, again_within: str = "1 day") -> DataFrame:
    """Match records of a line stream with parsed dates, and their ``arrival``.

    ``lines`` carries ``value`` and the timestamp ``ts`` it arrived at. A record sent again unchanged
    within ``again_within`` is dropped. Every version is kept, readers take the newest
    (``records.newest_matches``). A record that goes back to an earlier version within that time is
    taken for that version sent again.
    """
    found = records.read_matches(lines).withColumnRenamed("ts", "arrival")
    return distinct_records(found, "wyId", "arrival", again_within)


def append_to(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start an append-mode query into a parquet table; files are committed exactly once."""
    return (stream.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def append_batches(stream: DataFrame, path: str, checkpoint: str, once: bool = True
                   ) -> StreamingQuery:
    """Start an append-mode query that keeps each batch in its own folder. A batch that is retried
    after it was stored is left as it is."""
    def store(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        if not files.is_complete(batch.sparkSession, folder):
            batch.write.mode("overwrite").parquet(folder)

    return (stream.writeStream.outputMode("append").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def finish(query: StreamingQuery) -> None:
    """Wait for a run-to-the-end query; the checkpoint lets the next run go on from there."""
    query.awaitTermination()


def stop(query: StreamingQuery) -> None:
    """Let the current batch commit, then stop."""
    query.processAllAvailable()
    query.stop()
