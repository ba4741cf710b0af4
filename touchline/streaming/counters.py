"""Live counters of the matches being played.

Counters are additive, so the stream keeps them per day, match and player: the watermark can
drop a day's state once it has passed, and a match that runs over midnight is summed up when
the counters are read. Every update-mode batch is a folder of its own, overwritten when the
batch is retried; readers take the newest version of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators import metrics
from touchline.operators.events import of_known_players
from touchline.sources.sinks import latest_per_key

# Fixed value: interval of the micro-batches.
BATCH_SECONDS = 5
BATCH_INTERVAL = f"{BATCH_SECONDS} seconds"

_KEYS = ["day", "matchId", "playerId"]


def live_counts(events: DataFrame, delay: str = "1 day") -> DataFrame:
    """Streaming counters per (day, match, player); ``events`` carries a timestamp ``ts``."""
    marked = events.withWatermark("ts", delay)
    keys = [F.window("ts", "1 day").alias("span"), "matchId", "playerId"]
    counts = metrics.count_events(marked, metrics.all_counters(), keys)
    return counts.withColumn("day", F.col("span.start")).drop("span")


def trigger(once: bool) -> dict:
    """All that is there and stop, or a batch every few seconds."""
    return {"availableNow": True} if once else {"processingTime": BATCH_INTERVAL}


def write_batches(stream: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start an update-mode query that keeps each batch in its own folder."""
    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.outputMode("update").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def write_counts(events: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start a query that stores the counters of each batch of events in a folder of its own.

    They only ever add up, so no event is too late for them and no state is kept."""
    def store(batch: DataFrame, batch_id: int) -> None:
        counts = metrics.count_events(batch, metrics.all_counters())
        counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (events.writeStream.outputMode("append").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def added_up(batches: DataFrame) -> DataFrame:
    """One row of counters for each match and player."""
    return batches.groupBy(*metrics.KEYS).agg(*[F.sum(c).alias(c) for c in metrics.COUNTERS])


def read_counts(batches: DataFrame) -> DataFrame:
    """Metrics of everyone from the stored counters of all batches."""
    return metrics.with_ratios(added_up(batches))


def read_live_metrics(batches: DataFrame, players: DataFrame) -> DataFrame:
    """Current metrics of every known player from the stored batches."""
    newest = latest_per_key(batches, _KEYS)
    sums = newest.groupBy("matchId", "playerId").agg(
        *[F.sum(c).alias(c) for c in metrics.COUNTERS])
    return metrics.with_ratios(of_known_players(sums, players))
