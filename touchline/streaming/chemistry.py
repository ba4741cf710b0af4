"""Chemistry of a stream: changes are stored by match, values are summed when read.

With every batch of rating lines, the changes of the matches in it are computed from all lines
stored for those matches. So it doesn't matter how late or in how many parts the lines of a match
come, and there is no state and no watermark that could drop one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.operators.chemistry import chemistry_deltas
from touchline.streaming.counters import trigger


def deltas_of(lines: DataFrame, over: DataFrame) -> DataFrame:
    """Signed change per pair in the given matches."""
    ids = over.select("matchId").distinct()
    return chemistry_deltas(lines.join(ids, "matchId", "left_semi"))


def write_deltas(stream: DataFrame, lines: Callable[[], DataFrame], path: str, checkpoint: str,
                 once: bool = True) -> StreamingQuery:
    """Start a query that stores the changes, one folder per batch.

    ``stream`` reads the stored rating lines, ``lines`` gives those that hold by now. Every match of
    a batch also gets a row without players, so that changes it no longer has are superseded.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        # Matches of a batch lie close together: their dates prune the scan of the lines.
        first, last = batch.agg(F.min("match_date"), F.max("match_date")).first()
        near = lines().where(F.col("match_date").between(F.lit(first), F.lit(last)))
        marks = batch.select("matchId").distinct()
        deltas_of(near, batch).unionByName(marks, allowMissingColumns=True).write.mode(
            "overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.outputMode("append").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def newest_batches(batches: DataFrame) -> DataFrame:
    """The rows that were last written for each match."""
    newest = batches.groupBy("matchId").agg(F.max("batch_id").alias("batch_id"))
    return batches.join(newest, ["matchId", "batch_id"], "left_semi")


def newest_deltas(batches: DataFrame) -> DataFrame:
    """Changes of every match as they were last computed."""
    return newest_batches(batches).where("player1 IS NOT NULL").drop("batch_id")
