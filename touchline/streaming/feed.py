"""Lines of a feed as they arrive, stored once for all that is made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.sources import files, numbering
from touchline.streaming.counters import trigger


def write_lines(lines: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start a query that stores every batch of lines with the time it arrived at (``ts``) and their
    ``place`` in it: by file and line for text files, else in the order of the source's partitions.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/batch_id={batch_id}"
        if files.is_complete(batch.sparkSession, folder):
            return
        if set(numbering.SPLIT) <= set(batch.columns):
            placed = numbering.numbered(batch, "place")
        else:
            placed = batch.withColumn("place", F.monotonically_increasing_id())
        placed.select(F.current_timestamp().alias("ts"), "place", "value").write.mode(
            "overwrite").parquet(folder)

    return (lines.writeStream.outputMode("append").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())
