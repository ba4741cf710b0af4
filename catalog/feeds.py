"""Sources that grow while a stream reads them, made from whole tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline.sources import sinks
from touchline.streaming import sessions, state

#: Parts in which a table arrives.
PARTS = 4
FIRST, LAST = "2024-01-01", "2024-02-01"


def part_by_time(time: str, parts: int = PARTS) -> Column:
    """The part in which a row comes: months from ``FIRST`` to ``LAST`` are cut evenly."""
    def at(day: str) -> Column:
        return F.unix_timestamp(F.lit(day).cast("timestamp"))

    share = (F.unix_timestamp(F.col(time).cast("timestamp")) - at(FIRST)) / (at(LAST) - at(FIRST))
    return F.least(F.greatest(F.floor(share * parts), F.lit(0)), F.lit(parts - 1)).cast("int")


class Feed:
    """A folder that a stream reads, filled part by part from a table with a column ``part``."""

    def __init__(self, spark: SparkSession, name: str, rows: DataFrame,
                 sentinel: DataFrame | None = None):
        self.spark = spark
        self.rows = sinks.materialise(rows, f"{name}-rows")
        self.schema = rows.drop("part").schema
        self.sentinel = sentinel
        self.folder = sinks.shared_folder(spark, name)

    def put(self, part: int) -> None:
        rows = self.rows.where(F.col("part") == part).drop("part")
        rows.write.mode("append").parquet(self.folder)

    def end(self) -> None:
        """What comes last, so that the watermark passes everything before it."""
        if self.sentinel is not None:
            self.sentinel.write.mode("append").parquet(self.folder)

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self.folder)

    def far_row(self, time: str, when: str = "2030-01-01") -> None:
        """A sentinel that is null but for its time."""
        values = [F.lit(when).cast(f.dataType).alias(f.name) if f.name == time
                  else F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
        self.sentinel = self.spark.range(1).select(*values)


def play(feeds: list[Feed], start: Callable[[], StreamingQuery], parts: int = PARTS,
         empty_batches: bool = True) -> None:
    """Let every part arrive, then run the query over what is new; last come the sentinels.

    Without ``empty_batches`` what a part's watermark lets out comes with the next part; after the
    sentinels everything does.
    """
    spark = feeds[0].spark
    for part in range(parts):
        for feed in feeds:
            feed.put(part)
        with nullcontext() if empty_batches else state.without_empty_batches(spark):
            sessions.finish(start())
    if any(feed.sentinel is not None for feed in feeds):
        for feed in feeds:
            feed.end()
        sessions.finish(start())
