"""Events beside the header of their match while both arrive.

Two streams with watermarks are joined: an event keeps waiting for its header, and a header for its
events, no longer than the bounds say, so what is held is bounded by time. Headers may come before or
after the events of their match. An event whose header doesn't come in time is passed on without one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER = ["status", "match_date", "label", "gameweek", "venue"]


def record_digest(record: list[str]) -> Column:
    """What tells two versions of a record apart."""
    return F.sha2(F.to_json(F.struct(*record)), 256)


def distinct_records(records: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """A stream of records without those sent again unchanged within ``delay``.

    A changed record has another digest and passes, and so does one that comes back after ``delay``.
    Where a record stands in its batch (``place``) is no part of it.
    """
    fields = [c for c in records.columns if c not in (time, "place")]
    marked = records.withColumn("digest", record_digest(fields)).withWatermark(time, delay)
    return marked.dropDuplicatesWithinWatermark([key, "digest"]).drop("digest")


def with_match_stream(events: DataFrame, headers: DataFrame, header_first: str = "3 hours",
                      header_last: str = "3 hours", delay: str = "10 minutes") -> DataFrame:
    """Streaming events (``ts``, ``matchId``) beside the header (``header_ts``, ``wyId``) that came at
    most ``header_first`` before or ``header_last`` after them; left outer.

    ``delay`` is how much later than others a row may arrive. A header sent again unchanged counts
    once; each version of a changed one gives a row (see :func:`newest_header`).
    """
    known = distinct_records(
        headers.select("header_ts", F.col("wyId").alias("header_match"), *HEADER),
        "header_match", "header_ts", delay)
    waiting = events.withWatermark("ts", delay)
    met = ((F.col("matchId") == F.col("header_match"))
           & (F.col("header_ts") >= F.col("ts") - F.expr(f"INTERVAL {header_first}"))
           & (F.col("header_ts") <= F.col("ts") + F.expr(f"INTERVAL {header_last}")))
    return waiting.join(known, met, "left_outer").drop("header_match")


def newest_header(rows: DataFrame, event: list[str]) -> DataFrame:
    """One row for each event, with the version of its header that came last."""
    others = [c for c in rows.columns if c not in event]
    newest = F.max_by(F.struct(*others), F.coalesce("header_ts", F.lit(0).cast("timestamp")))
    return rows.groupBy(*event).agg(newest.alias("r")).select(*event, "r.*")
