"""End of a match in the stream.

A match is over when the header of the next match of its feed comes; if none comes, when a timeout has
passed. Its rows are then computed by the batch operators from the stored events and match records, for
everyone on the sheets whether or not they had an event, and handed on to the rating state.

An event that comes after its match was finished, or a header that closes it once more, makes it be
finished again over all its events: the later version of its rows is the right one. What is open when a
feed ends is finished by :func:`write_rest`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from touchline.operators import metrics, ratings, sheets
from touchline.plans.season import Season
from touchline.sources.sinks import latest_per_key, materialise
from touchline.streaming.counters import trigger

CLOSED = "matchId BIGINT, closed_ms BIGINT, reason STRING"


def _closed(rows: list[tuple]) -> Iterator[pd.DataFrame]:
    if rows:
        yield pd.DataFrame(rows, columns=["matchId", "closed_ms", "reason"])


def last_header(timeout_ms: int) -> Callable[..., Iterator[pd.DataFrame]]:
    """The match that is being played in a feed, and what is closed by the headers that come."""
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
             ) -> Iterator[pd.DataFrame]:
        match, since = state.get if state.exists else (None, None)
        if state.hasTimedOut:
            state.remove()
            yield from _closed([(match, since + timeout_ms, "timeout")])
            return
        headers = pd.concat(list(frames))
        if len(headers) > 1:
            headers = headers.sort_values(["at", "place", "wyId"], kind="stable")
        closed = []
        for other, at in zip(headers["wyId"].tolist(), headers["at"].tolist()):
            if match is None or other == match:
                match, since = other, at if since is None else max(at, since)
            elif at >= since:
                closed.append((match, at, "header"))
                match, since = other, at
            else:  # came late: the match that follows it has already begun
                closed.append((other, since, "header"))
        state.update((match, since))
        state.setTimeoutTimestamp(since + timeout_ms)
        yield from _closed(closed)

    return step


def closed_matches(headers: DataFrame, timeout: str, delay: str) -> DataFrame:
    """(matchId, closed_ms, reason) of a stream of headers (``feed``, ``wyId``, ``header_ts``).

    A column ``place`` orders headers of the same time, else their ids do. Feeds are independent of each
    other: a header closes the match before it in its own feed. One that comes more than ``delay``
    behind others is dropped.
    """
    wait = int(pd.Timedelta(timeout).total_seconds() * 1000)
    # The time is part of the condition, so that it stays above the watermark: a row without a feed
    # still tells how late it is.
    marked = headers.withWatermark("header_ts", delay).where(
        "IF(header_ts IS NULL, false, feed IS NOT NULL AND wyId IS NOT NULL)")
    place = F.col("place") if "place" in headers.columns else F.lit(0)
    ordered = marked.select("feed", "wyId", place.alias("place"), "header_ts",
                            F.unix_millis("header_ts").alias("at"))
    # State comes with the rows in batches, not by a call for each feed.
    return ordered.groupBy("feed").applyInPandasWithState(
        last_header(wait), CLOSED, "matchId BIGINT, at BIGINT", "append",
        GroupStateTimeout.EventTimeTimeout)


def to_finish(closed: DataFrame, events: DataFrame) -> DataFrame:
    """Matches to finish: those that close, and those of which an event comes (``closed`` false),
    which are finished again if they were before."""
    return closed.select("matchId", F.lit(True).alias("closed")).unionByName(
        events.select("matchId", F.lit(False).alias("closed")))


def finished_rows(season: Season, over: DataFrame) -> DataFrame:
    """Career rows of the given matches only; each side is cut down to them first."""
    ids = over.select("matchId").distinct()

    def cut(frame: DataFrame) -> DataFrame:
        return frame.join(ids, "matchId", "left_semi")

    dates = season.match_dates if season.match_dates is not None else sheets.match_dates(season.matches)
    return ratings.career_rows(sheets.appearances(cut(season.sheets)),
                               metrics.all_metrics(cut(season.events)), cut(dates))


def write_finished(stream: DataFrame, season: Callable[[], Season],
                   finished: Callable[[], DataFrame], path: str, checkpoint: str,
                   once: bool = True) -> StreamingQuery:
    """Start a query that stores the rows of finished matches, one folder per batch.

    ``stream`` is made by :func:`to_finish`. ``season`` and ``finished`` (the rows stored so far) are
    asked for with every batch, so that they are what has been stored by then.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        # Written once: a batch is run again, state and all, by each part of a plan that reads it.
        matches = materialise(
            batch.groupBy("matchId").agg(F.max("closed").alias("closed")), "to-finish")
        again = matches.where("NOT closed").join(finished(), "matchId", "left_semi")
        over = materialise(matches.where("closed").unionByName(again), "over")
        rows = finished_rows(season(), over).withColumn("arrival", F.current_timestamp())
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (stream.writeStream.outputMode("append").foreachBatch(store)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once)).start())


def write_rest(season: Season, finished: DataFrame, path: str, number: int) -> None:
    """Store the rows of all matches that have not been finished, in a folder with the negative
    ``number``, apart from the batches of the stream."""
    dates = season.match_dates if season.match_dates is not None else sheets.match_dates(season.matches)
    rest = dates.select("matchId").join(finished.select("matchId").distinct(), "matchId", "left_anti")
    finished_rows(season, rest).withColumn("arrival", F.current_timestamp()).write.mode(
        "overwrite").parquet(f"{path}/batch_id={number}")


def newest_rows(batches: DataFrame) -> DataFrame:
    """Career rows as they were last computed."""
    return latest_per_key(batches, ["matchId", "playerId"], "arrival")
