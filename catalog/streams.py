"""The registered streams. Each one lets its tables arrive in parts and runs over every part before the
next comes, so that state, watermarks and checkpoints carry over; what is returned is what the stream
itself has written."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.feeds import PARTS, Feed, part_by_time, play
from catalog.queries import (
    HEADER,
    HISTORY,
    KEYS,
    answer_season,
    bodies,
    query,
    request_lines,
    rounded,
)
from touchline.operators import chemistry, events, metrics
from touchline.plans.season import Season
from touchline.sources import numbering, records, sinks
from touchline.sources.bridge import DAYS_APART, Bridge
from touchline.sources.snapshots import Kept, Snapshots
from touchline.streaming import chemistry as chemistry_stream
from touchline.streaming import counters, finalise, joined, late, ratings, sessions, state
from touchline.streaming import requests as request_stream

#: How late events may be in the streams below.
DELAY = "2 days"
#: One event in so many comes a part later than its time says.
SLOW_EVENTS = 11


def timed_events(b: Bridge) -> DataFrame:
    """All events with an instant, and the part they come in; some come a part too late."""
    slow = F.col("event_id") % SLOW_EVENTS == 5
    part = F.least(part_by_time("ts") + slow.cast("int"), F.lit(PARTS - 1))
    return b.events.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("part", part)


def event_feed(b: Bridge) -> Feed:
    feed = Feed(b.spark, "event-feed", timed_events(b))
    feed.far_row("ts")
    return feed


def _out(b: Bridge, purpose: str) -> tuple[str, str]:
    folder = sinks.shared_folder(b.spark, purpose)
    return f"{folder}/data", f"{folder}/checkpoint"


@query
def stream_live_metrics(b: Bridge) -> DataFrame:
    feed = Feed(b.spark, "events", timed_events(b))
    path, checkpoint = _out(b, "live")
    # Counters take every event: the delay is longer than the table.
    play([feed], lambda: counters.write_batches(
        counters.live_counts(feed.stream(), "100 days"), path, checkpoint))
    batches = b.spark.read.parquet(path)
    return rounded(counters.read_live_metrics(batches, b.players), *metrics.ratios())


@query
def stream_events_with_match(b: Bridge) -> DataFrame:
    """Events and headers as two streams. Headers come up to six days before or after the first day of
    their match, each twice; those of one match in ten never come."""
    known = events.of_known_players(timed_events(b), b.players).select(
        "event_id", *KEYS, "eventId", "ts", "part")
    shift = F.expr("make_dt_interval(CAST(wyId % 13 - 6 AS INT))")
    sent = b.season.matches.where("wyId % 10 != 3").select(
        (F.col("match_date").cast("timestamp") + shift).alias("header_ts"), "wyId", *joined.HEADER)
    sent = sent.withColumn("part", part_by_time("header_ts"))
    event_rows = Feed(b.spark, "event-feed", known)
    headers = Feed(b.spark, "header-feed", sent.unionByName(sent))
    event_rows.far_row("ts")
    headers.far_row("header_ts")
    path, checkpoint = _out(b, "joined")
    with state.newest_in_memory(b.spark):
        play([event_rows, headers], lambda: sessions.append_to(
            joined.with_match_stream(event_rows.stream(), headers.stream(), "12 days", "6 days",
                                     "20 days"), path, checkpoint), empty_batches=False)
    rows = joined.newest_header(b.spark.read.parquet(path), ["event_id", *KEYS, "eventId", "ts"])
    return rows.drop("ts", "header_ts")


@query
def stream_late_events(b: Bridge) -> DataFrame:
    """Events behind the watermark, with the batch that refused them."""
    feed = event_feed(b)
    path, checkpoint = _out(b, "gate")
    play([feed], lambda: late.write_split(feed.stream(), path, checkpoint, DELAY))
    rows = late.read_split(b.spark, path, feed.schema).where("late")
    return rows.select("event_id", *KEYS, "batch_id")


def streamed_sessions(b: Bridge) -> tuple[DataFrame, DataFrame]:
    """Sessions that the stream has closed over the accepted events, and all events by ``late``. A
    matchday of the test data lasts six days."""
    feed = event_feed(b)
    gate, gate_checkpoint = _out(b, "gate")
    path, checkpoint = _out(b, "sessions")

    def step():
        sessions.finish(late.write_split(feed.stream(), gate, gate_checkpoint, DELAY))
        accepted = late.accepted_stream(b.spark, gate, feed.schema)
        return sessions.append_to(
            sessions.match_sessions(accepted, "6 days", DELAY), path, checkpoint)

    play([feed], step)
    split = late.read_split(b.spark, gate, feed.schema).where("matchId IS NOT NULL")
    return b.spark.read.parquet(path), split


def _as_rows(b: Bridge, found: DataFrame) -> DataFrame:
    instants = {c: F.col(c).cast("timestamp_ntz") for c in ("first_ts", "closed_ts")}
    return events.of_known_players(found, b.players).withColumns(instants).drop(
        *metrics.ratios(), sessions.EVENTS)


@query
def stream_match_sessions(b: Bridge) -> DataFrame:
    """Sessions as the stream has closed them, nothing else: late events are not in them."""
    return _as_rows(b, streamed_sessions(b)[0])


@query
def stream_whole_sessions(b: Bridge) -> DataFrame:
    """The streamed sessions, made whole where events came late."""
    closed, split = streamed_sessions(b)
    return _as_rows(b, sessions.whole_sessions(closed, split, "6 days"))


@query
def stream_reconciled(b: Bridge) -> DataFrame:
    """What was counted in the stream and what came late, against all stored events."""
    closed, split = streamed_sessions(b)
    return events.of_known_players(late.reconciled(closed, split.where("late"), split), b.players)


@query
def stream_match_intake(b: Bridge) -> DataFrame:
    """Match lines arrive in turns, the same record again and again, one in three later with another
    label. Every version is stored once."""
    sent = b.season.matches.withColumn("ts", F.col("match_date").cast("timestamp"))
    changed = sent.where("wyId % 3 = 0").withColumn("label", F.concat("label", F.lit(" (replay)"))
                                                    ).withColumn("ts", F.expr("ts + INTERVAL 1 HOUR"))
    again = sent.withColumn("ts", F.expr("ts + INTERVAL 2 HOURS"))
    rows = sent.unionByName(changed).unionByName(again).withColumn("part", part_by_time("ts"))
    feed = Feed(b.spark, "match-lines", records.match_line(rows, "ts", "part"))
    path, checkpoint = _out(b, "matches")
    play([feed], lambda: sessions.append_to(
        sessions.match_intake(feed.stream()).select("arrival", *HEADER), path, checkpoint))
    return b.spark.read.parquet(path).select(*HEADER)


def header_feed(b: Bridge) -> Feed:
    """Headers on the first day of their match; the games of the same two teams are one feed."""
    headers = b.season.matches.select(
        F.expr(f"wyId DIV {DAYS_APART}").alias("feed"), "wyId",
        F.col("match_date").cast("timestamp").alias("header_ts"))
    feed = Feed(b.spark, "headers", headers.withColumn("part", part_by_time("header_ts")))
    feed.far_row("header_ts")
    return feed


@query
def stream_closed_matches(b: Bridge) -> DataFrame:
    """When and why each match was closed: by the next header, the last of a feed by the timeout."""
    feed = header_feed(b)
    path, checkpoint = _out(b, "closed")
    with state.in_rocksdb(b.spark):
        play([feed], lambda: sessions.append_to(
            finalise.closed_matches(feed.stream(), "100 days", DELAY), path, checkpoint))
    return b.spark.read.parquet(path).select(
        "matchId", F.timestamp_millis("closed_ms").cast("timestamp_ntz").alias("closed_ts"), "reason")


@query
def stream_finished_matches(b: Bridge) -> DataFrame:
    """Career rows of all matches, computed when each was closed from the events stored by then, and
    again when an event came later."""
    event_rows, headers = Feed(b.spark, "event-feed", timed_events(b)), header_feed(b)
    stored, stored_checkpoint = _out(b, "stored")
    path, checkpoint = _out(b, "finished")
    line = b.lineup_season
    schema = finalise.finished_rows(line, line.match_dates).withColumns(
        {"arrival": F.current_timestamp(), "batch_id": F.lit(0).cast("bigint")}).schema

    def season() -> Season:
        arrived = b.spark.read.schema(event_rows.schema).parquet(stored)
        return Season(b.players, b.teams, None, arrived, b.sheets, b.match_dates)

    def finished() -> DataFrame:
        return b.spark.read.schema(schema).parquet(path)

    def step():
        sessions.finish(sessions.append_to(event_rows.stream(), stored, stored_checkpoint))
        arrived = b.spark.readStream.schema(event_rows.schema).parquet(stored)
        closed = finalise.closed_matches(headers.stream(), "100 days", DELAY)
        return finalise.write_finished(finalise.to_finish(closed, arrived), season, finished, path,
                                       checkpoint)

    b.spark.createDataFrame([], schema).write.partitionBy("batch_id").parquet(path)
    with state.in_rocksdb(b.spark):
        play([event_rows, headers], step)
    rows = finalise.newest_rows(finished())
    return rounded(rows.select(*KEYS, "teamId", "match_date", "played", "contribution", "foulLoss",
                               "ownGoals"), "contribution")


def rating_lines(b: Bridge, after: Callable[[str], None] = lambda path: None) -> str:
    """Folder of rating lines made from finished matches that arrive in five parts, in any order.
    ``after`` is called with it after each part."""
    part = F.pmod(F.xxhash64("matchId"), F.lit(5)).cast("int")
    finished = b.lineup_season.career_rows.withColumn("part", part)
    feed = Feed(b.spark, "finished", finished.withColumn(
        "arrival", F.expr("TIMESTAMP'2024-03-01' + make_dt_interval(part)")))
    path, checkpoint = _out(b, "ratings")

    def step():
        return sessions.append_to(ratings.rating_stream(feed.stream()), path, checkpoint)

    with state.in_rocksdb(b.spark):
        for k in range(5):
            feed.put(k)
            sessions.finish(step())
            after(path)
    return path


@query
def stream_ratings(b: Bridge) -> DataFrame:
    lines = ratings.newest_lines(b.spark.read.parquet(rating_lines(b)))
    return rounded(lines.select(*HISTORY), *HISTORY[3:7])


@query
def stream_chemistry(b: Bridge) -> DataFrame:
    """Changes are computed after every part of the rating lines, and again for corrected ones."""
    out, checkpoint = _out(b, "deltas")

    def changes(path: str) -> None:
        lines = b.spark.readStream.schema(ratings.OUTPUT).parquet(path)
        sessions.finish(chemistry_stream.write_deltas(
            lines, lambda: ratings.newest_lines(b.spark.read.schema(ratings.OUTPUT).parquet(path)),
            out, checkpoint))

    rating_lines(b, changes)
    deltas = chemistry_stream.newest_deltas(b.spark.read.parquet(out))
    return rounded(chemistry.chemistry_table(deltas), "chemistry")


@query
def stream_lines(b: Bridge) -> DataFrame:
    """Lines of text files, taken every few seconds while files arrive, until the query is stopped."""
    folder = sinks.shared_folder(b.spark, "feed-text")
    path, checkpoint = _out(b, "typed")
    lines = sinks.materialise(records.event_line(timed_events(b), "part"), "event-lines")

    def put(part: int) -> None:
        lines.where(F.col("part") == part).select("value").write.mode("append").text(folder)

    put(0)
    typed = records.read_events(records.line_stream(b.spark, "text", path=folder))
    running = sessions.append_to(typed, path, checkpoint, once=False)
    for part in range(1, PARTS):
        running.processAllAvailable()
        put(part)
    sessions.stop(running)
    known = events.of_known_players(b.spark.read.parquet(path), b.players)
    return events.flag_events(known).select(*KEYS, "eventId", "subEventId", *events.TAG_FLAGS)


@query
def stream_merged_counts(b: Bridge) -> DataFrame:
    """Counters of many small batches, published after each and merged by threes; read through the
    last manifest."""
    parts = 12
    feed = Feed(b.spark, "events", timed_events(b).withColumn("part", part_by_time("ts", parts)))
    folder = sinks.shared_folder(b.spark, "store")
    names = ", ".join(f"{c} BIGINT" for c in metrics.COUNTERS)
    store = Snapshots(b.spark, folder, {"counts": Kept(
        f"matchId BIGINT, playerId BIGINT, {names}", counters.added_up)}, merge_after=3)
    for part in range(parts):
        feed.put(part)
        sessions.finish(counters.write_counts(
            feed.stream(), f"{folder}/counts", f"{folder}/checkpoint"))
        store.publish()
    counted = counters.read_counts(store.read(store.latest(), "counts"))
    return rounded(events.of_known_players(counted, b.players), *metrics.ratios())


@query
def stream_requests(b: Bridge) -> DataFrame:
    """Files of requests that arrive one after the other; the answers of all batches in order."""
    folder, out = (sinks.shared_folder(b.spark, name) for name in ("asked", "answered"))
    season = answer_season(b)
    lines = sinks.materialise(request_lines(b), "request-lines")
    for part in range(3):
        asked = lines.where(F.least(F.floor(F.col("request_seq") / 10**15), F.lit(2)) == part)
        asked.repartitionByRange(2, "request_seq").sortWithinPartitions("request_seq").select(
            "value").write.text(f"{folder}/part={part}")
        sessions.finish(request_stream.write_answers(
            b.spark.readStream.schema("value STRING, part INT").text(folder), lambda: 1,
            lambda number: season, out, f"{out}/checkpoint"))
    answers = numbering.numbered(numbering.text_lines(b.spark, f"{out}/responses"), "line_no")
    return bodies(answers.withColumnRenamed("value", "response"), "line_no")
