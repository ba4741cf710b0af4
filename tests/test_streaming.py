import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from catalog import feeds
from tests import fixtures as fx
from touchline.operators import chemistry, metrics
from touchline.operators.ratings import rating_history
from touchline.sources import records, sinks
from touchline.sources.sinks import shared_folder
from touchline.streaming import chemistry as chemistry_stream
from touchline.streaming import counters, finalise, joined, late, ratings, sessions, state


def folder(spark):
    return shared_folder(spark, "test")


def run(spark, start, out=None):
    out = out or folder(spark)
    sessions.finish(start(f"{out}/data", f"{out}/checkpoint"))
    return spark.read.parquet(f"{out}/data")


def stamped(spark, rows):
    """``(minute, event)`` rows as typed events with an arrival time."""
    start = dt.datetime(2018, 5, 13, 12)
    lines = [(start + dt.timedelta(minutes=m), json.dumps(e)) for m, e in rows]
    frame = spark.createDataFrame(lines, "ts TIMESTAMP, value STRING")
    return records.route_events(records.parse_lines(frame))


def test_live_counters_over_several_batches(spark):
    people = fx.players(spark, [(1, "A", "GK"), (2, "B", "GK")])
    source, out = folder(spark), folder(spark)
    batches = [
        [(0, fx.event(1, 8, (1801,))), (1, fx.event(2, 1, (703,))), (2, fx.event(9, 2))],
        [(5, fx.event(1, 8, (1802,))), (700, fx.event(1, 10, (1801, 101)))],
        [(800, fx.event(1, 8, (1801, 302), match=2)), (801, fx.event(1, 2))],
    ]
    typed = None
    for rows in batches:
        typed = stamped(spark, rows)
        typed.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(typed.schema).parquet(source)
        run(spark, lambda p, c: counters.write_batches(counters.live_counts(stream), p, c), out)
    live = counters.read_live_metrics(spark.read.parquet(f"{out}/data"), people)
    batch = metrics.match_metrics(spark.read.parquet(source), people)
    names = batch.columns
    assert sorted(map(tuple, live.select(names).collect())) == sorted(map(tuple, batch.collect()))
    assert len(spark.read.parquet(f"{out}/data").select("batch_id").distinct().collect()) >= 3


def test_a_match_is_final_when_it_has_gone_quiet(spark):
    source = folder(spark)
    rows = [(0, fx.event(1, 8, (1801,))), (90, fx.event(1, 8, (1802,))),
            (600, fx.event(1, 8, (1801,), match=2)), (2000, fx.event(1, 2, match=3))]
    typed = stamped(spark, rows)
    typed.write.parquet(source)
    stream = spark.readStream.schema(typed.schema).parquet(source)
    closed = sessions.match_sessions(stream, "3 hours", "1 minute")
    got = run(spark, lambda p, c: sessions.append_to(closed, p, c)).orderBy("matchId").collect()
    assert [(r.matchId, r.normalPasses) for r in got] == [(1, 2), (2, 1)]
    assert got[0].passAccuracy == 0.5
    # One event late in a closed session, one before it, and a match that is still open.
    late = stamped(spark, [(91, fx.event(1, 1, (703,))), (-30, fx.event(1, 2))])
    whole = sessions.whole_sessions(spark.createDataFrame(got), typed.unionByName(late), "3 hours")
    assert sorted((r.matchId, r.normalPasses, r.duelsWon, r.foulLoss) for r in whole.collect()) == [
        (1, 2, 1, 1), (2, 1, 0, 0), (3, 0, 0, 1)]


def test_chemistry_of_matches_in_any_order(spark):
    source, out = folder(spark), folder(spark)

    def lines(match, people, version=1, retracted=False):
        return finished(spark, match, people).selectExpr(
            "playerId", "matchId", "match_date", "teamId", "in_chemistry", "contribution",
            "0D AS performance", "0.5D AS previous_rating", "contribution AS rating",
            "1L AS numMatches", "0L AS careerFouls", "0L AS careerOwnGoals",
            f"{version}L AS version", f"{retracted} AS retracted")

    def newest():
        return ratings.newest_lines(spark.read.parquet(source))

    three = [(1, 0.8), (2, 0.2), (3, 0.5)]
    # The fourth part corrects a line, the fifth takes all lines of a match back.
    for part in (lines(1, three), lines(20, three), lines(10, three), lines(1, [(2, 0.9)], 2),
                 lines(10, three, 2, True)):
        part.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ratings.OUTPUT).parquet(source)
        stored = run(spark, lambda p, c: chemistry_stream.write_deltas(stream, newest, p, c), out)
    got = chemistry_stream.newest_deltas(stored)
    want = chemistry.chemistry_deltas(newest())
    names = ["matchId", "player1", "player2", "delta"]
    assert got.count() == 6
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(
        map(tuple, want.select(*names).collect()))


def test_the_newest_version_of_a_match_record_counts(spark):
    source = folder(spark)
    sent = [(1, "Postponed"), (2, "Played"), (1, "Postponed"), (1, "Played")]
    rows = [(dt.datetime(2018, 5, 13, 12 + i), json.dumps(fx.match(m, []) | {"status": status}))
            for i, (m, status) in enumerate(sent)]
    frame = spark.createDataFrame(rows, "ts TIMESTAMP, value STRING")
    frame.write.parquet(source)
    stream = spark.readStream.schema(frame.schema).parquet(source)
    intake = sessions.match_intake(stream).select("arrival", "wyId", "status", "match_date")
    stored = run(spark, lambda p, c: sessions.append_to(intake, p, c))
    got = records.newest_matches(stored).select("wyId", "status", "match_date").collect()
    day = dt.date(2018, 5, 13)
    assert sorted(map(tuple, got)) == [(1, "Played", day), (2, "Played", day)]


def test_line_stream_reads_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text(json.dumps(fx.event(1, 8, (1801,))) + "\n{broken\n")
    lines = records.line_stream(spark, "text", path=str(tmp_path))
    assert lines.isStreaming
    events = records.route_events(records.parse_lines(lines))
    got = run(spark, lambda p, c: sessions.append_to(events, p, c))
    assert [(r.playerId, r.tag_ids) for r in got.collect()] == [(1, [1801])]


ROW = ("playerId BIGINT, matchId BIGINT, match_date DATE, teamId BIGINT, played BOOLEAN,"
       " in_chemistry BOOLEAN, contribution DOUBLE, foulLoss BIGINT, ownGoals BIGINT")


def finished(spark, match, rows):
    day = dt.date(2018, 5, match)
    return spark.createDataFrame(
        [(p, match, day, 10 + 10 * (p % 2), True, True, c, 1, 0) for p, c in rows], ROW)


GAME_NAMES = ["playerId", "matchId", "performance", "previous_rating", "rating", "numMatches",
              "careerFouls", "careerOwnGoals"]


def careers(spark, seed=3):
    """Finished matches of a few players over several years."""
    rng = random.Random(seed)
    return [(p, 100 * p + m, dt.date(2015, 1, 1) + dt.timedelta(days=rng.randrange(1500)),
             rng.choice([None, 10]), rng.random() < 0.8, True, rng.random(), rng.randrange(3),
             rng.randrange(2)) for p in range(1, 7) for m in range(40)]


def rated(spark, parts, seal_after="1 day"):
    """Newest lines after the parts have gone through the stream one by one, and all lines."""
    source, out = folder(spark), folder(spark)
    for k, rows in enumerate(parts):
        arrived = dt.datetime(2024, 1, 1) + dt.timedelta(days=k)
        frame = spark.createDataFrame([(*r, arrived) for r in rows], f"{ROW}, arrival TIMESTAMP")
        frame.coalesce(1).write.mode("append").parquet(source)
        with state.in_rocksdb(spark):
            stream = ratings.rating_stream(
                spark.readStream.schema(frame.schema).parquet(source), seal_after, "1 second")
            lines = run(spark, lambda p, c: sessions.append_to(stream, p, c), out)
    return ratings.newest_lines(lines), lines


def same_lines(got, want):
    def ordered(frame):
        return [tuple(r) for r in frame.select(*GAME_NAMES).orderBy("playerId", "matchId").collect()]

    assert ordered(got) == [pytest.approx(r) for r in ordered(want)]


@pytest.mark.parametrize("seal_after", ["1 hour", "1000 days"])
def test_ratings_of_matches_in_any_order(spark, seal_after):
    """Late matches, with their blocks sealed long before or still open."""
    rows = careers(spark)
    random.Random(1).shuffle(rows)
    got, lines = rated(spark, [rows[k::5] for k in range(5)], seal_after)
    same_lines(got, rating_history(spark.createDataFrame(rows, ROW)))
    assert lines.count() > got.count()


def test_new_versions_of_matches_correct_the_ratings(spark):
    rows = careers(spark)
    # Another result, another day in another year, and a match that was not played after all.
    changed = [(*r[:6], r[6] / 2, *r[7:]) for r in rows[:30:7]]
    changed += [(*r[:2], dt.date(2014, 5, 1), *r[3:]) for r in rows[100:140:9]]
    changed += [(*r[:4], False, *r[5:]) for r in rows[160:200:4]]
    got, _ = rated(spark, [rows, changed], "1 hour")
    final = {(r[0], r[1]): r for r in rows} | {(r[0], r[1]): r for r in changed}
    same_lines(got, rating_history(spark.createDataFrame(list(final.values()), ROW)))


def test_a_match_in_order_replays_nothing(spark):
    rows = sorted(careers(spark), key=lambda r: r[2])
    got, lines = rated(spark, [rows[:200], rows[200:]])
    assert lines.count() == got.count()


def headers(spark, rows):
    start = dt.datetime(2018, 5, 13, 12)
    return spark.createDataFrame(
        [(feed, match, start + dt.timedelta(minutes=m), place) for feed, match, m, place in rows],
        "feed INT, wyId BIGINT, header_ts TIMESTAMP, place INT")


def closings(spark, parts, timeout="1 day", delay="1 hour"):
    source, out = folder(spark), folder(spark)
    for rows in parts:
        frame = headers(spark, rows)
        frame.coalesce(1).write.mode("append").parquet(source)
        with state.in_rocksdb(spark):
            stream = finalise.closed_matches(
                spark.readStream.schema(frame.schema).parquet(source), timeout, delay)
            found = run(spark, lambda p, c: sessions.append_to(stream, p, c), out)
    start = dt.datetime(2018, 5, 13, 12, tzinfo=dt.timezone.utc).timestamp()
    return sorted((r.matchId, round(r.closed_ms / 60000 - start / 60), r.reason)
                  for r in found.collect())


def test_the_next_header_closes_a_match(spark):
    """A feed without pauses: all but its last match are closed, feed by feed."""
    feed = [(1, m, 10 * m, 0) for m in range(1, 9)]
    assert closings(spark, [feed[:3], feed[3:4], [*feed[4:], (2, 99, 85, 0)]]) == [
        (m, 10 * (m + 1), "header") for m in range(1, 8)]


def test_headers_in_turns_late_ones_and_the_timeout(spark):
    parts = [[(1, 5, 0, 0), (1, 6, 10, 0)], [(1, 5, 20, 0), (1, 5, 25, 0)], [(1, 4, 5, 0)],
             [(2, 8, 30, 1), (2, 7, 30, 0)], [(3, 1, 5000, 0)]]
    assert closings(spark, parts) == [
        (4, 25, "header"),  # came after the next one had begun
        (5, 10, "header"), (5, 25 + 1440, "timeout"), (6, 20, "header"),
        (7, 30, "header"),  # of the same time, by place
        (8, 30 + 1440, "timeout")]


def test_events_meet_their_header_early_late_or_never(spark):
    event_rows, header_rows, out = folder(spark), folder(spark), folder(spark)
    start = dt.datetime(2018, 5, 13, 12)

    def at(minute):
        return start + dt.timedelta(minutes=minute)

    rounds = [([(1, 1, 0), (2, 2, 0)], [(1, "a", -60)]), ([(3, 1, 20), (4, 3, 20)], [(2, "b", 30)]),
              ([(5, 2, 60)], [(1, "a", 40), (2, "b2", 50), (3, "far", 400)]),
              ([(9, None, 9000)], [(None, None, 9000)])]
    for sent, known in rounds:
        rows = spark.createDataFrame([(e, m, at(t)) for e, m, t in sent],
                                     "event_id BIGINT, matchId BIGINT, ts TIMESTAMP")
        heads = spark.createDataFrame(
            [(m, at(t), label, "Played", None, 1, "v") for m, label, t in known],
            "wyId BIGINT, header_ts TIMESTAMP, label STRING, status STRING, match_date DATE,"
            " gameweek INT, venue STRING")
        rows.coalesce(1).write.mode("append").parquet(event_rows)
        heads.coalesce(1).write.mode("append").parquet(header_rows)
        stream = joined.with_match_stream(
            spark.readStream.schema(rows.schema).parquet(event_rows),
            spark.readStream.schema(heads.schema).parquet(header_rows), "2 hours", "2 hours", "1 day")
        found = run(spark, lambda p, c: sessions.append_to(stream, p, c), out)
    got = sorted((r.event_id, r.label) for r in found.collect())
    # A header sent again counts once, each version of a changed one gives a row.
    assert got == [(1, "a"), (2, "b"), (2, "b2"), (3, "a"), (4, None), (5, "b"), (5, "b2")]
    newest = joined.newest_header(found, ["event_id", "matchId", "ts"])
    assert sorted((r.event_id, r.label) for r in newest.collect()) == [
        (1, "a"), (2, "b2"), (3, "a"), (4, None), (5, "b2")]


def test_no_batch_only_moves_the_watermark(spark):
    start = dt.datetime(2018, 5, 13, 12)
    events = spark.createDataFrame(
        [(10 * p + m, m, start + dt.timedelta(hours=6 * p), p) for p in range(4) for m in range(3)],
        "event_id BIGINT, matchId BIGINT, ts TIMESTAMP, part INT")
    headers = spark.createDataFrame(
        [(m, start + dt.timedelta(hours=6 * p + 1), str(p), "Played", None, 1, "v", p)
         for p in range(4) for m in (0, 1)],
        "wyId BIGINT, header_ts TIMESTAMP, label STRING, status STRING, match_date DATE,"
        " gameweek INT, venue STRING, part INT")
    before = spark.conf.get(state.EMPTY_BATCHES)

    def played(**more):
        sent, known, out = feeds.Feed(spark, "sent", events), feeds.Feed(spark, "known", headers), folder(spark)
        sent.far_row("ts")
        known.far_row("header_ts")
        with state.newest_in_memory(spark):
            feeds.play([sent, known], lambda: sessions.append_to(joined.with_match_stream(
                sent.stream(), known.stream(), "2 hours", "2 hours", "1 hour"),
                f"{out}/data", f"{out}/checkpoint"), **more)
        rows = spark.read.parquet(f"{out}/data").select("event_id", "label").collect()
        batches = spark.read.format("binaryFile").load(f"{out}/checkpoint/commits").count()
        return sorted(tuple(r) for r in rows), batches

    rows, batches = played(empty_batches=False)
    assert rows == [(10 * p + m, str(p) if m < 2 else None) for p in range(4) for m in range(3)]
    # One for each part, one for the sentinels, and one after them that lets out what waits.
    assert batches == 6 and played()[1] > 6
    assert spark.conf.get(state.EMPTY_BATCHES) == before


def test_late_rows_are_kept_and_counters_reconciled(spark):
    source, gate, out = folder(spark), folder(spark), folder(spark)
    parts = [[(0, fx.event(1, 8, (1801,))), (50, fx.event(1, 1, (703,)))],
             [(400, fx.event(2, 8, (1801,), match=2)), (30, fx.event(1, 2))],
             [(20, fx.event(1, 8, (1802,))), (420, fx.event(2, 10, (1801,), match=2))],
             [(99999, fx.event(3, 2, match=None))]]
    for rows in parts:
        typed = stamped(spark, rows)
        typed.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(typed.schema).parquet(source)
        sessions.finish(late.write_split(stream, gate, f"{gate}/checkpoint", "1 hour"))
        accepted = late.accepted_stream(spark, gate, typed.schema)
        closed = run(spark, lambda p, c: sessions.append_to(
            sessions.match_sessions(accepted, "3 hours", "1 hour"), p, c), out)
    split = late.read_split(spark, gate, typed.schema)
    assert [(r.batch_id, r.eventId) for r in split.where("late").collect()] == [(2, 8)]
    stored = split.where("matchId IS NOT NULL")
    found = {(r.matchId, r.playerId): r for r in late.reconciled(
        closed, split.where("late"), stored).collect()}
    assert all(r.agrees for r in found.values()) and len(found) == 2
    assert (found[1, 1].actionsCounted, found[1, 1].actionsLate, found[1, 1].actionsStored) == (3, 1, 4)
    lost = late.reconciled(closed, split.where("false"), stored).collect()
    assert sorted((r.matchId, r.agrees) for r in lost) == [(1, False), (2, True)]


def test_a_stored_batch_is_not_split_again(spark):
    source, gate = folder(spark), folder(spark)
    typed = stamped(spark, [(0, fx.event(1, 8, (1801,)))])
    typed.write.parquet(source)
    for checkpoint in ("a", "b"):  # the second run knows nothing of the first: a retried batch
        stream = spark.readStream.schema(typed.schema).parquet(source)
        sessions.finish(late.write_split(stream, gate, f"{gate}/{checkpoint}", "1 hour"))
    assert late.read_split(spark, gate, typed.schema).count() == 1


def test_a_header_sent_in_turns_is_stored_once(spark):
    source = folder(spark)
    turns = [(1, "Played"), (2, "Played")] * 3 + [(1, "Suspended"), (2, "Played")]
    rows = [(dt.datetime(2018, 5, 13, 12, i), json.dumps(fx.match(m, []) | {"status": status}))
            for i, (m, status) in enumerate(turns)]
    out = folder(spark)
    for k in range(0, len(rows), 3):
        frame = spark.createDataFrame(rows[k:k + 3], "ts TIMESTAMP, value STRING")
        frame.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(frame.schema).parquet(source)
        stored = run(spark, lambda p, c: sessions.append_to(
            sessions.match_intake(stream).select("wyId", "status"), p, c), out)
    assert sorted(map(tuple, stored.collect())) == [
        (1, "Played"), (1, "Suspended"), (2, "Played")]


def test_stop_commits_what_has_arrived(spark):
    source, out = folder(spark), folder(spark)
    finished(spark, 3, [(1, 0.8)]).write.parquet(source)
    stream = spark.readStream.schema(ROW).parquet(source).where(F.col("played"))
    query = sessions.append_to(stream, f"{out}/data", f"{out}/checkpoint", once=False)
    sessions.stop(query)
    assert not query.isActive
    assert spark.read.parquet(f"{out}/data").count() == 1


def test_a_sealed_career_takes_matches_in_again_and_again(spark):
    """Only sealed blocks, nothing open: the state of a list could not be put back empty."""
    rows = [(1, m, dt.date(2015, 1, m), 10, True, True, 0.1 * m, 1, 0) for m in range(1, 7)]
    got, _ = rated(spark, [rows[:1], rows[5:], rows[1:2], rows[4:5], rows[2:4]], "1 hour")
    same_lines(got, rating_history(spark.createDataFrame(rows, ROW)))


def test_state_comes_with_the_rows(spark):
    """No call to the state for each player or feed."""
    source = folder(spark)
    done = finished(spark, 3, [(1, 0.8)]).withColumn("arrival", F.current_timestamp())
    done.write.parquet(f"{source}/done")
    headers(spark, [(1, 5, 0, 0)]).write.parquet(f"{source}/heads")
    for stream in (
            ratings.rating_stream(spark.readStream.schema(done.schema).parquet(f"{source}/done")),
            finalise.closed_matches(spark.readStream.schema(headers(spark, []).schema).parquet(
                f"{source}/heads"), "1 day", "1 hour")):
        plan = stream._jdf.queryExecution().analyzed().toString()
        assert "FlatMapGroupsInPandasWithState" in plan


def test_a_batch_of_closed_matches_is_run_once(spark, monkeypatch):
    """Nothing below a batch is computed again by the parts of a plan that need it."""
    kept = []
    monkeypatch.setattr(finalise, "materialise",
                        lambda frame, name: kept.append(name) or sinks.materialise(frame, name))
    source, out = folder(spark), folder(spark)
    rows = spark.createDataFrame([(1, True), (2, False)], "matchId BIGINT, closed BOOLEAN")
    rows.write.parquet(source)
    asked = []
    monkeypatch.setattr(finalise, "finished_rows",
                        lambda season, over: asked.append(sorted(map(tuple, over.collect()))) or over)
    stored = spark.createDataFrame([(3,)], "matchId BIGINT")
    sessions.finish(finalise.write_finished(
        spark.readStream.schema(rows.schema).parquet(source), lambda: None, lambda: stored,
        f"{out}/data", f"{out}/checkpoint"))
    assert kept == ["to-finish", "over"] and asked == [[(1, True)]]
