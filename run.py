"""Command line.

``spark-submit run.py ingest`` takes a line feed into tables, ``spark-submit run.py answer``
answers a file of requests from those tables or straight from a feed, ``spark-submit run.py serve``
answers requests as they arrive.
"""

from __future__ import annotations

import argparse
import signal
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from touchline import Season, schemas
from touchline.operators.events import of_known_players
from touchline.operators.metrics import COUNTERS
from touchline.plans.requests import answer_requests
from touchline.sources import files, records, sinks, tables
from touchline.sources.snapshots import Kept, Snapshot, Snapshots
from touchline.streaming import chemistry, counters, feed, finalise, ratings, sessions, state
from touchline.streaming import requests as request_stream

_FINISHED = ("playerId BIGINT, matchId BIGINT, teamId BIGINT, match_date DATE, played BOOLEAN,"
             " in_chemistry BOOLEAN, contribution DOUBLE, foulLoss BIGINT, ownGoals BIGINT,"
             " arrival TIMESTAMP")
_BY_DATE = "match_date"
#: What ``ingest`` keeps: columns, how parts are reduced when they are merged, and their day.
TABLES = {
    "lines": Kept("ts TIMESTAMP, place BIGINT, value STRING"),
    "matches": Kept(f"arrival TIMESTAMP, place BIGINT, {schemas.ddl(schemas.MATCH)},"
                    " match_date DATE", records.newest_matches, _BY_DATE),
    "events": Kept("ts TIMESTAMP, matchId BIGINT, playerId BIGINT, eventId INT, subEventId INT,"
                   " tag_ids ARRAY<INT>", day="CAST(ts AS DATE)"),
    "corrupt": Kept("_corrupt_record STRING"),
    "counts": Kept(f"matchId BIGINT, playerId BIGINT, {', '.join(f'{c} BIGINT' for c in COUNTERS)}",
                   counters.added_up),
    "finished": Kept(_FINISHED, finalise.newest_rows, _BY_DATE),
    "ratings": Kept(ratings.OUTPUT, ratings.newest_versions, _BY_DATE),
    "deltas": Kept("player1 BIGINT, player2 BIGINT, matchId BIGINT, match_date DATE,"
                   " same_team BOOLEAN, delta DOUBLE, batch_id BIGINT",
                   chemistry.newest_batches, _BY_DATE),
}


class Store(Snapshots):
    """The tables below a folder, each with a folder for every batch."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, TABLES)

    def create(self) -> None:
        """Empty folders where there are none yet, so that all can be followed."""
        for name in TABLES:
            files.make_folder(self.spark, f"{self.folder}/{name}")

    def written(self, name: str) -> DataFrame:
        """What has been written by now, for the steps that make the next table."""
        return self.read(self.now(), name)

    def follow(self, name: str) -> DataFrame:
        return self.spark.readStream.schema(TABLES[name].columns).parquet(f"{self.folder}/{name}")

    def place(self, name: str) -> tuple[str, str]:
        return f"{self.folder}/{name}", f"{self.folder}/_checkpoints/{name}"

    def next_rest(self) -> int:
        return min([0, *self._batches("finished")]) - 1


def ingest_steps(spark: SparkSession, store: Store, args: argparse.Namespace
                 ) -> dict[str, Callable[[], StreamingQuery]]:
    """Every table is made from those before it."""
    options = dict(pair.split("=", 1) for pair in args.option)
    players = tables.read_players(spark, args.players)

    def lines() -> DataFrame:
        return store.follow("lines")

    def known_events() -> DataFrame:
        return of_known_players(records.read_events(lines()), players).select(
            "ts", "matchId", "playerId", "eventId", "subEventId", "tag_ids")

    def season() -> Season:
        # The names of teams are not needed for anything that is kept.
        matches = records.newest_matches(store.written("matches")).drop("arrival", "place")
        return Season(players, None, matches, store.written("events"))

    def keep(name: str, stream: Callable[[], DataFrame]) -> StreamingQuery:
        return sessions.append_batches(stream(), *store.place(name))

    def finished() -> StreamingQuery:
        # Headers of one batch arrived at the same moment; their place tells them apart.
        headers = store.follow("matches").select(
            F.lit(0).alias("feed"), "wyId", "place", F.col("arrival").alias("header_ts"))
        closed = finalise.closed_matches(headers, args.gap, args.delay)
        return finalise.write_finished(
            finalise.to_finish(closed, store.follow("events")), season,
            lambda: store.written("finished"), *store.place("finished"))

    return {
        "lines": lambda: feed.write_lines(
            records.placed_stream(spark, args.source, **options), *store.place("lines")),
        "matches": lambda: keep("matches", lambda: sessions.match_intake(lines()).select(
            TABLES["matches"].columns.names)),
        "events": lambda: keep("events", known_events),
        "corrupt": lambda: keep("corrupt", lambda: records.corrupt_lines(
            records.parse_lines(lines()))),
        "counts": lambda: counters.write_counts(store.follow("events"), *store.place("counts")),
        "finished": finished,
        "ratings": lambda: keep("ratings", lambda: ratings.rating_stream(store.follow("finished"))),
        "deltas": lambda: chemistry.write_deltas(
            store.follow("ratings"), lambda: ratings.newest_lines(store.written("ratings")),
            *store.place("deltas")),
    }


def one_round(store: Store, steps: dict[str, Callable[[], StreamingQuery]], end: bool,
              args: argparse.Namespace) -> Snapshot:
    """Bring all tables up to date, one after the other, and publish them together."""
    def rest() -> None:
        matches = records.newest_matches(store.written("matches")).drop("arrival", "place")
        season = Season(tables.read_players(store.spark, args.players), None, matches,
                        store.written("events"))
        finalise.write_rest(season, store.written("finished"), store.place("finished")[0],
                            store.next_rest())

    with state.in_rocksdb(store.spark):
        for name, start in steps.items():
            sessions.finish(start())
            if name == "finished" and end:
                rest()
    return store.publish()


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Keeps all tables below ``--tables`` up to date, round after round.

    A round takes what has arrived through all steps and then publishes a manifest, so that answers
    never mix tables of different rounds. With ``--once`` there is one round; else there is one
    every few seconds until the process is told to end, which it does after the round at hand.
    """
    store = Store(spark, args.tables)
    store.create()
    steps = ingest_steps(spark, store, args)
    stopped = threading.Event()
    if not args.once:
        for number in (signal.SIGINT, signal.SIGTERM):
            signal.signal(number, lambda *_: stopped.set())
    while True:
        one_round(store, steps, args.end, args)
        if args.once or stopped.wait(counters.BATCH_SECONDS):
            return


def stored_season(spark: SparkSession, args: argparse.Namespace, number: int) -> Season:
    """The season of one manifest; raw events are not read."""
    store = Store(spark, args.tables)
    view = store.numbered(number)
    history = sinks.materialise(ratings.newest_lines(store.read(view, "ratings")), "history")
    deltas = chemistry.newest_deltas(store.read(view, "deltas"))
    matches = records.newest_matches(store.read(view, "matches")).drop("arrival", "place")
    season = Season(tables.read_players(spark, args.players), tables.read_teams(spark, args.teams),
                    matches, events=None)
    return season.with_given(counts=counters.read_counts(store.read(view, "counts")),
                             history=history, deltas=deltas).with_stored(
        "counts", "chemistry", "profiles", "by_name")


def answer(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.feed:
        season = Season.from_lines(
            spark.read.text(args.feed), tables.read_players(spark, args.players),
            tables.read_teams(spark, args.teams)).with_stored(
            "counts", "history", "chemistry", "profiles", "by_name")
    else:
        season = stored_season(spark, args, Store(spark, args.tables).latest().number)
    requests = tables.read_requests(spark, args.requests)
    sinks.write_responses(answer_requests(requests, season), args.out)


def serve(spark: SparkSession, args: argparse.Namespace) -> None:
    """Answers the files of requests that arrive in a folder, each batch from the latest manifest."""
    store = Store(spark, args.tables)
    query = request_stream.write_answers(
        spark.readStream.text(args.requests), lambda: store.latest().number,
        lambda number: stored_season(spark, args, number), args.out, f"{args.out}/checkpoint",
        args.once)
    sessions.finish(query)


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(required=True)
    take = commands.add_parser("ingest")
    take.add_argument("--source", default="text", help="streaming source: text, kafka, socket ...")
    take.add_argument("--option", action="append", default=[], help="source option, key=value")
    take.add_argument("--once", action="store_true", help="take what is there and stop")
    take.add_argument("--end", action="store_true",
                      help="with --once: the feed is over, finish the matches still open")
    take.add_argument("--gap", default="3 hours",
                      help="time after which a match is over if no other header has come")
    take.add_argument("--delay", default="10 minutes", help="how late headers may be")
    take.add_argument("--tables", required=True)
    take.add_argument("--players", required=True)
    take.set_defaults(run=ingest)
    reply = commands.add_parser("answer")
    source = reply.add_mutually_exclusive_group(required=True)
    source.add_argument("--tables")
    source.add_argument("--feed", help="line feed to read instead of the tables")
    for name in ("--players", "--teams", "--requests", "--out"):
        reply.add_argument(name, required=True)
    reply.set_defaults(run=answer)
    live = commands.add_parser("serve")
    for name in ("--tables", "--players", "--teams", "--out"):
        live.add_argument(name, required=True)
    live.add_argument("--requests", required=True, help="folder in which files of requests arrive")
    live.add_argument("--once", action="store_true", help="answer what is there and stop")
    live.set_defaults(run=serve)
    args = parser.parse_args(arguments)
    args.run(SparkSession.builder.appName("touchline").getOrCreate(), args)


if __name__ == "__main__":
    main()
