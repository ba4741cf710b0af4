"""The general test tables seen as football.

Customers become players in teams of fourteen (the last may be smaller), suppliers give the teams
their names, and the
five kinds of stream events become the five event classes. Matchdays last six days; the teams
``2m + 1`` and ``2m + 2`` always meet. Slots 0 to 10 start, 11 replaces 10, 12 replaces 11,
and 13 never plays.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import codes, text
from touchline.operators.events import of_known_players
from touchline.plans.season import Season

SQUAD = 14
MATCHDAY_DAYS = 6
FIRST_DAY = "2024-01-01"
#: More than there are matchdays, so that the ids of two pairs of teams never meet.
DAYS_APART = 100000

# Fixed format: the columns of the test tables that are used.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
    "customer": "c_custkey BIGINT, c_name STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING",
}

# Event class by stream event type; any other type is a foul.
CLASS = f"""CASE event_type WHEN 'view' THEN {codes.PASS} WHEN 'click' THEN {codes.DUEL}
  WHEN 'signup' THEN {codes.FREE_KICK} WHEN 'purchase' THEN {codes.SHOT} ELSE {codes.FOUL} END"""

# The tags of an event, at most one from each of the three conditions.
OUTCOME = f"""CASE
  WHEN event_type = 'click' AND k % 10 < 3 THEN {codes.DUEL_LOST}
  WHEN event_type = 'click' AND k % 10 < 6 THEN {codes.DUEL_NEUTRAL}
  WHEN event_type = 'click' AND k % 10 < 9 THEN {codes.DUEL_WON}
  WHEN event_type = 'view' AND k % 10 < 7 THEN {codes.ACCURATE}
  WHEN event_type = 'view' AND k % 10 < 9 THEN {codes.INACCURATE}
  WHEN event_type IN ('signup', 'purchase') THEN IF(k % 2 = 0, {codes.ACCURATE}, {codes.INACCURATE})
  END"""
EXTRA = f"""CASE WHEN event_type = 'view' AND k % 4 = 0 THEN {codes.KEY_PASS}
  WHEN event_type = 'signup' AND k % 10 = 0 OR event_type = 'purchase' AND k % 6 = 0
  THEN {codes.GOAL} END"""
OWN_GOAL = f"IF(k = 24, {codes.OWN_GOAL}, NULL)"


def typed_events(raw: DataFrame) -> DataFrame:
    """Stream events as match events; works on batch and streaming frames."""
    # ``k`` gets a projection of its own, so that the text is searched once per event.
    keyed = raw.selectExpr(
        "event_id", "ts", "event_type", "2 * user_id + event_id % 2 AS playerId",
        """try_cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS INT) AS k""",
        f"CAST(floor(datediff(CAST(ts AS DATE), DATE'{FIRST_DAY}') / {MATCHDAY_DAYS}) AS INT)"
        " AS matchday")
    return keyed.selectExpr(
        "event_id", "ts", "playerId", f"playerId DIV {SQUAD} + 1 AS teamId", "matchday",
        f"playerId DIV {2 * SQUAD} * {DAYS_APART}L + matchday AS matchId",
        f"{CLASS} AS eventId",
        f"IF(event_type = 'signup' AND k % 5 = 0, {codes.PENALTY}, 0) AS subEventId",
        f"array_compact(array({OUTCOME}, {EXTRA}, {OWN_GOAL})) AS tag_ids")


class Bridge:
    """Domain tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def stream(self, name: str) -> DataFrame:
        """The table as a streaming source, be it one file or a folder of part files."""
        path = f"{self.sf_dir}/{name}.parquet"
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration())
        reader = self.spark.readStream.schema(SCHEMAS[name])
        if files.getFileStatus(hadoop).isDirectory():
            return reader.parquet(path)
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)

    @cached_property
    def teams(self) -> DataFrame:
        """All suppliers, and the teams of customers that no supplier gives a name."""
        named = self.table("supplier").select(
            (F.col("s_suppkey") + 1).alias("Id"), F.col("s_name").alias("name"))
        playing = self.table("customer").select(
            F.expr(f"c_custkey DIV {SQUAD} + 1").alias("Id")).distinct()
        unnamed = playing.join(named, "Id", "left_anti").select(
            "Id", F.concat(F.lit("Team "), F.col("Id").cast("string")).alias("name"))
        return named.unionByName(unnamed)

    @cached_property
    def players(self) -> DataFrame:
        customers = self.table("customer")
        slot = f"CAST(c_custkey % {SQUAD} AS INT)"
        return customers.selectExpr(
            "c_custkey AS Id", "c_name AS name", f"c_custkey DIV {SQUAD} + 1 AS teamId",
            f"{slot} AS slot",
            f"CASE WHEN {slot} = 0 THEN 'GK' WHEN {slot} IN (1, 2, 3, 4, 12) THEN 'DF'"
            f" WHEN {slot} IN (5, 6, 7, 8, 13) THEN 'MD' ELSE 'FW' END AS role",
            "CAST(165 + c_custkey % 31 AS INT) AS height", "CAST(60 + c_custkey % 37 AS INT) AS weight",
            "'Area ' || c_custkey % 7 AS birthArea",
            "CAST(date_add(DATE'1983-01-01', CAST(c_custkey * 37 % 7300 AS INT)) AS TIMESTAMP)"
            " AS birthDate",
            "IF(c_custkey % 4 = 0, 'left', 'right') AS foot",
            "IF(c_custkey % 5 = 0, NULL, 'Area ' || c_custkey % 3) AS passportArea")

    @cached_property
    def events(self) -> DataFrame:
        return typed_events(self.table("events"))

    @cached_property
    def event_stream(self) -> DataFrame:
        """Streaming events; the instant is cast because watermarks need a time zone."""
        return typed_events(self.stream("events")).withColumn(
            "ts", F.col("ts").cast("timestamp"))

    @cached_property
    def sheets(self) -> DataFrame:
        """Line-ups and substitutions of both teams of every match, without scores.

        Two teams meet on the matchdays on which one of their players has an event; a last team
        without an opponent never plays.
        """
        squads = self.players.groupBy("teamId").agg(
            F.expr("array_sort(collect_list(struct(slot, Id AS playerId))) AS squad"))
        pair = F.expr("(teamId - 1) DIV 2").alias("pair")
        paired = squads.select("teamId", "squad", pair).join(
            squads.groupBy(pair).count().where("count = 2").select("pair"), "pair", "left_semi")
        played = of_known_players(
            self.events.select("playerId", "matchday", pair).distinct(), self.players
        ).select("pair", "matchday").distinct()
        days = paired.join(played, "pair")

        def part(cond: str) -> str:
            return f"transform(filter(squad, s -> {cond}), s -> struct(s.playerId AS playerId))"

        def at(slot: int) -> str:
            return f"get(filter(squad, s -> s.slot = {slot}), 0).playerId"

        def swap(on: int, off: int, minute: int) -> str:
            return (f"struct({at(on)} AS playerIn, {at(off)} AS playerOut,"
                    f" matchday + {minute} AS minute)")

        return days.selectExpr(
            f"(teamId - 1) DIV 2 * {DAYS_APART}L + matchday AS matchId",
            f"date_add(DATE'{FIRST_DAY}', matchday * {MATCHDAY_DAYS}) AS match_date",
            "true AS both_formed", "teamId", "matchday",
            f"struct({part('s.slot > 10')} AS bench, {part('s.slot <= 10')} AS lineup,"
            f" filter(array({swap(11, 10, 60)}, {swap(12, 11, 75)}),"
            " s -> s.playerIn IS NOT NULL AND s.playerOut IS NOT NULL) AS substitutions) AS formation")

    @cached_property
    def match_dates(self) -> DataFrame:
        """One row per match: every match has exactly one odd team."""
        return self.sheets.where(F.col("teamId") % 2 == 1).select("matchId", "match_date")

    @cached_property
    def lineup_season(self) -> Season:
        """Season without match records, for everything that needs line-ups and events only."""
        return Season(self.players, self.teams, None, self.events, self.sheets, self.match_dates)

    @cached_property
    def match_records(self) -> DataFrame:
        """Whole match records: header, both formations, goals and cards noted on the sheets."""
        def entries(section: str) -> str:
            return (f"transform(formation.{section}, (e, i) ->"
                    f" struct('{section}' AS section, i AS place, e.playerId AS playerId))")

        rows = self.sheets.selectExpr(
            "matchId", "matchday", "teamId", "formation.substitutions AS swaps",
            f"inline(concat({entries('bench')}, {entries('lineup')}))")
        stats = self.lineup_season.metrics.select(
            "matchId", "playerId", "numGoals", "ownGoals", "foulLoss")
        noted = rows.join(stats, ["matchId", "playerId"], "left").selectExpr(
            "matchId", "matchday", "teamId", "teamId % 2 = 1 AS odd", "swaps",
            "coalesce(numGoals, 0L) AS goals", "coalesce(ownGoals, 0L) AS own",
            """struct(teamId, section, place, playerId, string(coalesce(numGoals, 0L)) AS goals,
              string(coalesce(ownGoals, 0L)) AS ownGoals, IF(foulLoss >= 3, '1', '0') AS yellowCards,
              IF(foulLoss >= 5, '1', '0') AS redCards) AS entry""")
        games = noted.groupBy("matchId").agg(*map(F.expr, (
            "min(matchday) AS matchday", "min(teamId) AS home", "max(teamId) AS away",
            "sum(IF(odd, goals, own)) AS h", "sum(IF(odd, own, goals)) AS a",
            "array_sort(collect_list(entry)) AS entries",
            "max(IF(odd, swaps, NULL)) AS home_swaps", "max(IF(odd, NULL, swaps)) AS away_swaps")))

        def section(side: str, name: str) -> str:
            return (f"transform(filter(entries, e -> e.teamId = {side} AND e.section = '{name}'),"
                    " e -> struct(e.playerId, e.goals, e.ownGoals, e.yellowCards, e.redCards))")

        def team(side: str) -> str:
            return (f"string({side}), struct({side} AS teamId, 1 AS hasFormation,"
                    f" struct({section(side, 'bench')} AS bench, {section(side, 'lineup')} AS lineup,"
                    f" {side}_swaps AS substitutions) AS formation)")

        def named(side: str) -> DataFrame:
            return self.teams.selectExpr(f"Id AS {side}", f"name AS {side}_name")

        day = f"date_add(DATE'{FIRST_DAY}', matchday * {MATCHDAY_DAYS})"
        played = games.join(named("home"), "home").join(named("away"), "away").selectExpr(
            "matchId AS wyId", "'Played' AS status",
            f"date_format({day}, 'MMMM d, yyyy') || ' at 3:00:00 PM GMT' AS date",
            "home_name || ' - ' || away_name || ', ' || h || ' - ' || a AS label",
            "'Regular' AS duration",
            "CASE WHEN h > a THEN home WHEN a > h THEN away ELSE 0L END AS winner",
            "'Ground ' || home AS venue", "matchday + 1 AS gameweek",
            f"CAST(map({team('home')}, {team('away')}) AS {schemas.MATCH['teamsData']}) AS teamsData")
        # One match that was never played, so that its status is always among the answers.
        suspended = self.spark.range(1).selectExpr(
            f"{DAYS_APART - 1}L AS wyId", "'Suspended' AS status",
            "'January 31, 2024 at 3:00:00 PM GMT' AS date", "'Suspended fixture, 0 - 0' AS label",
            "'Regular' AS duration", "0L AS winner", "'Ground 0' AS venue", "6 AS gameweek",
            f"CAST(map() AS {schemas.MATCH['teamsData']}) AS teamsData")
        return played.unionByName(suspended).withColumn(
            "match_date", text.match_date(F.col("date")))

    @cached_property
    def season(self) -> Season:
        """Season with whole match records."""
        return Season(self.players, self.teams, self.match_records, self.events, self.sheets,
                      self.match_dates)

    @cached_property
    def prediction_requests(self) -> DataFrame:
        """Eight prediction requests per pair of full teams: the starters; a squad with a player who
        never played; a repeated name; an unknown name; no keeper in the first squad, in the second,
        in both; a place without a name."""
        squads = self.players.groupBy("teamId").agg(F.expr(
            "transform(array_sort(collect_list(struct(slot, name))), s -> s.name) AS names"))
        squads = squads.where(F.size("names") == SQUAD)
        pairs = squads.groupBy(F.expr("(teamId - 1) DIV 2 AS m")).agg(
            F.count("*").alias("sides"),
            F.expr("max(IF(teamId % 2 = 1, names, NULL)) AS names1"),
            F.expr("max(IF(teamId % 2 = 0, names, NULL)) AS names2"))

        pairs = pairs.where("sides = 2")

        def squad(team: int, swaps: dict[int, str]) -> str:
            places = [f"{swaps.get(i, f'get(names{team}, {i})')} AS {slot}"
                      for i, slot in enumerate(schemas.SQUAD_SLOTS)]
            return f"struct('Side {team} of ' || m AS name, {', '.join(places)})"

        no_keeper = [{0: f"get(names{team}, 12)"} for team in (1, 2)]
        kinds = [({}, {}), ({8: "get(names1, 13)"}, {}), ({1: "get(names1, 0)"}, {}),
                 ({3: "'No Such Player'"}, {}), (no_keeper[0], {}), ({}, no_keeper[1]), no_keeper,
                 ({5: "CAST(NULL AS STRING)"}, {})]
        variants = ", ".join(
            f"struct({i} AS kind, {squad(1, first)} AS team1, {squad(2, second)} AS team2)"
            for i, (first, second) in enumerate(kinds))
        return pairs.selectExpr("m", f"inline(array({variants}))").selectExpr(
            "m * 10 + kind AS request_seq", "1 AS req_type", "'2024-02-01' AS date",
            "CAST(NULL AS STRING) AS name", "CAST(NULL AS STRING) AS label", "team1", "team2")

    def _plain_requests(self, frame: DataFrame, seq: Column, req_type: int, **fields) -> DataFrame:
        values = {**fields, "req_type": F.lit(req_type)}
        return frame.select(
            seq.cast("bigint").alias("request_seq"),
            *[values.get(c, F.lit(None)).cast(t).alias(c) for c, t in schemas.REQUEST.items()])

    @cached_property
    def profile_requests(self) -> DataFrame:
        """One request per player name, and one for a name nobody has."""
        named = self._plain_requests(
            self.players, F.col("Id") + 10**15, 2, name=F.col("name"))
        return named.unionByName(self._plain_requests(
            self.spark.range(1), F.lit(2 * 10**15 - 1), 2, name=F.lit("No Such Player")))

    @cached_property
    def report_requests(self) -> DataFrame:
        """One request per match, and one for a match that does not exist."""
        asked = self._plain_requests(
            self.match_records, F.col("wyId") + 2 * 10**15, 3,
            date=text.iso_date(F.col("match_date")), label=F.col("label"))
        return asked.unionByName(self._plain_requests(
            self.spark.range(1), F.lit(3 * 10**15 - 1), 3,
            date=F.lit("2024-01-01"), label=F.lit("No Such Match")))

    @cached_property
    def requests(self) -> DataFrame:
        """All of the above and one of an unknown type."""
        unknown = self._plain_requests(self.spark.range(1), F.lit(3 * 10**15), 9)
        return (self.prediction_requests.unionByName(self.profile_requests)
                .unionByName(self.report_requests).unionByName(unknown))
