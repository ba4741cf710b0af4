"""Answers to the three request types, for a whole table of requests per plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import formulas, text
from touchline.operators import squads
from touchline.operators.smoothing import smooth_ratings
from touchline.operators.sheets import formation_entries
from touchline.plans.season import Season, smoothed_by_name
from touchline.sources.sinks import materialise

WIN_PREDICTION, PLAYER_PROFILE, MATCH_REPORT = 1, 2, 3

PROFILE_FIELDS = ["name", "birthArea", "birthDate", "foot", "role", "height", "passportArea",
                  "weight", "fouls", "goals", "own_goals", "percent_pass_accuracy",
                  "percent_shots_on_target"]
REPORT_FIELDS = ["date", "duration", "label", "winner", "venue", "gameweek", "goals",
                 "own_goals", "yellow_cards", "red_cards"]


def of_type(requests: DataFrame, req_type: int) -> DataFrame:
    return requests.where(F.col("req_type") == req_type)


def judged_squads(requests: DataFrame, season: Season, smoothing: bool = True,
                  clusters: DataFrame | None = None) -> DataFrame:
    """Squads of all prediction requests with the verdict on each.

    With ``smoothing`` the rating of players with few matches is their cluster's mean; the
    clustering is fitted once for a season, or given as (Id, prediction). It can be left out
    when no such player is asked for.
    """
    if smoothing and clusters is None:
        named = season.smoothed_names
    elif smoothing:
        smoothed = smooth_ratings(season.profiles, clusters=clusters)
        named = materialise(smoothed_by_name(smoothed), "smoothed-names")
    else:
        named = season.rated_names
    return squads.verdict(squads.squads(squads.named_places(requests, named)))


def win_predictions(requests: DataFrame, season: Season, smoothing: bool = True,
                    clusters: DataFrame | None = None) -> DataFrame:
    """Winning chances per request, or the message why there are none."""
    asked = of_type(requests, WIN_PREDICTION)
    judged = judged_squads(asked, season, smoothing, clusters)
    chances = squads.win_chances(squads.team_strengths(judged, season.chemistry))
    verdicts = judged.select("request_seq", "msg", "detail")
    valid = F.col("msg").isNull()
    names = asked.select("request_seq", F.col("team1.name").alias("name1"),
                         F.col("team2.name").alias("name2"))
    return names.join(verdicts, "request_seq").join(chances, "request_seq", "left").select(
        "request_seq", "name1", "name2",
        F.when(valid, F.col("chance1")).alias("chance1"),
        F.when(valid, F.col("chance2")).alias("chance2"),
        "msg", "detail")


def profile_answers(requests: DataFrame, by_name: DataFrame) -> DataFrame:
    """The thirteen profile fields per request, or the message that nobody has the name."""
    asked = of_type(requests, PLAYER_PROFILE).select("request_seq", F.col("name").alias("asked"))
    accuracy = F.when(F.col("normalPasses") + F.col("keyPasses") > 0, F.col("passAcc"))
    on_target = F.try_divide("shotsOnTarget", "totalShots")
    fields = by_name.select(
        "name", "birthArea", text.iso_date(F.col("birthDate")).alias("birthDate"), "foot", "role",
        "height", "passportArea", "weight",
        F.col("numFouls").alias("fouls"), F.col("numGoals").alias("goals"),
        F.col("numOwnGoals").alias("own_goals"),
        formulas.percent(accuracy).alias("percent_pass_accuracy"),
        formulas.percent(on_target).alias("percent_shots_on_target"))
    found = asked.join(fields, F.col("asked") == F.col("name"), "left")
    msg = F.when(F.col("name").isNull(), F.lit("Player Not Found")).alias("msg")
    return found.select("request_seq", *PROFILE_FIELDS, msg)


def first_matches(matches: DataFrame) -> DataFrame:
    """The match with the lowest id per (label, date); reduced on the map side first."""
    rank = F.row_number().over(Window.partitionBy("label", "match_date").orderBy("wyId"))
    return matches.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def report_entries(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Sheet entries with a goal or card, in the order team, bench before lineup, place."""
    both = matches.where((F.col("status") == "Played") & (F.size("teamsData") == 2))
    sheets = both.select(F.col("wyId").alias("matchId"), "match_date",
                         F.inline(F.map_values("teamsData"))).where("hasFormation = 1")
    noted = formation_entries(sheets).where(
        "goals != '0' OR ownGoals != '0' OR yellowCards != '0' OR redCards != '0'")
    names = players.select(F.col("Id").alias("playerId"), F.col("name").alias("player"))
    team_names = teams.select(F.col("Id").alias("teamId"), F.col("name").alias("team"))
    # Someone missing from a table is reported under the id.
    return (noted.join(names, "playerId", "left").join(team_names, "teamId", "left")
            .withColumn("player", F.coalesce("player", F.col("playerId").cast("string")))
            .withColumn("team", F.coalesce("team", F.col("teamId").cast("string"))))


def report_lists(entries: DataFrame) -> DataFrame:
    """Goals, own goals and cards per match as ordered lists.

    The entries of a match come from one match record and so fit in one row again.
    """
    row = F.struct("teamId", "section", "place", "player", "team", "goals", "ownGoals",
                   "yellowCards", "redCards")
    grouped = entries.groupBy("matchId").agg(F.array_sort(F.collect_list(row)).alias("rows"))

    def scorers(count: str):
        # Only numbers above 0 count; the feed also has texts such as "null".
        hits = F.filter("rows", lambda r: r[count].try_cast("int") > 0)
        return F.transform(hits, lambda r: F.struct(
            r["player"].alias("name"), r["team"].alias("team"),
            r[count].try_cast("int").alias("number_of_goals")))

    def carded(card: str):
        return F.transform(F.filter("rows", lambda r: r[card] != "0"), lambda r: r["player"])

    return grouped.select(
        "matchId", scorers("goals").alias("goals"), scorers("ownGoals").alias("own_goals"),
        carded("yellowCards").alias("yellow_cards"), carded("redCards").alias("red_cards"))


def reports_by_match(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """The finished report of every given match, with the message if there is nothing to report."""
    winners = teams.select(F.col("Id").alias("winner"), F.col("name").alias("winner_name"))
    lists = report_lists(report_entries(matches, players, teams))
    header = matches.drop("teamsData", "date")
    found = header.join(winners, "winner", "left").join(
        lists.withColumnRenamed("matchId", "wyId"), "wyId", "left")
    winner = F.when(F.col("winner") == 0, F.lit("None")).otherwise(F.col("winner_name"))
    msg = (
        F.when(F.coalesce(F.col("status") != "Played", F.lit(True)),
               text.not_played(F.coalesce("status", F.lit("None"))))
        .when(winner.isNull(), F.lit("Invalid Data"))
    )
    lists_or_empty = [F.coalesce(n, F.array()).alias(n) for n in REPORT_FIELDS[6:]]
    return found.select(
        "match_date", text.iso_date(F.col("match_date")).alias("date"), "duration", "label",
        winner.alias("winner"), "venue", "gameweek", *lists_or_empty, msg.alias("msg"))


def match_reports(requests: DataFrame, season: Season) -> DataFrame:
    """Report per request on (label, date), or the message why there is none.

    Matches nobody asked about are dropped first; a match asked about often is reported once and
    its report then joined to the requests.
    """
    asked = of_type(requests, MATCH_REPORT).select(
        "request_seq", F.col("label").alias("asked_label"),
        F.col("date").try_cast("date").alias("asked_date"))
    wanted = asked.select(F.col("asked_label").alias("label"),
                          F.col("asked_date").alias("match_date")).distinct()
    matches = first_matches(season.matches.join(wanted, ["label", "match_date"], "left_semi"))
    reports = reports_by_match(matches, season.players, season.teams)
    same = (F.col("asked_label") == F.col("label")) & (F.col("asked_date") == F.col("match_date"))
    found = asked.join(reports, same, "left")
    msg = F.when(F.col("label").isNull(), F.lit("No Matches found")).otherwise(F.col("msg"))
    valid = F.col("label").isNotNull() & F.col("msg").isNull()
    return found.select(
        "request_seq", *[F.when(valid, F.col(n)).alias(n) for n in REPORT_FIELDS], msg.alias("msg"))


def _answer(fields: DataFrame, req_type: int, body: list) -> DataFrame:
    """JSON answer per request: the body, or only the message."""
    message = F.to_json(F.struct("msg"))
    answer = F.when(F.col("msg").isNotNull(), message).otherwise(
        F.to_json(F.struct(*body), {"ignoreNullFields": "false"}))
    return fields.select("request_seq", F.lit(req_type).alias("req_type"), answer.alias("response"))


def answer_requests(requests: DataFrame, season: Season, smoothing: bool = True,
                    clusters: DataFrame | None = None) -> DataFrame:
    """Every request with its JSON answer, whatever its type."""
    teams = [F.struct(F.col(f"name{t}").alias("name"), F.col(f"chance{t}").alias("winning chance"))
             .alias(f"team{t}") for t in (1, 2)]
    known = F.coalesce(
        F.col("req_type").isin(WIN_PREDICTION, PLAYER_PROFILE, MATCH_REPORT), F.lit(False))
    invalid = requests.where(~known).select(
        "request_seq", "req_type", F.to_json(F.struct(F.lit("Invalid request").alias("msg")))
        .alias("response"))
    return (
        _answer(win_predictions(requests, season, smoothing, clusters), WIN_PREDICTION, teams)
        .unionByName(_answer(profile_answers(requests, season.by_name), PLAYER_PROFILE,
                             [F.col(c) for c in PROFILE_FIELDS]))
        .unionByName(_answer(match_reports(requests, season), MATCH_REPORT,
                             [F.col(c) for c in REPORT_FIELDS]))
        .unionByName(invalid)
    )
