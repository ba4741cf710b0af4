"""The registered queries: every operator over the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.operators import chemistry, events, metrics, ordered, sheets, smoothing, squads
from touchline.plans import requests as answers
from touchline.plans.season import Season
from touchline.sources import files, numbering, records, sinks, tables
from touchline.sources.bridge import Bridge

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

KEYS = ["matchId", "playerId"]
HEADER = ["wyId", "status", "match_date", "label", "duration", "winner", "venue", "gameweek"]


def query(build: Callable[[Bridge], DataFrame]) -> Callable[[Bridge], DataFrame]:
    """Register a query under the name of its function."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Bridge(spark, sf_dir))
    return build


def settled(value: Column) -> Column:
    """Six decimals for comparison. Many values are short decimals that sit exactly on a rounding
    tie, where the last bit would decide; the shift takes both engines off the tie."""
    return F.round(value + F.lit(1e-10), 6)


def rounded(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: settled(F.col(n)) for n in names})


# Scans and decoding


@query
def scan_players(b: Bridge) -> DataFrame:
    tables.register(Player=tables.with_career_defaults(b.players))
    names = ", ".join(["Id", "name", "role", "height", "weight", *tables.CAREER_COUNTERS, "rating",
                       "previousRating"])
    return b.spark.sql(f"SELECT {names} FROM Player")


@query
def scan_teams(b: Bridge) -> DataFrame:
    tables.register(Teams=b.teams)
    return b.spark.sql("SELECT Id, name FROM Teams")


@query
def players_from_csv(b: Bridge) -> DataFrame:
    """Player file written with header in the file's column order and read back by schema."""
    path = sinks.shared_folder(b.spark, "players-csv")
    known = tables.with_career_defaults(b.players)
    known.select(*schemas.PLAYER).write.option("header", True).csv(path)
    return tables.read_players(b.spark, path).select(
        "Id", "name", "role", "height", "weight", "birthArea", "foot", "passportArea",
        F.col("birthDate").cast("date").alias("birthDate"))


@query
def teams_from_csv(b: Bridge) -> DataFrame:
    """Team file written with header and read back by schema."""
    path = sinks.shared_folder(b.spark, "teams-csv")
    b.teams.select(*schemas.TEAM).write.option("header", True).csv(path)
    return tables.read_teams(b.spark, path)


@query
def player_ids(b: Bridge) -> DataFrame:
    tables.register(Player=b.players)
    return tables.player_ids(b.spark)


@query
def preview_players(b: Bridge) -> DataFrame:
    return b.players.select("Id", "name", "role", "height", "weight").orderBy("Id").limit(5)


def event_lines(b: Bridge) -> DataFrame:
    return records.event_line(b.events)


def match_lines(b: Bridge) -> DataFrame:
    return records.match_line(b.season.matches)


@query
def events_typed(b: Bridge) -> DataFrame:
    """Event lines decoded, routed, kept for known players and flagged by tag."""
    typed = records.read_events(event_lines(b))
    flagged = events.flag_events(events.of_known_players(typed, b.players))
    return flagged.select(*KEYS, "eventId", "subEventId", *events.TAG_FLAGS)


@query
def events_with_match(b: Bridge) -> DataFrame:
    known = events.of_known_players(b.events, b.players)
    return events.with_match(known, b.season.matches).select(
        "event_id", *KEYS, "eventId", "status", "match_date", "label", "gameweek", "venue")


@query
def feed_lines(b: Bridge) -> DataFrame:
    """The whole feed written as text files and read back: every line with its number."""
    known = events.of_known_players(b.events, b.players)
    path = sinks.shared_folder(b.spark, "feed")
    records.feed_lines(known, b.season.matches).select("value").write.text(path)
    lines = numbering.numbered(numbering.text_lines(b.spark, path), "line_no")
    label = F.get_json_object("value", "$.label")
    return lines.select("line_no", F.when(label.isNull(), F.col("value")).alias("event"),
                        label.alias("label"))


@query
def match_dates(b: Bridge) -> DataFrame:
    return records.read_matches(match_lines(b)).select("wyId", "status", "match_date")


def decoded_sheets(b: Bridge) -> DataFrame:
    return sheets.team_sheets(records.read_matches(match_lines(b)))


@query
def formation_flat(b: Bridge) -> DataFrame:
    return sheets.formation_entries(decoded_sheets(b)).drop("match_date", "place")


@query
def substitutions_flat(b: Bridge) -> DataFrame:
    return sheets.substitutions(decoded_sheets(b))


@query
def append_matches(b: Bridge) -> DataFrame:
    """Every header is sent a second time; each match is stored once."""
    stored = records.read_matches(match_lines(b)).select(*HEADER)
    return sinks.append_matches(stored, b.season.matches.select(*HEADER))


# Counters and ratios


def counters_query(name: str, build: Callable) -> None:
    def run(b: Bridge) -> DataFrame:
        return events.of_known_players(metrics.count_events(b.events, build()), b.players)

    run.__name__ = name
    query(run)


counters_query("pass_counters", metrics.pass_counters)
counters_query("duel_counters", metrics.duel_counters)
counters_query("freekick_counters", metrics.freekick_counters)
counters_query("shot_counters", metrics.shot_counters)
counters_query("goals_fouls_owngoals", metrics.discipline_counters)


def ratio_query(name: str, ratio: str, build: Callable) -> None:
    def run(b: Bridge) -> DataFrame:
        counted = events.of_known_players(metrics.count_events(b.events, build()), b.players)
        return counted.select(*KEYS, settled(metrics.ratios()[ratio]).alias(ratio))

    run.__name__ = name
    query(run)


ratio_query("pass_accuracy", "passAccuracy", metrics.pass_counters)
ratio_query("duel_effectiveness", "duelEffectiveness", metrics.duel_counters)
ratio_query("freekick_effectiveness", "freeKick", metrics.freekick_counters)
ratio_query("shots_effectiveness", "shotsEffectiveness", metrics.shot_counters)


@query
def player_match_metrics(b: Bridge) -> DataFrame:
    return rounded(b.lineup_season.metrics, *metrics.ratios())


@query
def match_metric_rows(b: Bridge) -> DataFrame:
    season = b.lineup_season
    rows = metrics.metric_rows(season.appearances, season.metrics)
    names = [*metrics.ratios(), "contribution"]
    return rounded(rows.select(*KEYS, "teamId", *metrics.COUNTERS, *names), *names)


@query
def career_totals(b: Bridge) -> DataFrame:
    season = b.lineup_season
    totals = metrics.career_totals(season.metrics).drop("shotsOnTargetRatio")
    matches = season.appearances.where("played").groupBy("playerId").agg(
        F.count("*").alias("numMatches"))
    joined = totals.join(matches, "playerId", "left").fillna(0, ["numMatches"])
    return rounded(joined, "passAcc")


# Minutes, contribution, ratings


@query
def closing_squads(b: Bridge) -> DataFrame:
    closing = sheets.closing_squads(b.sheets)

    def rows(array: str, stayed: bool) -> DataFrame:
        return closing.select("matchId", "teamId", F.explode(array).alias("playerId"),
                              F.lit(stayed).alias("stayed_on"))

    return rows("stayed_on", True).unionByName(rows("unused", False))


@query
def appearance_weights(b: Bridge) -> DataFrame:
    return rounded(b.lineup_season.appearances, "time_weight")


@query
def player_contribution(b: Bridge) -> DataFrame:
    rows = b.lineup_season.career_rows.select(*KEYS, "teamId", "played", "contribution")
    return rounded(rows, "contribution")


@query
def player_performance(b: Bridge) -> DataFrame:
    rows = b.lineup_season.history.select(*KEYS, "performance", "careerFouls", "careerOwnGoals")
    return rounded(rows, "performance")


HISTORY = ["playerId", "matchId", "teamId", "contribution", "performance", "previous_rating",
           "rating", "numMatches"]


@query
def rating_history(b: Bridge) -> DataFrame:
    return rounded(b.lineup_season.history.select(*HISTORY), *HISTORY[3:7])


@query
def rating_latest(b: Bridge) -> DataFrame:
    return rounded(b.lineup_season.latest, "rating")


@query
def career_running_totals(b: Bridge) -> DataFrame:
    totals = {"careerFouls": F.col("foulLoss"), "careerOwnGoals": F.col("ownGoals"),
              "numMatches": F.col("played").cast("bigint")}
    rows = ordered.running_totals(
        b.lineup_season.career_rows, ["playerId"], ["match_date", "matchId"], totals)
    return rows.select(*KEYS, *totals)


# Chemistry


def pairs_of(b: Bridge) -> DataFrame:
    pairs = chemistry.match_pairs(chemistry.participants(b.lineup_season.history))
    return rounded(pairs, "move1", "move2")


PAIR_ROW = ["player1", "player2", "matchId", "move1", "move2"]


@query
def same_team_pairs(b: Bridge) -> DataFrame:
    return pairs_of(b).where("same_team").select(*PAIR_ROW)


@query
def opposite_team_pairs(b: Bridge) -> DataFrame:
    return pairs_of(b).where("NOT same_team").select(*PAIR_ROW)


@query
def chemistry_deltas(b: Bridge) -> DataFrame:
    return rounded(b.lineup_season.deltas.drop("match_date"), "delta")


@query
def chemistry_latest(b: Bridge) -> DataFrame:
    return rounded(b.lineup_season.chemistry, "chemistry")


@query
def chemistry_as_of(b: Bridge) -> DataFrame:
    rows = chemistry.chemistry_as_of(b.lineup_season.deltas)
    return rounded(rows.select("player1", "player2", "matchId", "chemistry"), "chemistry")


@query
def chemistry_dense(b: Bridge) -> DataFrame:
    """All pairs of every team's squad, at the start value where two never shared a pitch."""
    squad = b.players.select("teamId", F.col("Id").alias("playerId"))
    found = chemistry.dense_chemistry(squad, b.lineup_season.with_stored("chemistry").chemistry,
                                      ["teamId"])
    return rounded(found, "chemistry")


# Requests


def prediction_season(b: Bridge) -> Season:
    """Season whose ratings, names and chemistry are tables."""
    return b.lineup_season.with_stored("counts", "history", "profiles", "rated_names", "chemistry")


def judged(b: Bridge, season: Season) -> DataFrame:
    return answers.judged_squads(b.requests, season)


@query
def chemistry_lookup(b: Bridge) -> DataFrame:
    season = prediction_season(b)
    places = squads.squads(squads.named_places(b.prediction_requests, season.rated_names))
    found = chemistry.lookup(squads.squad_pairs(places), season.chemistry)
    return rounded(found.select("request_seq", "team", "slot1", "slot2", "chemistry"), "chemistry")


@query
def squad_roles(b: Bridge) -> DataFrame:
    season = b.lineup_season.with_stored("rated_names")
    return squads.role_counts(squads.named_places(b.prediction_requests, season.rated_names))


@query
def squad_validity(b: Bridge) -> DataFrame:
    return judged(b, b.lineup_season.with_stored("counts", "profiles")).select(
        "request_seq", "valid1", "valid2", "profiles", "any_missing", "retired", "eligible")


@query
def player_strength(b: Bridge) -> DataFrame:
    season = prediction_season(b)
    rows = squads.player_strengths(judged(b, season), season.chemistry).drop("rating")
    return rounded(rows, "mean_chemistry", "strength")


@query
def team_strength(b: Bridge) -> DataFrame:
    season = prediction_season(b)
    return rounded(squads.team_strengths(judged(b, season), season.chemistry),
                   "strength1", "strength2")


@query
def win_chances(b: Bridge) -> DataFrame:
    season = prediction_season(b)
    strengths = squads.team_strengths(judged(b, season), season.chemistry)
    chances = squads.win_chances(strengths).drop("strength1", "strength2")
    return rounded(chances, "chance1", "chance2")


@query
def predict_responses(b: Bridge) -> DataFrame:
    predictions = answers.win_predictions(b.requests, prediction_season(b))
    return rounded(predictions, "chance1", "chance2")


@query
def predict_smoothed(b: Bridge) -> DataFrame:
    """Ratings that predictions use: players with few matches are rated by their cluster."""
    season = b.lineup_season.with_stored("counts", "profiles")
    smoothed = smoothing.smooth_ratings(season.profiles)
    return rounded(smoothed.select("Id", "numMatches", "prediction", "rating", "smoothed_rating"),
                   "rating", "smoothed_rating")


@query
def cluster_smoothing(b: Bridge) -> DataFrame:
    """Size and mean rating of every cluster."""
    season = b.lineup_season.with_stored("counts", "profiles")
    smoothed = smoothing.smooth_ratings(season.profiles)
    means = smoothed.groupBy("prediction").agg(
        F.count("*").alias("players"), F.count_if(F.col("numMatches") < 5).alias("rookies"),
        F.avg("rating").alias("mean_rating"), F.avg("smoothed_rating").alias("mean_smoothed"))
    return rounded(means, "mean_rating", "mean_smoothed")


@query
def player_profile(b: Bridge) -> DataFrame:
    season = b.lineup_season.with_stored("counts", "by_name")
    return answers.profile_answers(b.profile_requests, season.by_name)


def stored_matches(b: Bridge) -> Season:
    """Season whose match records are a table, as they are outside of the test bridge."""
    stored = b.season.with_stored("matches")
    b.__dict__["match_records"] = stored.matches
    return stored


@query
def match_report(b: Bridge) -> DataFrame:
    season = stored_matches(b)
    reports = answers.match_reports(b.report_requests, season)
    lists = ["goals", "own_goals", "yellow_cards", "red_cards"]
    return reports.withColumns({c: F.to_json(c) for c in lists})


def noted_entries(b: Bridge) -> DataFrame:
    season = b.season
    return answers.report_entries(season.matches, season.players, season.teams).withColumnRenamed(
        "player", "name")


@query
def match_goals(b: Bridge) -> DataFrame:
    return noted_entries(b).where("goals != '0' OR ownGoals != '0'").select(
        "matchId", "name", "team", F.col("goals").try_cast("bigint").alias("goals"),
        F.col("ownGoals").try_cast("bigint").alias("ownGoals"))


@query
def match_cards(b: Bridge) -> DataFrame:
    return noted_entries(b).where("yellowCards != '0' OR redCards != '0'").select(
        "matchId", "name", "team", "yellowCards", "redCards")


def request_lines(b: Bridge) -> DataFrame:
    fields = [c for c in b.requests.columns if c != "request_seq"]
    return b.requests.select("request_seq", F.to_json(F.struct(*fields)).alias("value"))


def answer_season(b: Bridge) -> Season:
    return stored_matches(b).with_stored("counts", "history", "profiles", "by_name", "chemistry")


def bodies(out: DataFrame, *keys: str) -> DataFrame:
    """Answers as they are, but for the chances, which are numbers to be rounded."""
    def chance(team: int) -> Column:
        path = f"$.team{team}['winning chance']"
        return settled(F.get_json_object("response", path).cast("double")).alias(f"chance{team}")

    names = [F.get_json_object("response", f"$.team{t}.name").alias(f"name{t}") for t in (1, 2)]
    body = F.when(F.get_json_object("response", "$.team1").isNull(), F.col("response"))
    return out.select(*keys, body.alias("body"), *names, chance(1), chance(2))


@query
def request_dispatch(b: Bridge) -> DataFrame:
    """Requests of all types as JSON lines in, answers as JSON lines out."""
    stored = sinks.materialise(request_lines(b), "requests")
    out = answers.answer_requests(tables.parse_requests(stored), answer_season(b))
    return bodies(out, "request_seq", "req_type")


def request_files(b: Bridge, number: int = 3) -> str:
    """Request lines in several files, in order from file to file; answers by what lies before."""
    path = sinks.shared_folder(b.spark, "request-files")
    lines = request_lines(b).repartitionByRange(number, "request_seq").sortWithinPartitions(
        "request_seq")
    lines.select("value").write.text(path)
    return path


#: Splits that small files are read in.
SPLITS = 64
LARGEST_SPLIT = 128 * 1024**2


@contextmanager
def small_splits(b: Bridge, path: str, size: int = 16 * 1024) -> Iterator[None]:
    """Files are read in splits of this size, so that small ones have several too. For larger ones
    splits grow with what lies below ``path``: the driver keeps something for every task."""
    size = max(size, min(files.length(b.spark, path) // SPLITS, LARGEST_SPLIT))
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1k"}
    before = {n: b.spark.conf.get(n) for n in names}
    for n, value in names.items():
        b.spark.conf.set(n, value)
    try:
        yield
    finally:
        for n, value in before.items():
            b.spark.conf.set(n, value)


@query
def requests_numbered(b: Bridge) -> DataFrame:
    """Three files of requests of several splits each, numbered in line order."""
    path = request_files(b)
    with small_splits(b, path):
        found = sinks.materialise(tables.read_requests(b.spark, path), "numbered")
    return found.select("request_seq", "req_type", F.coalesce("name", "label", "team1.name")
                        .alias("asked"), F.col("team1.player1").alias("player1"))


@query
def responses_written(b: Bridge) -> DataFrame:
    """Request files in, a file of answers out: read back, the answers stand in the order of the
    requests."""
    path = request_files(b)
    out = sinks.shared_folder(b.spark, "responses")
    with small_splits(b, path):  # of the request files only, and written once numbered
        requests = sinks.materialise(tables.read_requests(b.spark, path), "numbered")
    sinks.write_responses(answers.answer_requests(requests, answer_season(b)), out)
    lines = numbering.numbered(numbering.text_lines(b.spark, out), "line_no")
    return bodies(lines.withColumnRenamed("value", "response"), "line_no")
