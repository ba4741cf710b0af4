"""Requested squads: who they name, whether they are valid, and how strong they are.

A prediction request names two squads of eleven. Everything about the 22 places of a request
is gathered once, in an array whose length the request format fixes; validity is then plain
expressions over it and team strength needs one chemistry lookup per unordered pair.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import codes, formulas, text
from touchline.operators.chemistry import lookup


def squad_places(requests: DataFrame) -> DataFrame:
    """Prediction requests as one row per named place: (request_seq, team, slot, name)."""
    def squad(team: int) -> str:
        names = ", ".join(f"team{team}.{slot}" for slot in schemas.SQUAD_SLOTS)
        return (f"transform(array({names}), (n, i) ->"
                f" struct({team} AS team, i + 1 AS slot, n AS name))")

    return requests.where("req_type = 1").selectExpr(
        "request_seq", f"inline(concat({squad(1)}, {squad(2)}))")


def named_places(requests: DataFrame, by_name: DataFrame) -> DataFrame:
    """Places beside the player they name; a hot name is split, never gathered."""
    cols = ["name", "namesakes", "Id", "role", "rating"]
    return squad_places(requests).join(by_name.select(*cols), "name", "left")


def role_counts(places: DataFrame) -> DataFrame:
    """Keepers, defenders, midfielders and forwards per squad."""
    return places.groupBy("request_seq", "team").agg(
        *[F.count_if(F.col("role") == r).alias(r) for r in ("GK", "DF", "MD", "FW")])


def valid_squad(count_of_role: Callable[[str], str]) -> str:
    """Condition for a valid squad, given the text that counts a role."""
    return (f"{count_of_role('GK')} = 1 AND {count_of_role('DF')} >= 3"
            f" AND {count_of_role('MD')} >= 2 AND {count_of_role('FW')} >= 1")


def squads(places: DataFrame) -> DataFrame:
    """One row per request: the 22 places in an array, and the verdict on them.

    ``profiles`` counts the player rows that match any requested name: a repeated name lowers
    it, a namesake raises it. ``eligible`` requests get a strength.
    """
    gathered = places.groupBy("request_seq").agg(F.expr(
        "array_sort(collect_list(struct(team, slot, name, namesakes, Id, role, rating)))"
        " AS places"))

    def valid(team: int) -> str:
        return valid_squad(
            lambda role: f"size(filter(places, p -> p.team = {team} AND p.role = '{role}'))")

    # Places are checked slot by slot, the first team before the second.
    judged = gathered.selectExpr(
        "request_seq", "places", f"{valid(1)} AS valid1", f"{valid(2)} AS valid2",
        """aggregate(array_distinct(transform(filter(places, p -> p.Id IS NOT NULL),
             p -> struct(p.name AS name, p.namesakes AS n))), 0L, (s, d) -> s + d.n) AS profiles""",
        """array_sort(transform(filter(places, p -> p.Id IS NULL),
             p -> struct(p.slot, p.team, p.name))) AS missing""",
        f"exists(places, p -> coalesce(p.rating < {codes.RETIRED_BELOW}, false)) AS retired")
    return judged.selectExpr(
        "request_seq", "places", "valid1", "valid2", "profiles", "get(missing, 0).name AS missing",
        "size(missing) > 0 AS any_missing", "retired",
        f"profiles = {2 * codes.SQUAD_SIZE} AND size(missing) = 0 AND NOT retired AS eligible")


def squad_pairs(judged: DataFrame) -> DataFrame:
    """The 55 unordered pairs of places of each squad, with both ratings.

    The number of pairs is fixed by the eleven places of the request format.
    """
    pairs = """inline(flatten(transform(places, p -> transform(
        filter(places, q -> q.team = p.team AND q.slot > p.slot), q -> struct(p AS a, q AS b)))))"""
    return judged.selectExpr("request_seq", pairs).selectExpr(
        "request_seq", "a.team AS team", "a.slot AS slot1", "b.slot AS slot2",
        "a.rating AS rating1", "b.rating AS rating2",
        "least(a.Id, b.Id) AS player1", "greatest(a.Id, b.Id) AS player2")


def player_strengths(judged: DataFrame, chemistry: DataFrame) -> DataFrame:
    """Rating times mean chemistry with the ten team-mates, per place of eligible requests."""
    found = lookup(squad_pairs(judged.where("eligible")), chemistry)
    both = F.array(
        F.struct(F.col("slot1").alias("slot"), F.col("rating1").alias("rating")),
        F.struct(F.col("slot2").alias("slot"), F.col("rating2").alias("rating")))
    places = found.select("request_seq", "team", "chemistry", F.inline(both))
    means = places.groupBy("request_seq", "team", "slot").agg(
        F.avg("chemistry").alias("mean_chemistry"), F.first("rating").alias("rating"))
    strength = formulas.player_strength(F.col("rating"), F.col("mean_chemistry"))
    return means.withColumn("strength", strength)


def team_strengths(judged: DataFrame, chemistry: DataFrame) -> DataFrame:
    """Mean player strength of both squads of eligible requests.

    Same value as summing the player strengths: each pair's chemistry enters the strength of
    both its players, so one pass over the unordered pairs gives the team's sum.
    """
    found = lookup(squad_pairs(judged.where("eligible")), chemistry)
    mates = codes.SQUAD_SIZE - 1
    share = F.col("chemistry") * (F.col("rating1") + F.col("rating2"))

    def strength(team: int) -> Column:
        total = F.sum(F.when(F.col("team") == team, share))
        return (total / (mates * codes.SQUAD_SIZE)).alias(f"strength{team}")

    return found.groupBy("request_seq").agg(strength(1), strength(2))


def win_chances(strengths: DataFrame) -> DataFrame:
    chance = formulas.winning_chance(F.col("strength1"), F.col("strength2"))
    return strengths.withColumns({"chance1": chance, "chance2": 100 - chance})


def verdict(judged: DataFrame) -> DataFrame:
    """``msg`` is the message that is answered (NULL for a valid request), ``detail`` the first
    reason found on the way."""
    nobody = F.when(~F.col("eligible"), F.lit("Player Does Not Exist"))
    team1 = F.when(~F.col("valid1"), F.lit("Team 1 is Invalid"))
    team2 = F.when(~F.col("valid2"), F.lit("Team 2 is Invalid"))
    missing = F.when(F.col("any_missing"), F.coalesce(
        text.missing_player(F.col("missing")), F.lit("Player Does Not Exist")))
    return judged.withColumns({
        "msg": F.coalesce(nobody, team2, team1),
        "detail": F.coalesce(missing, team1, team2, nobody),
    })
