"""Career profiles, and how a name leads to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import codes

COUNTERS = ["numFouls", "numGoals", "numOwnGoals", "shotsOnTarget", "totalShots",
            "normalPasses", "keyPasses", "accNormalPasses", "accKeyPasses"]


def player_profiles(players: DataFrame, totals: DataFrame, latest: DataFrame) -> DataFrame:
    """Every player with career counters and current rating, defaults where there is none."""
    rated = players.join(totals.withColumnRenamed("playerId", "Id"), "Id", "left").join(
        latest.withColumnRenamed("playerId", "Id"), "Id", "left")
    return rated.fillna(0, subset=[*COUNTERS, "numMatches"]).fillna(0.0, subset=["passAcc"]).fillna(
        codes.INITIAL_RATING, subset=["rating"])


def first_by_name(profiles: DataFrame) -> DataFrame:
    """One row per name: the number of namesakes, and the one with the lowest id.

    Reduced before any join, so a name shared by many players never multiplies requests.
    """
    values = [c for c in profiles.columns if c != "name"]
    row = F.min(F.struct("Id", *[c for c in values if c != "Id"])).alias("p")
    return profiles.groupBy("name").agg(F.count("*").alias("namesakes"), row).select(
        "name", "namesakes", *[f"p.{c}" for c in values])
