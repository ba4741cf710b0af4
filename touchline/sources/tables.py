"""Scans of the dimension and request tables, and their registration for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import schemas
from touchline.functions import codes
from touchline.sources import numbering

CAREER_COUNTERS = [
    "numFouls", "numGoals", "numOwnGoals", "passAcc", "shotsOnTarget", "normalPasses",
    "keyPasses", "accNormalPasses", "accKeyPasses", "numMatches",
]


def read_players(spark: SparkSession, path: str) -> DataFrame:
    """Player file with header. Only the attributes are kept; counters come from events."""
    rows = spark.read.schema(schemas.ddl(schemas.PLAYER)).option("header", True).csv(path)
    return rows.select(*schemas.PLAYER_ATTRIBUTES)


def read_teams(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ddl(schemas.TEAM)).option("header", True).csv(path)


def read_requests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One JSON request per line, numbered in file and line order."""
    return parse_requests(numbering.numbered(numbering.text_lines(spark, path), "request_seq"))


def parse_requests(lines: DataFrame) -> DataFrame:
    """Fields of request lines (``value``) that are numbered in ``request_seq``."""
    request = F.from_json("value", schemas.ddl(schemas.REQUEST)).alias("r")
    return lines.select("request_seq", request).select("request_seq", "r.*")


def with_career_defaults(players: DataFrame) -> DataFrame:
    """Every counter at 0 and both ratings at their start value."""
    start = F.lit(codes.INITIAL_RATING)
    defaults = {c: F.lit(0) for c in CAREER_COUNTERS}
    return players.withColumns({**defaults, "rating": start, "previousRating": start})


def register(**frames: DataFrame) -> None:
    """Make the frames available to SQL under the given view names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def player_ids(spark: SparkSession, view: str = "Player") -> DataFrame:
    return spark.sql(f"SELECT Id FROM {view}")
