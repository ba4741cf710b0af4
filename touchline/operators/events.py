"""Row-level event operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import codes

TAG_FLAGS = {
    "t_goal": codes.GOAL,
    "t_own_goal": codes.OWN_GOAL,
    "t_key": codes.KEY_PASS,
    "t_lost": codes.DUEL_LOST,
    "t_neutral": codes.DUEL_NEUTRAL,
    "t_won": codes.DUEL_WON,
    "t_acc": codes.ACCURATE,
    "t_inacc": codes.INACCURATE,
}


def flag_events(events: DataFrame) -> DataFrame:
    """One boolean per tag, so that each tag array is searched once per tag and row."""
    flags = [f"coalesce(array_contains(tag_ids, {tag}), false) AS {name}"
             for name, tag in TAG_FLAGS.items()]
    penalty = f"coalesce(subEventId = {codes.PENALTY}, false) AS is_penalty"
    return events.selectExpr("*", *flags, penalty)


def of_known_players(frame: DataFrame, players: DataFrame) -> DataFrame:
    """Rows whose ``playerId`` is in the player table.

    A semi join: Spark broadcasts the ids while they are small by its own size check and
    otherwise splits a hot player's rows at run time.
    """
    return frame.join(players.select(F.col("Id").alias("playerId")), "playerId", "left_semi")


def with_match(events: DataFrame, matches: DataFrame) -> DataFrame:
    """Events beside the header of their match."""
    header = matches.select(
        F.col("wyId").alias("matchId"), "status", "match_date", "label", "gameweek", "venue"
    )
    return events.join(header, "matchId")
