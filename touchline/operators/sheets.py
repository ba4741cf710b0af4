"""Team sheets: flattening of match records, and who played how long.

A match record already holds both teams in one row, so minutes played are worked out
inside the record with array functions and need no shuffle at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import formulas


def _array(name: str) -> Column:
    """A possibly missing array of the formation as an empty one."""
    return F.coalesce(F.col(f"formation.{name}"), F.array())


def team_sheets(matches: DataFrame) -> DataFrame:
    """One row per team with a formation in a played match."""
    teams = F.map_values("teamsData")
    formed = F.filter(teams, lambda t: t["hasFormation"] == 1)
    return (
        matches.where(F.col("status") == "Played")
        .select(
            F.col("wyId").alias("matchId"),
            "match_date",
            (F.size(formed) == 2).alias("both_formed"),
            F.explode(formed).alias("team"),
        )
        .select("matchId", "match_date", "both_formed", "team.teamId", "team.formation")
    )


def match_dates(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("wyId").alias("matchId"), "match_date")


def formation_entries(sheets: DataFrame) -> DataFrame:
    """Bench and lineup places as rows, with the goals and cards noted on the sheet."""
    def tagged(section: str) -> Column:
        return F.transform(_array(section), lambda e, i: F.struct(
            F.lit(section).alias("section"), i.alias("place"), e.alias("entry")))

    return sheets.select(
        "matchId", "match_date", "teamId",
        F.explode(F.concat(tagged("bench"), tagged("lineup"))).alias("row"),
    ).select("matchId", "match_date", "teamId", "row.section", "row.place", "row.entry.*")


def substitutions(sheets: DataFrame) -> DataFrame:
    return sheets.select("matchId", "teamId", F.inline(_array("substitutions")))


def appearances(sheets: DataFrame) -> DataFrame:
    """Everyone on a sheet with the share of the match played.

    ``played`` is true for starters and for bench players who came on; ``in_chemistry`` for
    those who finished the match or came on, when both teams handed in a formation.
    """
    def ids(section: str, started: bool) -> Column:
        return F.transform(_array(section), lambda e: F.struct(
            e["playerId"].alias("playerId"), F.lit(started).alias("started")))

    def minute(side: str) -> Column:
        mine = F.filter("subs", lambda s: s[side] == F.col("playerId"))
        return F.get(mine, F.lit(0))["minute"]

    rows = sheets.select(
        "matchId", "match_date", "both_formed", "teamId",
        _array("substitutions").alias("subs"),
        F.inline(F.concat(ids("lineup", True), ids("bench", False))),
    )
    timed = rows.withColumns({
        "came_on": F.when(~F.col("started"), minute("playerIn")),
        "went_off": minute("playerOut"),
    })
    came_on = F.col("came_on").isNotNull()
    finished = F.col("started") & F.col("went_off").isNull()
    return timed.select(
        "matchId", "match_date", "teamId", "playerId",
        formulas.time_weight(F.col("started"), F.col("came_on"), F.col("went_off"))
        .alias("time_weight"),
        (F.col("started") | came_on).alias("played"),
        (F.col("both_formed") & (finished | came_on)).alias("in_chemistry"),
    )


def closing_squads(sheets: DataFrame) -> DataFrame:
    """Per team: starters who were not taken off, bench players who never came on."""
    def ids(array: str, field: str) -> Column:
        return F.transform(_array(array), lambda e: e[field])

    stayed = F.array_except(ids("lineup", "playerId"), ids("substitutions", "playerOut"))
    unused = F.array_except(ids("bench", "playerId"), ids("substitutions", "playerIn"))
    return sheets.select("matchId", "teamId", stayed.alias("stayed_on"), unused.alias("unused"))
