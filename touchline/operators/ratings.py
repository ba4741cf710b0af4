"""Performance and rating of every player after every match.

The rating is a recursion in match order, ``r = (performance + r) / 2``, and performance
shrinks with the fouls and own goals of the career so far. Both are folded per player and
calendar block. A block is a linear map of the rating before it: with ``n`` matches, ``k``
career fouls and ``g`` own goals behind the player it turns ``r`` into
``carry * 0.995^k * 0.95^g + r / 2^n``, where ``carry`` is the fold of the block from
zero. So the blocks' summaries, a handful per career, give each block its starting state,
and the blocks are then replayed independently of each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import codes, formulas
from touchline.operators.ordered import BlockOf, calendar_year

STATE = "STRUCT<rating: DOUBLE, numMatches: BIGINT, fouls: BIGINT, ownGoals: BIGINT>"
GAME = ["match_date", "matchId", "teamId", "played", "in_chemistry", "contribution",
        "foulLoss", "ownGoals"]
RATIOS = ["passAccuracy", "duelEffectiveness", "freeKick", "shotsEffectiveness"]
HISTORY = (
    "ARRAY<STRUCT<match_date: DATE, matchId: BIGINT, teamId: BIGINT, in_chemistry: BOOLEAN,"
    " contribution: DOUBLE, performance: DOUBLE, previous_rating: DOUBLE, rating: DOUBLE,"
    " numMatches: BIGINT, careerFouls: BIGINT, careerOwnGoals: BIGINT>>"
)


def career_rows(appearances: DataFrame, metrics: DataFrame, match_dates: DataFrame) -> DataFrame:
    """One row per player and match: the team-sheet place and what was counted.

    A player with events but no place on the sheet is kept (not played), because fouls and
    own goals of the career count wherever they happened. The metrics come in as they leave
    their aggregation, so this join needs no further shuffle of them. Players that are not in
    the player table do no harm here: nobody asks for their rating.
    """
    mean = formulas.contribution(*(F.col(r) for r in RATIOS))
    counted = metrics.select("matchId", "playerId", "foulLoss", "ownGoals", mean.alias("mean"))
    rows = appearances.join(counted, ["matchId", "playerId"], "full")
    dates = match_dates.select("matchId", F.col("match_date").alias("header_date"))
    dated = rows.join(dates, "matchId", "left").selectExpr(
        "playerId", "matchId", "teamId", "coalesce(match_date, header_date) AS match_date",
        "coalesce(played, false) AS played", "coalesce(in_chemistry, false) AS in_chemistry",
        "coalesce(time_weight * coalesce(mean, 0.0D), 0.0D) AS contribution",
        "coalesce(foulLoss, 0L) AS foulLoss", "coalesce(ownGoals, 0L) AS ownGoals")
    return dated.where("match_date IS NOT NULL AND playerId IS NOT NULL")


def _after(state: Column, game: Column) -> dict[str, Column]:
    """State after one match, with the performance shown in it."""
    fouls = state["fouls"] + game["foulLoss"]
    own_goals = state["ownGoals"] + game["ownGoals"]
    perf = formulas.performance(game["contribution"], fouls, own_goals)
    return {
        "performance": perf,
        "rating": F.when(game["played"], formulas.next_rating(perf, state["rating"]))
        .otherwise(state["rating"]),
        "numMatches": state["numMatches"] + game["played"].cast("bigint"),
        "fouls": fouls,
        "ownGoals": own_goals,
    }


def _state(values: dict[str, Column]) -> Column:
    return F.struct(*[values[n].alias(n) for n in ("rating", "numMatches", "fouls", "ownGoals")])


def _start(rating: float) -> Column:
    zero = F.lit(0).cast("bigint")
    return _state({"rating": F.lit(rating), "numMatches": zero, "fouls": zero, "ownGoals": zero})


def _block_starts(blocks: DataFrame) -> DataFrame:
    """State of every player at the start of each of their blocks."""
    def played_through(acc: Column, block: Column) -> Column:
        state, end = acc["state"], block["end"]
        carried = formulas.performance(end["rating"], state["fouls"], state["ownGoals"])
        halved = state["rating"] * F.pow(F.lit(0.5), end["numMatches"])
        after = _state({
            "rating": carried + halved,
            "numMatches": state["numMatches"] + end["numMatches"],
            "fouls": state["fouls"] + end["fouls"],
            "ownGoals": state["ownGoals"] + end["ownGoals"],
        })
        start = F.struct(block["block"].alias("block"), state.alias("start"))
        return F.struct(
            after.alias("state"), F.concat(acc["starts"], F.array(start)).alias("starts"))

    end = F.aggregate("games", _start(0.0), lambda s, g: _state(_after(s, g)))
    ends = blocks.select("playerId", "block", end.alias("end"))
    none = F.array().cast(f"ARRAY<STRUCT<block: DATE, start: {STATE}>>")
    first = F.struct(_start(codes.INITIAL_RATING).alias("state"), none.alias("starts"))
    summaries = F.array_sort(F.collect_list(F.struct("block", "end")))
    return ends.groupBy("playerId").agg(summaries.alias("ends")).select(
        "playerId", F.inline(F.aggregate("ends", first, played_through)["starts"]))


def rating_history(rows: DataFrame, block_of: BlockOf = calendar_year) -> DataFrame:
    """Performance, previous and new rating for every match a player played."""
    # The block is computed before the grouping and known to be there, so that both uses of the
    # blocks below are the same plan and share one shuffle.
    dated = rows.withColumn("block", block_of(F.col("match_date"))).where(
        "playerId IS NOT NULL AND block IS NOT NULL")
    blocks = dated.groupBy("playerId", "block").agg(
        F.array_sort(F.collect_list(F.struct(*GAME))).alias("games"))

    def replay(acc: Column, game: Column) -> Column:
        state = acc["state"]
        after = _after(state, game)
        line = F.struct(
            *[game[n].alias(n) for n in
              ("match_date", "matchId", "teamId", "in_chemistry", "contribution")],
            after["performance"].alias("performance"),
            state["rating"].alias("previous_rating"),
            after["rating"].alias("rating"),
            after["numMatches"].alias("numMatches"),
            after["fouls"].alias("careerFouls"),
            after["ownGoals"].alias("careerOwnGoals"),
        )
        lines = F.when(game["played"], F.concat(acc["lines"], F.array(line)))
        return F.struct(
            _state(after).alias("state"), lines.otherwise(acc["lines"]).alias("lines"))

    zero = F.struct(F.col("start").alias("state"), F.array().cast(HISTORY).alias("lines"))
    return blocks.join(_block_starts(blocks), ["playerId", "block"]).select(
        "playerId", F.inline(F.aggregate("games", zero, replay)["lines"]))


def latest_ratings(history: DataFrame) -> DataFrame:
    """Rating after the last match played, and the number of matches behind it."""
    last = F.max(F.struct("match_date", "matchId", "rating", "numMatches")).alias("last")
    return history.groupBy("playerId").agg(last).select(
        "playerId", "last.rating", "last.numMatches")
