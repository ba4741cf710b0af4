"""The scalar formulas as Column expressions.

Spark 4 raises on division by zero, so every ratio of counters goes through
``try_divide``; a ratio that was never observed is NULL here and stored as 0 by
the metrics operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions import codes


def pass_accuracy(acc_normal: Column, acc_key: Column, normal: Column, key: Column) -> Column:
    return F.try_divide(acc_normal + 2 * acc_key, normal + 2 * key)


def duel_effectiveness(won: Column, neutral: Column, total: Column) -> Column:
    return F.try_divide(won + F.lit(0.5) * neutral, total)


def freekick_effectiveness(effective: Column, penalties: Column, total: Column) -> Column:
    """May reach 2: a scored, accurate penalty counts in both terms."""
    return F.try_divide(effective + penalties, total)


def shots_effectiveness(goal: Column, no_goal: Column, total: Column) -> Column:
    return F.try_divide(goal + F.lit(0.5) * no_goal, total)


def contribution(passing: Column, duels: Column, free_kicks: Column, shots: Column) -> Column:
    """Mean of the four ratios; one never observed counts as 0."""
    terms = [F.coalesce(c, F.lit(0.0)) for c in (passing, duels, free_kicks, shots)]
    return (terms[0] + terms[1] + terms[2] + terms[3]) / 4


def time_weight(started: Column, came_on: Column, went_off: Column) -> Column:
    """Share of the match played; a full match earns a bonus, an unused bench place 0."""
    minutes = F.lit(float(codes.MATCH_MINUTES))
    return (
        F.when(started & went_off.isNull(), F.lit(codes.FULL_MATCH_WEIGHT))
        .when(started, went_off / minutes)
        .when(came_on.isNotNull() & went_off.isNotNull(), (went_off - came_on) / minutes)
        .when(came_on.isNotNull(), (minutes - came_on) / minutes)
        .otherwise(F.lit(0.0))
    )


def performance(contrib: Column, career_fouls: Column, career_own_goals: Column) -> Column:
    return (
        contrib
        * F.pow(F.lit(codes.FOUL_FACTOR), career_fouls)
        * F.pow(F.lit(codes.OWN_GOAL_FACTOR), career_own_goals)
    )


def next_rating(perf: Column, rating: Column) -> Column:
    return (perf + rating) / 2


def chemistry_change(move1: Column, move2: Column, same_team: Column) -> Column:
    """Signed change of a pair; a rating that did not move never agrees with anything."""
    agree = ((move1 < 0) & (move2 < 0)) | ((move1 > 0) & (move2 > 0))
    size = F.abs((move1 + move2) / 2)
    return F.when(same_team == agree, size).otherwise(-size)


def player_strength(rating: Column, mean_chemistry: Column) -> Column:
    return rating * mean_chemistry


def winning_chance(own: Column, other: Column) -> Column:
    """Percent, neither clamped nor rounded."""
    return ((F.lit(0.5) + own) - (own + other) / 2) * 100


def percent(ratio: Column) -> Column:
    """A 0-1 ratio as whole percent, 0 when never observed."""
    return F.coalesce(F.round(ratio * 100, 0), F.lit(0.0)).cast("int")
