"""Per-match and career counters of every player.

The whole wide row is one grouped aggregation. Counters are combined on the map side, so
a player or match with a large share of the events reaches the shuffle as one row per task.
Tag priority follows the feed: the first tag of a chain that is present decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import codes, formulas
from touchline.operators.events import flag_events, of_known_players

KEYS = ["matchId", "playerId"]
COUNTERS = [
    "normalPasses", "keyPasses", "accNormalPasses", "accKeyPasses", "duelsWon", "neutralDuels",
    "totalDuels", "effectiveFreeKicks", "penaltiesScored", "totalFreeKicks", "targetAndGoal",
    "targetNotGoal", "totalShots", "shotsOnTarget", "numGoals", "foulLoss", "ownGoals",
]


def pass_counters() -> dict[str, str]:
    on = f"eventId = {codes.PASS}"
    return {
        "normalPasses": f"{on} AND (t_acc AND NOT t_key OR NOT t_acc AND t_inacc)",
        "keyPasses": f"{on} AND t_key AND (t_acc OR NOT t_inacc)",
        "accNormalPasses": f"{on} AND t_acc AND NOT t_key",
        "accKeyPasses": f"{on} AND t_acc AND t_key",
    }


def duel_counters() -> dict[str, str]:
    on = f"eventId = {codes.DUEL}"
    return {
        "duelsWon": f"{on} AND t_won AND NOT t_lost AND NOT t_neutral",
        "neutralDuels": f"{on} AND t_neutral AND NOT t_lost",
        "totalDuels": f"{on} AND (t_lost OR t_neutral OR t_won)",
    }


def freekick_counters() -> dict[str, str]:
    on = f"eventId = {codes.FREE_KICK}"
    return {
        "effectiveFreeKicks": f"{on} AND t_acc",
        "penaltiesScored": f"{on} AND is_penalty AND t_goal",
        "totalFreeKicks": on,
    }


def shot_counters() -> dict[str, str]:
    on = f"eventId = {codes.SHOT}"
    return {
        "targetAndGoal": f"{on} AND t_acc AND t_goal",
        "targetNotGoal": f"{on} AND t_acc AND NOT t_goal",
        "totalShots": f"{on} AND (t_acc OR t_inacc)",
        "shotsOnTarget": f"{on} AND t_acc",
    }


def discipline_counters() -> dict[str, str]:
    """Goals count whether or not the shot was tagged accurate; an own goal on any event."""
    return {
        "numGoals": f"eventId = {codes.SHOT} AND t_goal",
        "foulLoss": f"eventId = {codes.FOUL}",
        "ownGoals": "t_own_goal",
    }


def all_counters() -> dict[str, str]:
    return {**pass_counters(), **duel_counters(), **freekick_counters(), **shot_counters(),
            **discipline_counters()}


def count_events(events: DataFrame, counters: dict[str, str], keys: list[str | Column] = KEYS):
    """Grouped counters over typed events; works on batch and streaming frames.

    ``counters`` maps a name to the condition on the event flags that is counted.
    """
    aggs = [F.expr(f"count_if({cond})").alias(name) for name, cond in counters.items()]
    return flag_events(events).groupBy(*keys).agg(*aggs)


def ratios() -> dict[str, Column]:
    """The four effectiveness ratios of a counter row; NULL when nothing was observed."""
    c = F.col
    return {
        "passAccuracy": formulas.pass_accuracy(
            c("accNormalPasses"), c("accKeyPasses"), c("normalPasses"), c("keyPasses")),
        "duelEffectiveness": formulas.duel_effectiveness(
            c("duelsWon"), c("neutralDuels"), c("totalDuels")),
        "freeKick": formulas.freekick_effectiveness(
            c("effectiveFreeKicks"), c("penaltiesScored"), c("totalFreeKicks")),
        "shotsEffectiveness": formulas.shots_effectiveness(
            c("targetAndGoal"), c("targetNotGoal"), c("totalShots")),
    }


def with_ratios(counts: DataFrame) -> DataFrame:
    return counts.withColumns({n: F.coalesce(r, F.lit(0.0)) for n, r in ratios().items()})


def match_metrics(events: DataFrame, players: DataFrame) -> DataFrame:
    """The wide metrics row per (match, player) with events, for known players.

    Unknown players are dropped after the aggregation: by then their rows are few, and the
    semi join never has to move raw events.
    """
    return of_known_players(all_metrics(events), players)


def all_metrics(events: DataFrame) -> DataFrame:
    """The same for whoever the events name."""
    return with_ratios(count_events(events, all_counters()))


def metric_rows(appearances: DataFrame, metrics: DataFrame) -> DataFrame:
    """A metrics row for everyone on a team sheet, zeros where a player had no event,
    completed by the contribution: the mean ratio weighted by the time played."""
    names = [*COUNTERS, *ratios()]
    rows = appearances.join(metrics, KEYS, "left").fillna(0, subset=names)
    mean = formulas.contribution(*(F.col(r) for r in ratios()))
    return rows.withColumn("contribution", F.col("time_weight") * mean)


def career_totals(metrics: DataFrame) -> DataFrame:
    """Counters summed over all matches; career ratios are ratios of the sums."""
    summed = {
        "numFouls": "foulLoss", "numGoals": "numGoals", "numOwnGoals": "ownGoals",
        "shotsOnTarget": "shotsOnTarget", "totalShots": "totalShots",
        "normalPasses": "normalPasses", "keyPasses": "keyPasses",
        "accNormalPasses": "accNormalPasses", "accKeyPasses": "accKeyPasses",
    }
    totals = metrics.groupBy("playerId").agg(*[F.sum(s).alias(n) for n, s in summed.items()])
    return totals.withColumns({
        "passAcc": F.coalesce(ratios()["passAccuracy"], F.lit(0.0)),
        "shotsOnTargetRatio": F.try_divide("shotsOnTarget", "totalShots"),
    })
