import random

import pytest

from tests import fixtures as fx
from touchline.operators import metrics
from touchline.sources import records


def counted(spark, events):
    typed = records.route_events(records.parse_lines(fx.lines(spark, events)))
    known = fx.players(spark, [(i, f"P{i}", "GK") for i in range(1, 4)])
    rows = metrics.match_metrics(typed, known).collect()
    return {(r.matchId, r.playerId): r for r in rows}


def test_passes_by_tag_set(spark):
    sets = [(1801, 302), (1801,), (1802,), (1802, 302), (302,), ()]
    row = counted(spark, [fx.event(1, 8, t) for t in sets])[1, 1]
    assert (row.accKeyPasses, row.accNormalPasses, row.normalPasses, row.keyPasses) == (1, 1, 3, 2)
    assert row.passAccuracy == pytest.approx((1 + 2) / (3 + 4))


def test_duels_first_tag_of_the_chain_decides(spark):
    sets = [(701,), (702,), (703,), (), (701, 703), (702, 703)]
    row = counted(spark, [fx.event(1, 1, t) for t in sets])[1, 1]
    assert (row.duelsWon, row.neutralDuels, row.totalDuels) == (1, 2, 5)
    assert row.duelEffectiveness == pytest.approx(2 / 5)


def test_free_kicks_and_penalties(spark):
    row = counted(spark, [fx.event(1, 3, (1801, 101), sub=35)])[1, 1]
    assert (row.effectiveFreeKicks, row.penaltiesScored, row.totalFreeKicks) == (1, 1, 1)
    assert row.freeKick == 2.0
    row = counted(spark, [fx.event(1, 3, (), sub=35), fx.event(1, 3, (101,), sub=31),
                          fx.event(1, 3, (101,), sub="")])[1, 1]
    assert (row.effectiveFreeKicks, row.penaltiesScored, row.totalFreeKicks) == (0, 0, 3)
    assert row.numGoals == 0


def test_shots_and_goals(spark):
    sets = [(1801, 101), (1801,), (1802,), (), (101,)]
    row = counted(spark, [fx.event(1, 10, t) for t in sets])[1, 1]
    assert (row.targetAndGoal, row.targetNotGoal, row.totalShots, row.shotsOnTarget) == (1, 1, 3, 2)
    assert row.numGoals == 2
    assert row.shotsEffectiveness == pytest.approx(0.5)


def test_fouls_own_goals_and_unknown_players(spark):
    rows = counted(spark, [fx.event(1, 2), fx.event(1, 8, (1801, 102)), fx.event(99, 2)])
    assert list(rows) == [(1, 1)]
    assert (rows[1, 1].foulLoss, rows[1, 1].ownGoals) == (1, 1)


def test_nothing_observed_is_zero_not_an_error(spark):
    row = counted(spark, [fx.event(1, 8), fx.event(1, 1), fx.event(1, 10)])[1, 1]
    assert (row.passAccuracy, row.duelEffectiveness, row.freeKick, row.shotsEffectiveness) == (
        0, 0, 0, 0)


def test_counters_are_per_match_and_careers_add_up(spark):
    typed = records.route_events(records.parse_lines(fx.lines(spark, [
        fx.event(1, 8, (1801,), match=1), fx.event(1, 8, (1802,), match=2),
        fx.event(1, 8, (1801, 302), match=2), fx.event(1, 10, (1801,), match=2),
        fx.event(1, 10, (1802,), match=2)])))
    per_match = metrics.match_metrics(typed, fx.players(spark, [(1, "P", "GK")]))
    assert sorted((r.matchId, r.normalPasses, r.keyPasses) for r in per_match.collect()) == [
        (1, 1, 0), (2, 1, 1)]
    total = metrics.career_totals(per_match).collect()[0]
    assert (total.normalPasses, total.keyPasses, total.shotsOnTarget, total.totalShots) == (2, 1, 1, 2)
    assert total.passAcc == pytest.approx((1 + 2) / (2 + 2))
    assert total.shotsOnTargetRatio == 0.5


def test_counters_are_combined_before_the_shuffle(spark):
    typed = records.route_events(records.parse_lines(fx.lines(spark, [fx.event(1, 8)])))
    plan = metrics.match_metrics(typed, fx.players(spark, [(1, "P", "GK")]))._jdf.queryExecution() \
        .executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(matchId")[1]
    assert "partial_count_if" in below or "partial_count(" in below


def by_hand(events):
    """Counters of each (match, player), one event after the other."""
    rows = {}
    for e in events:
        row = rows.setdefault((e["matchId"], e["playerId"]), dict.fromkeys(metrics.COUNTERS, 0))
        tags, kind = {t["id"] for t in e["tags"]}, e["eventId"]
        hits = []
        if kind == 8 and 1801 in tags:
            hits = ["accKeyPasses", "keyPasses"] if 302 in tags else ["accNormalPasses", "normalPasses"]
        elif kind == 8 and 1802 in tags:
            hits = ["normalPasses"]
        elif kind == 8 and 302 in tags:
            hits = ["keyPasses"]
        elif kind == 1:
            first = next((t for t in (701, 702, 703) if t in tags), None)
            hits = {701: ["totalDuels"], 702: ["neutralDuels", "totalDuels"],
                    703: ["duelsWon", "totalDuels"], None: []}[first]
        elif kind == 3:
            hits = ["totalFreeKicks"] + ["effectiveFreeKicks"] * (1801 in tags)
            hits += ["penaltiesScored"] * (e["subEventId"] == 35 and 101 in tags)
        elif kind == 10:
            if 1801 in tags:
                hits = ["totalShots", "shotsOnTarget", "targetAndGoal" if 101 in tags else "targetNotGoal"]
            elif 1802 in tags:
                hits = ["totalShots"]
            hits += ["numGoals"] * (101 in tags)
        elif kind == 2:
            hits = ["foulLoss"]
        for name in [*hits, *["ownGoals"] * (102 in tags)]:
            row[name] += 1
    return rows


def test_random_events_with_a_hot_player_against_brute_force(spark):
    rng = random.Random(3)
    tags = [101, 102, 302, 701, 702, 703, 1801, 1802]
    events = [
        fx.event(1 if rng.random() < 0.34 else rng.randint(2, 9), rng.choice([1, 2, 3, 8, 10, 7]),
                 rng.sample(tags, rng.randint(0, 4)), sub=rng.choice([35, 31, ""]),
                 match=rng.randint(1, 3))
        for _ in range(4000)]
    typed = records.route_events(records.parse_lines(fx.lines(spark, events).repartition(6)))
    known = fx.players(spark, [(i, f"P{i}", "GK") for i in range(1, 9)])
    got = {(r.matchId, r.playerId): {c: r[c] for c in metrics.COUNTERS}
           for r in metrics.match_metrics(typed, known).collect()}
    assert got == {k: v for k, v in by_hand(events).items() if k[1] < 9}
