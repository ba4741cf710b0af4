import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from touchline.operators import chemistry, ordered, ratings, sheets
from touchline.plans.season import Season
from touchline.sources import records


def season_of(spark, feed, people):
    return Season.from_lines(fx.lines(spark, feed), fx.players(
        spark, [(i, f"P{i}", "MD") for i in people]), fx.teams(spark, [(10, "Home"), (20, "Away")]))


def test_minutes_played(spark):
    home = fx.team(10, [1, 2], [3, 4, 5], [(3, 2, 60), (4, 3, 75)])
    feed = fx.lines(spark, [fx.match(1, [home, fx.team(20, [6])])])
    made = sheets.appearances(sheets.team_sheets(records.route_matches(records.parse_lines(feed))))
    rows = {r.playerId: (r.time_weight, r.played, r.in_chemistry) for r in made.collect()}
    assert rows[1] == (1.05, True, True)
    assert rows[2] == (60 / 90, True, False)
    assert rows[3] == ((75 - 60) / 90, True, True)
    assert rows[4] == ((90 - 75) / 90, True, True)
    assert rows[5] == (0.0, False, False)
    assert rows[6] == (1.05, True, True)


def test_a_missing_formation_leaves_chemistry_out(spark):
    feed = fx.lines(spark, [fx.match(1, [fx.team(10, [1]), fx.team(20, [2], formed=0)])])
    made = sheets.appearances(sheets.team_sheets(records.route_matches(records.parse_lines(feed))))
    assert [(r.playerId, r.played, r.in_chemistry) for r in made.collect()] == [(1, True, False)]


def three_matches():
    dates = ["May 1, 2018 at 1", "May 8, 2018 at 1", "May 15, 2018 at 1"]
    return [fx.match(m, [fx.team(10, [1, 2], [4]), fx.team(20, [3])], date=d)
            for m, d in zip((3, 2, 1), dates)]


def test_ratings_follow_match_order_and_career_fouls(spark):
    events = [fx.event(1, 8, (1801,), match=3), fx.event(1, 2, match=3),
              fx.event(1, 8, (1801,), match=2), fx.event(1, 2, match=2), fx.event(1, 8, (102,), match=1)]
    made = season_of(spark, [*three_matches(), *events], [1, 2, 3, 4])
    rows = made.history.where("playerId = 1").orderBy("numMatches").collect()
    contrib = 1.05 / 4
    perf = [contrib * 0.995, contrib * 0.995**2, 0.0]
    want, rating = [], 0.5
    for p in perf:
        want.append((p, rating, (p + rating) / 2))
        rating = (p + rating) / 2
    assert [r.matchId for r in rows] == [3, 2, 1]
    for row, (p, before, after) in zip(rows, want):
        assert row.performance == pytest.approx(p)
        assert (row.previous_rating, row.rating) == (pytest.approx(before), pytest.approx(after))
    assert [(r.careerFouls, r.careerOwnGoals) for r in rows] == [(1, 0), (2, 0), (2, 1)]
    last = {r.playerId: (r.rating, r.numMatches) for r in made.latest.collect()}
    assert last[1] == (pytest.approx(rating), 3)
    assert 4 not in last


def test_a_match_not_played_is_skipped_alone(spark):
    feed = three_matches()
    feed[1]["status"] = "Suspended"
    made = season_of(spark, feed, [1, 2, 3])
    assert sorted(r.matchId for r in made.history.where("playerId = 1").collect()) == [1, 3]


def test_fouls_off_the_sheet_still_count(spark):
    events = [fx.event(4, 2, match=3), fx.event(5, 2, match=3)]
    later = fx.match(9, [fx.team(10, [4, 5]), fx.team(20, [3])], date="May 20, 2018 at 1")
    made = season_of(spark, [*three_matches(), later, *events], [1, 2, 3, 4, 5])
    rows = made.history.where("matchId = 9").collect()
    assert {r.playerId: r.careerFouls for r in rows} == {3: 0, 4: 1, 5: 1}


def career(spark, n):
    """A long career of one player and a short one of another."""
    rng = random.Random(7)
    day = dt.date(2000, 1, 1)
    rows = [(1 if i % 50 else 2, i, 10, day + dt.timedelta(days=3 * i), rng.random() > 0.1, True,
             rng.random(), rng.randint(0, 2), int(rng.random() > 0.95)) for i in range(n)]
    return spark.createDataFrame(
        rows, "playerId BIGINT, matchId BIGINT, teamId BIGINT, match_date DATE, played BOOLEAN,"
              " in_chemistry BOOLEAN, contribution DOUBLE, foulLoss BIGINT, ownGoals BIGINT"), rows


def test_blocks_give_the_same_history_as_one_pass(spark):
    frame, rows = career(spark, 900)
    want = {}
    for player in (1, 2):
        rating, fouls, own, n = 0.5, 0, 0, 0
        for p, match, _, _, played, _, contribution, foul, own_goal in rows:
            if p != player:
                continue
            fouls, own = fouls + foul, own + own_goal
            if played:
                before, n = rating, n + 1
                perf = contribution * 0.995**fouls * 0.95**own
                rating = (perf + rating) / 2
                want[p, match] = (perf, before, rating, n, fouls, own)
    for block in (ordered.calendar_year, lambda d: F.date_trunc("month", d).cast("date"), lambda d: d):
        got = ratings.rating_history(frame, block).collect()
        assert len(got) == len(want)
        for r in got:
            w = want[r.playerId, r.matchId]
            assert (r.performance, r.previous_rating, r.rating) == pytest.approx(w[:3], abs=1e-13)
            assert (r.numMatches, r.careerFouls, r.careerOwnGoals) == w[3:]


def test_running_totals_over_blocks(spark):
    frame, rows = career(spark, 400)
    got = ordered.running_totals(frame, ["playerId"], ["match_date", "matchId"],
                                 {"fouls": F.col("foulLoss"), "n": F.col("played").cast("int")})
    have = {(r.playerId, r.matchId): (r.fouls, r.n) for r in got.collect()}
    for player in (1, 2):
        fouls = n = 0
        for row in (r for r in rows if r[0] == player):
            fouls, n = fouls + row[7], n + row[4]
            assert have[player, row[1]] == (fouls, n)


def history(spark, moves, match=1):
    """(player, team, previous, rating) rows of one match."""
    return spark.createDataFrame(
        [(match, dt.date(2018, 5, match), t, p, True, before, after) for p, t, before, after in moves],
        "matchId BIGINT, match_date DATE, teamId BIGINT, playerId BIGINT, in_chemistry BOOLEAN,"
        " previous_rating DOUBLE, rating DOUBLE")


def test_chemistry_signs(spark):
    moves = [(1, 10, 0.5, 0.7), (2, 10, 0.5, 0.6), (3, 10, 0.5, 0.4), (4, 20, 0.5, 0.9),
             (5, 20, 0.5, 0.3), (6, 20, 0.5, 0.5)]
    rows = chemistry.chemistry_deltas(history(spark, moves)).collect()
    delta = {(r.player1, r.player2): r.delta for r in rows}
    assert len(delta) == 15
    assert delta[1, 2] == pytest.approx(0.15)       # team-mates, both up
    assert delta[1, 3] == pytest.approx(-0.05)      # team-mates, one up one down
    assert delta[1, 4] == pytest.approx(-0.3)       # opponents, both up
    assert delta[3, 5] == pytest.approx(-0.15)      # opponents, both down
    assert delta[1, 5] == pytest.approx(0.0)        # opponents that disagree gain
    assert delta[2, 5] == pytest.approx(0.05)
    assert delta[4, 6] == pytest.approx(-0.2)       # a rating that did not move never agrees
    assert delta[1, 6] == pytest.approx(0.1)


def test_chemistry_adds_up_and_starts_at_the_initial_value(spark):
    up, down = [(1, 10, 0.5, 0.7), (2, 10, 0.5, 0.6)], [(2, 10, 0.6, 0.5), (1, 10, 0.7, 0.6)]
    deltas = chemistry.chemistry_deltas(history(spark, up).unionByName(history(spark, down, 2)))
    table = chemistry.chemistry_table(deltas)
    assert list(map(tuple, table.collect())) == [(1, 2, pytest.approx(0.75))]
    as_of = chemistry.chemistry_as_of(deltas).orderBy("matchId").collect()
    assert [r.chemistry for r in as_of] == [pytest.approx(0.65), pytest.approx(0.75)]
    asked = spark.createDataFrame([(2, 1), (1, 9)], "a BIGINT, b BIGINT")
    pairs = asked.select(*chemistry.pair_key(F.col("a"), F.col("b")))
    found = {(r.player1, r.player2): r.chemistry for r in chemistry.lookup(pairs, table).collect()}
    assert found == {(1, 2): pytest.approx(0.75), (1, 9): 0.5}
