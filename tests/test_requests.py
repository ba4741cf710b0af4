import json

import pytest
from pyspark.sql import functions as F

from tests import fixtures as fx
from touchline.operators import smoothing, squads
from touchline.plans import requests as answers
from touchline.plans.season import Season
from touchline.sources import records, tables

HOME = [f"H{i}" for i in range(11)]
AWAY = [f"A{i}" for i in range(11)]


@pytest.fixture(scope="module")
def cup(spark):
    """Two teams that met six times; H10 is replaced in every match by H11."""
    ids = {n: i for i, n in enumerate([*HOME, "H11", *AWAY], 1)}
    people = [(ids[n], n, fx.ROLES[i % 11]) for i, n in enumerate(HOME)]
    people += [(ids["H11"], "H11", fx.DEFENDER)]
    people += [(ids[n], n, fx.ROLES[i % 11]) for i, n in enumerate(AWAY)]
    people += [(90, "Rookie", fx.MIDFIELDER), (91, "Twin", fx.DEFENDER), (92, "Twin", fx.FORWARD)]
    home = fx.team(10, [ids[n] for n in HOME], [ids["H11"]], [(ids["H11"], ids["H10"], 60)])
    away = fx.team(20, [ids[n] for n in AWAY])
    feed = []
    for m in range(1, 7):
        feed.append(fx.match(m, [home, away], date=f"May {m}, 2018 at 1", label=f"Game {m}"))
        for name in [*HOME, *AWAY, "H11"]:
            tags = (1801,) if name[0] == "H" else (1802,)
            feed += [fx.event(ids[name], 8, (1801, 302), match=m), fx.event(ids[name], 1, (703,), match=m),
                     fx.event(ids[name], 3, tags, match=m), fx.event(ids[name], 10, tags, match=m)]
    season = Season.from_lines(fx.lines(spark, feed), fx.players(spark, people),
                               fx.teams(spark, [(10, "Home FC"), (20, "Away FC")]))
    return season.with_stored("counts", "history", "profiles")


def ask(spark, season, requests, smoothing=False):
    asked = tables.parse_requests(fx.request_lines(spark, requests))
    rows = answers.answer_requests(asked, season, smoothing).orderBy("request_seq").collect()
    return [json.loads(r.response) for r in rows]


def swapped(names, at, name):
    return [*names[:at], name, *names[at + 1:]]


def by_hand(season):
    """Chances of HOME against AWAY from ratings and chemistry, player by player."""
    rating = {r.name: r.rating for r in season.profiles.collect()}
    ids = {r.name: r.Id for r in season.profiles.collect()}
    chem = {(r.player1, r.player2): r.chemistry for r in season.chemistry.collect()}

    def strength(names):
        total = 0.0
        for a in names:
            mates = [chem.get(tuple(sorted((ids[a], ids[b]))), 0.5) for b in names if b != a]
            total += rating[a] * sum(mates) / len(mates)
        return total / 11

    return 50 + 50 * (strength(HOME) - strength(AWAY))


def test_predictions_and_their_messages(spark, cup):
    requests = [
        fx.prediction(HOME, AWAY),
        fx.prediction(swapped(HOME, 3, "Nobody"), AWAY),
        fx.prediction(swapped(HOME, 1, "H2"), AWAY),
        fx.prediction(swapped(HOME, 1, "Twin"), AWAY),
        fx.prediction(swapped(HOME, 0, "H11"), AWAY),
        fx.prediction(HOME, swapped(AWAY, 0, "H11")),
        fx.prediction(swapped(HOME, 0, "H11"), swapped(AWAY, 0, "Rookie")),
    ]
    got = ask(spark, cup, requests)
    chance = by_hand(cup)
    assert got[0]["team1"]["name"] == "One"
    assert got[0]["team1"]["winning chance"] == pytest.approx(chance)
    assert got[0]["team1"]["winning chance"] + got[0]["team2"]["winning chance"] == pytest.approx(100)
    assert [g.get("msg") for g in got[1:]] == [
        "Player Does Not Exist", "Player Does Not Exist", "Player Does Not Exist",
        "Team 1 is Invalid", "Team 2 is Invalid", "Team 2 is Invalid"]


def test_first_reason_is_kept_as_detail(spark, cup):
    asked = tables.parse_requests(fx.request_lines(spark, [
        fx.prediction(swapped(swapped(HOME, 5, "Later"), 2, "First"), swapped(AWAY, 2, "Other")),
        fx.prediction(swapped(HOME, 0, "H11"), swapped(AWAY, 0, "Rookie")),
    ]))
    rows = answers.win_predictions(asked, cup, smoothing=False).orderBy("request_seq").collect()
    assert [r.detail for r in rows] == ["Player : First does not exist", "Team 1 is Invalid"]


def test_player_strengths_add_up_to_the_team(spark, cup):
    asked = tables.parse_requests(fx.request_lines(spark, [fx.prediction(HOME, AWAY)]))
    judged = answers.judged_squads(asked, cup, smoothing=False)
    single = squads.player_strengths(judged, cup.chemistry).groupBy("team").agg(
        (F.sum("strength") / 11).alias("s")).collect()
    both = squads.team_strengths(judged, cup.chemistry).collect()[0]
    assert {r.team: r.s for r in single} == {
        1: pytest.approx(both.strength1), 2: pytest.approx(both.strength2)}


def test_retired_player(spark, cup):
    low = cup.profiles.withColumn(
        "rating", F.when(F.col("name") == "A3", 0.1).otherwise(F.col("rating")))
    asked = tables.parse_requests(fx.request_lines(spark, [fx.prediction(HOME, AWAY)]))
    season = Season(cup.players, cup.teams, cup.matches, cup.events)
    season.__dict__["profiles"] = low
    row = answers.judged_squads(asked, season, smoothing=False).collect()[0]
    assert (row.profiles, row.retired, row.msg) == (22, True, "Player Does Not Exist")


def test_smoothing_touches_rookies_only(spark, cup):
    rows = smoothing.smooth_ratings(cup.profiles).collect()
    means = {}
    for r in rows:
        means.setdefault(r.prediction, []).append(r.rating)
    assert len(rows) == cup.profiles.count() and len(means) <= 5
    for r in rows:
        cluster = sum(means[r.prediction]) / len(means[r.prediction])
        want = cluster if r.numMatches < 5 else r.rating
        assert r.smoothed_rating == pytest.approx(want)
    got = ask(spark, cup, [fx.prediction(swapped(HOME, 6, "Rookie"), AWAY)], smoothing=True)
    assert 0 < got[0]["team1"]["winning chance"] < 100


def test_profiles(spark, cup):
    got = ask(spark, cup, [{"req_type": 2, "name": "H1"}, {"req_type": 2, "name": "Nobody"},
                           {"req_type": 2, "name": "Rookie"}])
    assert got[0] == {
        "name": "H1", "birthArea": "Area", "birthDate": "1993-03-15", "foot": "right", "role": "DF",
        "height": 180, "passportArea": "Area", "weight": 75, "fouls": 0, "goals": 0, "own_goals": 0,
        "percent_pass_accuracy": 100, "percent_shots_on_target": 100}
    assert got[1] == {"msg": "Player Not Found"}
    assert (got[2]["percent_pass_accuracy"], got[2]["percent_shots_on_target"]) == (0, 0)


def report_season(spark):
    sheet = [fx.place(1, goals="2", yellow="31"), fx.place(2, own="1")]
    home, away = fx.team(10, sheet, [fx.place(3, goals="1")]), fx.team(20, [fx.place(4, red="55")])
    feed = [
        fx.match(1, [home, away], label="Win", winner=10),
        fx.match(2, [home, away], label="Draw"),
        fx.match(3, [home, away], label="Odd", winner=77),
        fx.match(4, [home, fx.team(20, [fx.place(4, red="55")], formed=0)], label="Half", winner=20),
        fx.match(5, [home], label="Alone", winner=10),
        fx.match(6, [home, away], label="Off", status="Postponed"),
        fx.match(8, [home, away], label="Win", winner=20),
    ]
    return Season.from_lines(
        fx.lines(spark, feed), fx.players(spark, [(i, f"P{i}", "MD") for i in range(1, 5)]),
        fx.teams(spark, [(10, "Home FC"), (20, "Away FC")]))


def test_match_reports(spark):
    day = "2018-05-13"
    labels = ["Win", "Draw", "Odd", "Half", "Alone", "Off", "Gone"]
    requests = [{"req_type": 3, "date": day, "label": n} for n in labels]
    requests += [{"req_type": 3, "date": "2018-05-14", "label": "Win"},
                 {"req_type": 3, "date": "someday", "label": "Win"}, {"req_type": 4}]
    asked = tables.parse_requests(fx.request_lines(spark, requests))
    rows = answers.answer_requests(asked, report_season(spark), smoothing=False)
    got = {r.request_seq: json.loads(r.response) for r in rows.collect()}
    assert got[0] == {
        "date": day, "duration": "Regular", "label": "Win", "winner": "Home FC", "venue": "Ground",
        "gameweek": 1,
        "goals": [{"name": "P3", "team": "Home FC", "number_of_goals": 1},
                  {"name": "P1", "team": "Home FC", "number_of_goals": 2}],
        "own_goals": [{"name": "P2", "team": "Home FC", "number_of_goals": 1}],
        "yellow_cards": ["P1"], "red_cards": ["P4"]}
    assert got[1]["winner"] == "None"
    assert got[2] == {"msg": "Invalid Data"}
    assert (got[3]["winner"], got[3]["red_cards"], len(got[3]["goals"])) == ("Away FC", [], 2)
    assert got[4]["goals"] == []
    assert got[5] == {"msg": "Match was Postponed"}
    assert got[6] == got[7] == got[8] == {"msg": "No Matches found"}
    assert got[9] == {"msg": "Invalid request"}


def test_an_empty_match_table_answers_not_found(spark):
    empty = records.route_matches(records.parse_lines(fx.lines(spark, [fx.event(1, 8)])))
    season = report_season(spark)
    asked = tables.parse_requests(fx.request_lines(
        spark, [{"req_type": 3, "date": "2018-05-13", "label": "Win"}]))
    bare = Season(season.players, season.teams, empty, season.events)
    assert [r.msg for r in answers.match_reports(asked, bare).collect()] == ["No Matches found"]


def test_clusters_are_fitted_once_for_a_season(spark, cup, monkeypatch):
    fits = []
    fitted = smoothing.fitted_clusters
    monkeypatch.setattr(smoothing, "fitted_clusters", lambda *a: fits.append(1) or fitted(*a))
    season = cup.with_given()
    for _ in range(3):
        ask(spark, season, [fx.prediction(HOME, AWAY)], smoothing=True)
    assert len(fits) == 1
