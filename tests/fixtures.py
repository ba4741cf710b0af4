"""Hand-written records for the operator tests."""

from __future__ import annotations

import json

KEEPER, DEFENDER, MIDFIELDER, FORWARD = "GK", "DF", "MD", "FW"
ROLES = [KEEPER] + [DEFENDER] * 4 + [MIDFIELDER] * 4 + [FORWARD] * 2


def event(player, event_id, tags=(), sub=0, match=1):
    return {"eventId": event_id, "subEventId": sub, "playerId": player, "matchId": match,
            "tags": [{"id": t} for t in tags]}


def place(player, goals="0", own="0", yellow="0", red="0"):
    return {"playerId": player, "goals": goals, "ownGoals": own, "yellowCards": yellow,
            "redCards": red}


def team(team_id, lineup, bench=(), swaps=(), formed=1):
    """Places may be ids or ready-made entries; swaps are (in, out, minute)."""
    entries = lambda ids: [i if isinstance(i, dict) else place(i) for i in ids]
    swap_list = [{"playerIn": a, "playerOut": b, "minute": m} for a, b, m in swaps]
    return {"teamId": team_id, "hasFormation": formed,
            "formation": {"bench": entries(bench), "lineup": entries(lineup),
                          "substitutions": swap_list if swaps else "null"}}


def match(match_id, teams, date="May 13, 2018 at 4:00:00 PM GMT+2", status="Played", winner=0,
          label="Home - Away, 0 - 0"):
    return {"wyId": match_id, "status": status, "date": date, "label": label,
            "duration": "Regular", "winner": winner, "venue": "Ground", "gameweek": 1,
            "teamsData": {str(t["teamId"]): t for t in teams}}


def lines(spark, records):
    """Records (or raw text) as feed lines."""
    rows = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return spark.createDataFrame(rows, "value STRING")


def players(spark, rows):
    """``(Id, name, role)`` rows as a player table."""
    return spark.createDataFrame(
        [(i, n, r, "Area", "right", 180, "Area", 75) for i, n, r in rows],
        "Id BIGINT, name STRING, role STRING, birthArea STRING, foot STRING, height INT,"
        " passportArea STRING, weight INT",
    ).selectExpr("*", "timestamp'1993-03-15 00:00:00' AS birthDate")


def teams(spark, rows):
    return spark.createDataFrame(rows, "Id BIGINT, name STRING")


def request_lines(spark, requests):
    rows = [(i, json.dumps(r)) for i, r in enumerate(requests)]
    return spark.createDataFrame(rows, "request_seq BIGINT, value STRING")


def prediction(names1, names2):
    squad = lambda title, names: {
        "name": title, **{f"player{i}": n for i, n in enumerate(names, 1)}}
    return {"req_type": 1, "date": "2020-08-28", "team1": squad("One", names1),
            "team2": squad("Two", names2)}
