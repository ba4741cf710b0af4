"""Explicit schemas of everything that is read, as column-to-type maps and DDL text."""

from __future__ import annotations


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def struct(columns: dict[str, str]) -> str:
    return "STRUCT<" + ", ".join(f"{name}: {kind}" for name, kind in columns.items()) + ">"


# Fixed format: the column order of the player file. Only the first nine columns are
# input; the counters and the rating behind them are recomputed from the events.
PLAYER = {
    "name": "STRING", "birthArea": "STRING", "birthDate": "TIMESTAMP", "foot": "STRING",
    "role": "STRING", "height": "INT", "passportArea": "STRING", "weight": "INT", "Id": "BIGINT",
    "numFouls": "INT", "numGoals": "INT", "numOwnGoals": "INT", "passAcc": "FLOAT",
    "shotsOnTarget": "INT", "normalPasses": "INT", "keyPasses": "INT", "accNormalPasses": "INT",
    "accKeyPasses": "INT", "rating": "FLOAT", "numMatches": "INT",
}
PLAYER_ATTRIBUTES = list(PLAYER)[:9]

# Fixed format: the column order of the team file.
TEAM = {"name": "STRING", "Id": "BIGINT"}

# Fixed format: the fields of match and event records.
ENTRY = {"playerId": "BIGINT", "goals": "STRING", "ownGoals": "STRING",
         "yellowCards": "STRING", "redCards": "STRING"}
SUBSTITUTION = {"playerIn": "BIGINT", "playerOut": "BIGINT", "minute": "INT"}
FORMATION = {"bench": f"ARRAY<{struct(ENTRY)}>", "lineup": f"ARRAY<{struct(ENTRY)}>",
             "substitutions": f"ARRAY<{struct(SUBSTITUTION)}>"}
TEAM_DATA = struct({"teamId": "BIGINT", "hasFormation": "INT", "formation": struct(FORMATION)})

EVENT = {"eventId": "INT", "subEventId": "STRING", "playerId": "BIGINT", "matchId": "BIGINT",
         "tags": "ARRAY<STRUCT<id: INT>>"}
MATCH = {"wyId": "BIGINT", "status": "STRING", "date": "STRING", "label": "STRING",
         "duration": "STRING", "winner": "BIGINT", "venue": "STRING", "gameweek": "INT",
         "teamsData": f"MAP<STRING, {TEAM_DATA}>"}

# One line of the feed is either an event or a match; the schema is the union of both.
RECORD = {**EVENT, **MATCH, "_corrupt_record": "STRING"}

# Fixed format: the fields of a request.
SQUAD_SLOTS = [f"player{i}" for i in range(1, 12)]
SQUAD = struct({"name": "STRING", **{s: "STRING" for s in SQUAD_SLOTS}})
REQUEST = {"req_type": "INT", "date": "STRING", "name": "STRING", "label": "STRING",
           "team1": SQUAD, "team2": SQUAD}
