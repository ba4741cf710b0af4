"""Rating state that outlives the matches and takes late ones in.

The state of a player is cut into the calendar blocks that the batch form uses. The matches of blocks
that may still change lie open; a timer seals blocks that have been quiet for a while. For every block
there is the career's state at its end. A match that comes late, or a new version of one, is put in its place, its block is replayed from
the end of the block before, and so are the later blocks until the state at the end of one comes out
as it was. All lines that are new or have changed are emitted under a new version, so the newest
version of every line is the whole history and nothing is mended when it is read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from touchline.functions import codes
from touchline.sources.sinks import latest_per_key

ROW = ["playerId", "matchId", "match_date", "teamId", "played", "in_chemistry", "contribution",
       "foulLoss", "ownGoals"]
#: State of a player, see :class:`Career`. A match in it is a list: day, id, team, whether it was played,
#: whether it counts for chemistry, contribution, fouls, own goals.
STATE = "version BIGINT, ends STRING, opened STRING, sealed STRING"
#: Rating, matches, fouls and own goals before the first match.
START = (codes.INITIAL_RATING, 0, 0, 0)
FACTORS = (codes.FOUL_FACTOR, codes.OWN_GOAL_FACTOR)
OUTPUT = ("playerId BIGINT, matchId BIGINT, match_date DATE, teamId BIGINT, in_chemistry BOOLEAN,"
          " contribution DOUBLE, performance DOUBLE, previous_rating DOUBLE, rating DOUBLE,"
          " numMatches BIGINT, careerFouls BIGINT, careerOwnGoals BIGINT, version BIGINT,"
          " retracted BOOLEAN")
NAMES = [field.split()[0] for field in OUTPUT.split(", ")]
#: Quiet time after which a block is sealed.
SEAL_AFTER = "1 day"


def replayed(games: list[tuple], end: tuple, factors: tuple) -> tuple[list[tuple], tuple]:
    """Lines of the matches of a block in order, and the state behind them.

    A line is (performance, previous rating, rating, matches, fouls, own goals)."""
    rating, matches, fouls, own_goals = end
    foul_factor, own_goal_factor = factors
    all_fouls = list(accumulate((g[6] for g in games), initial=fouls))[1:]
    all_own = list(accumulate((g[7] for g in games), initial=own_goals))[1:]
    counts = list(accumulate((int(g[3]) for g in games), initial=matches))[1:]
    shown = [g[5] * foul_factor**f * own_goal_factor**o
             for g, f, o in zip(games, all_fouls, all_own)]
    rated = list(accumulate(zip(games, shown), lambda r, g: (g[1] + r) / 2 if g[0][3] else r,
                            initial=rating))
    lines = list(zip(shown, rated, rated[1:], counts, all_fouls, all_own))
    if not games:
        return [], end
    return lines, (rated[-1], counts[-1], all_fouls[-1], all_own[-1])


class Career:
    """A player's blocks as they lie in the state; blocks are calendar years.

    The state is three texts. ``ends`` has the state at the end of every block, ``open`` the matches of
    the blocks that may still change, ``sealed`` those of the others: for each block the ids of its
    matches, and the matches as a text of their own, which is read only if one of them changes.
    """

    def __init__(self, version: int = 0, ends: str = "{}", opened: str = "{}", sealed: str = "{}"):
        self.version = version
        self.ends = {block: tuple(end) for block, end in json.loads(ends).items()}
        self.games = {block: {row[1]: tuple(row) for row in rows}
                      for block, rows in json.loads(opened).items()}
        self.stay_open = set(self.games)
        self.sealed = json.loads(sealed)

    def written(self) -> tuple:
        opened = {block: list(self.games[block].values()) for block in sorted(self.stay_open)}
        return self.version, json.dumps(self.ends), json.dumps(opened), json.dumps(self.sealed)

    def _games(self, block: str) -> dict[int, tuple]:
        """Matches of a block by id."""
        if block not in self.games:
            rows = json.loads(self.sealed[block][1]) if block in self.sealed else []
            self.games[block] = {row[1]: tuple(row) for row in rows}
        return self.games[block]

    def _block_of(self, match: int) -> str | None:
        for block, games in self.games.items():
            if match in games:
                return block
        for block, (ids, _) in self.sealed.items():
            if block not in self.games and match in ids:
                return block
        return None

    def take(self, came: list[tuple]) -> tuple[list, list]:
        """Put matches in their places; the lines to emit and the matches that were taken back."""
        first: dict[str, tuple] = {}  # first place changed in each changed block
        gone = []

        def change(block: str, day: str, match: int) -> None:
            first[block] = min(first.get(block, (day, match)), (day, match))

        for game in came:
            day, match, played = game[0], game[1], game[3]
            block = f"{day[:4]}-01-01"
            old_block = self._block_of(match)
            if old_block is not None:
                old = self._games(old_block).pop(match)
                change(old_block, old[0], match)
                if old[3] and not played:
                    gone.append(old)
            if block not in self.games and block not in self.sealed:
                self.stay_open.add(block)
            self._games(block)[match] = game
            change(block, day, match)
        lines = self._replay(first)
        for block in set(self.games) - self.stay_open:
            if block in first:
                self._seal(block)
        self.version += 1
        return lines, gone

    def _replay(self, first: dict[str, tuple]) -> list[tuple]:
        """Lines to emit, from the first changed match on until nothing changes any more."""
        order = sorted({*self.ends, *first})
        begin = order.index(min(first))
        state = self.ends[order[begin - 1]] if begin else START
        lines, last_changed = [], max(first)
        moved = False  # whether the block starts from another state than before
        for block in order[begin:]:
            ordered = sorted(self._games(block).values(), key=lambda game: game[:2])
            found, state = replayed(ordered, state, FACTORS)
            lines += [(game, line) for game, line in zip(ordered, found) if game[3] and (
                moved or (block in first and game[:2] >= first[block]))]
            moved = self.ends.get(block) != state
            if moved:
                self.ends[block] = state
            elif block >= last_changed:
                break
        return lines

    def _seal(self, block: str) -> None:
        games = self.games[block]
        self.sealed[block] = [list(games), json.dumps(list(games.values()))]

    def seal(self) -> None:
        for block in self.stay_open:
            self._seal(block)
        self.stay_open = set()


def _came(rows: list[str]) -> tuple[list[tuple], int]:
    """The newest row of every match as it lies in the state, and the latest time of all rows."""
    newest, latest = {}, None
    for text in sorted(map(json.loads, rows), key=lambda row: row["at"]):
        latest, match, team = text["at"], text["matchId"], text.get("teamId")
        newest[match] = (text["match_date"], match, team, bool(text.get("played")),
                         bool(text.get("in_chemistry")), float(text.get("contribution", "nan")),
                         int(text["foulLoss"]), int(text["ownGoals"]))
    return list(newest.values()), latest


def _frame(player: int, lines: list, gone: list, number: int) -> pd.DataFrame:
    rows = [(player, g[1], g[0], g[2], g[4], g[5], *line, number, False) for g, line in lines]
    rows += [(player, g[1], g[0], g[2], g[4], g[5], *[None] * 6, number, True) for g in gone]
    # What is null or no number stays out and so is null.
    known = [{n: v for n, v in zip(NAMES, row) if v is not None and v == v} for row in rows]
    return pd.DataFrame({"lines": [json.dumps(known)]})


def rating_stream(finished: DataFrame, seal_after: str = SEAL_AFTER,
                  skew: str = "1 hour") -> DataFrame:
    """Rating lines of a stream of finished (player, match) rows: new ones and corrections.

    ``arrival`` says when a row was written; of several versions of a match in one batch the last by
    it counts. It drives the timers and no match is too old; only the clocks of writers may not differ by
    more than ``skew``.
    """
    quiet = int(pd.Timedelta(seal_after).total_seconds() * 1000)

    # State and rows come in batches: a state that is asked for call by call took longer than the work.
    # Rows and lines are one text each, as every column costs time for every player.
    def rated(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        career = Career(*state.get) if state.exists else Career()
        if state.hasTimedOut:
            career.seal()
            state.update(career.written())
            return
        came, latest = _came([row for frame in frames for row in frame["row"]])
        lines, gone = career.take(came)
        state.update(career.written())
        state.setTimeoutTimestamp(latest + quiet)
        if lines or gone:
            yield _frame(int(key[0]), lines, gone, career.version)

    rows = finished.where("playerId IS NOT NULL").withWatermark("arrival", skew)
    texts = rows.select("playerId", "arrival", F.to_json(F.struct(
        *ROW[1:], F.unix_millis("arrival").alias("at"))).alias("row"))
    found = texts.groupBy("playerId").applyInPandasWithState(
        rated, "lines STRING", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return found.select(F.inline(F.from_json("lines", f"ARRAY<STRUCT<{OUTPUT}>>")))


def newest_versions(lines: DataFrame) -> DataFrame:
    """The newest version of every line, also of those that have been taken back."""
    return latest_per_key(lines, ["playerId", "matchId"], "version")


def newest_lines(lines: DataFrame) -> DataFrame:
    """The history: the newest version of every line that has not been taken back."""
    return newest_versions(lines).where(~F.col("retracted")).drop("retracted")
