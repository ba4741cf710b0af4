"""A season: the input tables and every stage derived from them.

Stages are lazy DataFrames. Nothing runs until an answer is asked for, and stages shared
inside one plan are shuffled once because Spark reuses equal exchanges.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.operators import chemistry, metrics, profiles, ratings, sheets, smoothing
from touchline.operators.events import of_known_players
from touchline.sources import records
from touchline.sources.sinks import materialise


def smoothed_by_name(smoothed: DataFrame) -> DataFrame:
    return profiles.first_by_name(smoothed.select(
        "name", "Id", "role", F.col("smoothed_rating").alias("rating")))


@dataclass(frozen=True)
class Season:
    """``matches`` holds whole match records. Their line-ups and their dates may also be given
    apart, where they are at hand without reading the whole records."""

    players: DataFrame
    teams: DataFrame
    matches: DataFrame
    events: DataFrame
    team_sheets: DataFrame | None = None
    match_dates: DataFrame | None = None

    @classmethod
    def from_lines(cls, lines: DataFrame, players: DataFrame, teams: DataFrame) -> Season:
        """Season from the raw feed; a header that was sent again counts once."""
        matches = records.newest_matches(records.read_matches(lines))
        return cls(players, teams, matches, records.read_events(lines))

    @cached_property
    def sheets(self) -> DataFrame:
        return self.team_sheets if self.team_sheets is not None else sheets.team_sheets(self.matches)

    @cached_property
    def appearances(self) -> DataFrame:
        return sheets.appearances(self.sheets)

    @cached_property
    def counts(self) -> DataFrame:
        """Metrics of everyone the events name; the one stage that reads the events."""
        return metrics.all_metrics(self.events)

    @cached_property
    def metrics(self) -> DataFrame:
        return of_known_players(self.counts, self.players)

    @cached_property
    def career_rows(self) -> DataFrame:
        dates = self.match_dates if self.match_dates is not None else sheets.match_dates(self.matches)
        return ratings.career_rows(self.appearances, self.counts, dates)

    @cached_property
    def history(self) -> DataFrame:
        return ratings.rating_history(self.career_rows)

    @cached_property
    def latest(self) -> DataFrame:
        return ratings.latest_ratings(self.history)

    @cached_property
    def deltas(self) -> DataFrame:
        return chemistry.chemistry_deltas(self.history)

    @cached_property
    def chemistry(self) -> DataFrame:
        return chemistry.chemistry_table(self.deltas)

    @cached_property
    def profiles(self) -> DataFrame:
        totals = metrics.career_totals(self.metrics)
        return profiles.player_profiles(self.players, totals, self.latest)

    @cached_property
    def by_name(self) -> DataFrame:
        """Profiles as requests find them."""
        return profiles.first_by_name(self.profiles)

    @cached_property
    def rated_names(self) -> DataFrame:
        """The little of a profile that a prediction needs."""
        return profiles.first_by_name(self.profiles.select("name", "Id", "role", "rating"))

    @cached_property
    def smoothed_names(self) -> DataFrame:
        """The same with smoothed ratings: a table, so that the clustering is fitted once however many
        batches of requests are answered."""
        smoothed = smoothing.smooth_ratings(self.profiles)
        return materialise(smoothed_by_name(smoothed), "smoothed-names")

    @cached_property
    def kept(self) -> set[str]:
        """Names of the stages that are tables."""
        return set()

    def with_given(self, **tables: DataFrame) -> Season:
        """The same season with stages that are at hand as tables. Earlier ones stay; all other
        plans are made anew over them."""
        given = replace(self)
        given.__dict__.update({n: self.__dict__[n] for n in self.kept}, **tables)
        given.__dict__["kept"] = self.kept | set(tables)
        return given

    def with_stored(self, *stages: str) -> Season:
        """The same season with the named stages written to the shared folder and read back.

        For stages that several parts of an answer use, and for the tables that requests are
        joined with: both sides of such a join are then plain shuffles, so Spark can split a
        name or pair that a large share of the requests ask for. Name inputs before the stages
        made from them.
        """
        stored = self.with_given()
        for name in stages:
            stored.__dict__[name] = materialise(getattr(stored, name), name)
            stored.kept.add(name)
        return stored
