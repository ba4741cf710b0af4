"""Dates and messages carried as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_date(date_text: Column) -> Column:
    """``"May 5, 2018 at 3:00:00 PM GMT+2"`` to a date; NULL when it is not one."""
    words = F.slice(F.split(F.trim(date_text), " "), 1, 3)
    return F.try_to_timestamp(F.array_join(words, " "), F.lit("MMMM d, yyyy")).cast("date")


def iso_date(value: Column) -> Column:
    return F.date_format(value, "yyyy-MM-dd")


def missing_player(name: Column) -> Column:
    return F.concat(F.lit("Player : "), name, F.lit(" does not exist"))


def not_played(status: Column) -> Column:
    return F.concat(F.lit("Match was "), status.cast("string"))
