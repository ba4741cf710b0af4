"""Touchline: match-event analytics as Spark plans."""

from touchline.plans.season import Season

__all__ = ["Season"]
