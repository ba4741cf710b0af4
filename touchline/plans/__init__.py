"""Whole answers: the season snapshot and the three request types."""
