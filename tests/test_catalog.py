"""Registered queries against their SQL on the smallest tables, and totals pinned from that SQL."""

import pathlib
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from catalog import oracle
from catalog.queries import QUERIES
import compare
from touchline.sources.bridge import Bridge

SAMPLE = ["scan_players", "events_typed", "events_with_match", "player_match_metrics",
          "match_metric_rows", "formation_flat", "appearance_weights", "rating_history",
          "chemistry_as_of", "predict_responses", "player_profile", "match_report",
          "request_dispatch", "stream_live_metrics", "stream_chemistry", "predict_smoothed",
          "chemistry_dense", "feed_lines", "stream_closed_matches"]


def test_every_oracle_belongs_to_a_query():
    names = set(QUERIES)
    assert set(oracle.oracle_sql()) <= names
    assert names == set(oracle.oracle_sql())


def test_entry_has_rows(spark):
    frame = contract.entry(spark)
    assert {"matchId", "playerId", "passAccuracy"} < set(frame.columns) and frame.count() == 150


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_its_sql(spark, sf_dir, name):
    verdict = compare.compare(spark, compare.connect(sf_dir), sf_dir, name)
    assert verdict.startswith("ok"), verdict


def test_pinned_totals(spark, sf_dir):
    season = Bridge(spark, sf_dir).lineup_season
    sums = season.metrics.agg(
        *[F.sum(c) for c in ("normalPasses", "keyPasses", "totalDuels", "totalShots", "numGoals",
                             "foulLoss", "ownGoals")]).collect()[0]
    assert tuple(sums) == (127, 40, 182, 202, 31, 201, 8)
    row = season.history.agg(F.count("*"), F.sum("rating"), F.min("rating"), F.max("rating")).collect()[0]
    assert row[0] == 260
    assert tuple(row)[1:] == (pytest.approx(61.738, abs=1e-3), pytest.approx(0.015625, abs=1e-6),
                              pytest.approx(0.724219, abs=1e-6))
    pairs = season.chemistry.agg(F.count("*"), F.sum("chemistry")).collect()[0]
    assert (pairs[0], pairs[1]) == (552, pytest.approx(266.2846, abs=1e-3))


def test_invariants(spark, sf_dir):
    """Contribution is bounded, chances add up, every pair is stored once with the lower id first."""
    bridge = Bridge(spark, sf_dir)
    top = bridge.lineup_season.history.agg(F.min("contribution"), F.max("contribution")).collect()[0]
    assert 0 <= top[0] and top[1] <= 1.05 * 5 / 4
    pairs = bridge.lineup_season.chemistry
    assert pairs.where("player1 >= player2").count() == 0
    assert pairs.select("player1", "player2").distinct().count() == pairs.count()
    chances = contract.queries()["win_chances"](spark, "/root/testdata/sf0.01").collect()
    assert chances and all(c.chance1 + c.chance2 == pytest.approx(100) for c in chances)


def test_the_entry_works_without_the_corpus_operators():
    """A library that only they need is missing, or they are: all other queries are still there."""
    root = pathlib.Path(contract.__file__).parent
    code = ("import sys; sys.modules[{!r}] = None; import __spark_entry__ as e;"
            "names = e.queries(); print(len(names), len(set(e.oracle_sql()) - set(names)),"
            " any(n[:2] == 'op' and n[2].isdigit() for n in names))")
    for missing in ("ahocorasick", "touchline.llm", "corpus_pipeline"):
        out = subprocess.run([sys.executable, "-c", code.format(missing)], cwd=root, check=True,
                             capture_output=True, text=True).stdout.split()
        assert int(out[0]) > 60 and out[1:] == ["0", "False"]
