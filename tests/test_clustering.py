"""Clusters against a plain implementation, and on any number of partitions; dense pairs."""

import itertools
import random

import pytest

from touchline.operators import chemistry, clustering, smoothing

SCHEMA = "Id BIGINT, a DOUBLE, b BIGINT, c DOUBLE"


def rows(n=400):
    rng = random.Random(6)
    spots = [(0, 0, 0), (5, 90, 1), (9, 10, 0.5), (0.1, 60, 0)]
    found = [(i, rng.gauss(x, 1), abs(int(rng.gauss(y, 5))), float(rng.choice([z, 0.25])))
             for i in range(n) for x, y, z in [rng.choice(spots)]]
    return [(i, abs(a), b, c) for i, a, b, c in found]


def by_hand(found, k):
    points = {i: [int(v * 1000 + 0.5000001) for v in x] for i, *x in found if None not in x}

    def apart(x, c):
        total = 0.0
        for a, b in zip(x, c):
            total += float(a - b) * float(a - b)
        return total

    centers = [points[min(points)]]
    while len(centers) < k:
        centers.append(points[max(points, key=lambda i: (
            min(apart(points[i], c) for c in centers), -i))])
    for _ in range(clustering.MAX_ROUNDS):
        place = {i: min(range(k), key=lambda n: (apart(x, centers[n]), n)) for i, x in points.items()}
        moved = []
        for n in range(k):
            mine = [points[i] for i in points if place[i] == n]
            moved.append([sum(v) // len(mine) for v in zip(*mine)] if mine else centers[n])
        if moved == centers:
            break
        centers = moved
    return {i: min(range(k), key=lambda n: (apart(x, centers[n]), n)) for i, x in points.items()}


@pytest.mark.parametrize("partitions", [3, 8, 32])
def test_clusters_do_not_depend_on_partitions(spark, partitions):
    found = rows()
    frame = spark.createDataFrame(found, SCHEMA).repartition(partitions)
    got = clustering.clusters(frame, ["a", "b", "c"], 5)
    assert {r.Id: r.prediction for r in got.collect()} == by_hand(found, 5)


def test_few_equal_and_incomplete_rows(spark):
    found = [(3, 1.0, 1, 1.0), (1, 1.0, 1, 1.0), (2, None, 1, 1.0)]
    got = clustering.clusters(spark.createDataFrame(found, SCHEMA), ["a", "b", "c"], 5)
    assert {r.Id: r.prediction for r in got.collect()} == {1: 0, 3: 0}
    assert clustering.clusters(spark.createDataFrame([], SCHEMA), ["a"], 5).count() == 0


def test_only_rookies_get_the_rating_of_their_cluster(spark):
    people = [(i, 0.1 * (i % 9), i % 8, 180 if i < 20 else None) for i in range(24)]
    frame = spark.createDataFrame(people, "Id BIGINT, rating DOUBLE, numMatches INT, height INT")
    got = smoothing.smooth_ratings(frame, ["rating", "height"]).collect()
    by_cluster = {}
    for r in got:
        by_cluster.setdefault(r.prediction, []).append(r.rating)
    for r in got:
        rookie = r.numMatches < 5 and r.height is not None
        mean = sum(by_cluster[r.prediction]) / len(by_cluster[r.prediction])
        assert r.smoothed_rating == pytest.approx(mean if rookie else r.rating)


@pytest.mark.parametrize("block_rows", [1, 7, 256])
def test_dense_pairs(spark, block_rows):
    ids = [5, 9, 1, 40, 41, 42, 100, 9, None, 3, 77, 78, 79]
    got = chemistry.dense_pairs(spark.createDataFrame([(i,) for i in ids], "playerId BIGINT"),
                                block_rows=block_rows)
    want = itertools.combinations(sorted({i for i in ids if i is not None}), 2)
    assert sorted(map(tuple, got.collect())) == sorted(want)


@pytest.mark.parametrize("block_rows", [2, 256])
def test_dense_pairs_of_groups(spark, block_rows):
    people = [(t, p) for t, n in ((1, 9), (2, 1), (None, 3), (4, 25)) for p in range(100, 100 + n)]
    got = chemistry.dense_pairs(spark.createDataFrame(people, "teamId INT, playerId BIGINT"),
                                ["teamId"], block_rows)
    want = [(t, a, b) for t in (1, 2, None, 4)
            for a, b in itertools.combinations(sorted(p for team, p in people if team == t), 2)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_dense_chemistry_starts_at_the_start_value(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "playerId BIGINT")
    known = spark.createDataFrame([(1, 3, 0.75)], "player1 BIGINT, player2 BIGINT, chemistry DOUBLE")
    got = chemistry.dense_chemistry(ids, known)
    assert sorted((r.player1, r.player2, r.chemistry) for r in got.collect()) == [
        (1, 2, 0.5), (1, 3, 0.75), (2, 3, 0.5)]


def test_points_are_dealt_to_all_cores(spark, monkeypatch):
    """One small file of rows is not left to one task, round after round."""
    seen = []
    fitted = clustering.fitted_centers
    monkeypatch.setattr(clustering, "fitted_centers",
                        lambda rows, k: seen.append(len(rows.inputFiles())) or fitted(rows, k))
    rows = spark.range(0, 1000, 1, 1).selectExpr("id AS Id", "CAST(id % 7 AS DOUBLE) AS x")
    assert clustering.clusters(rows, ["x"], 3).count() == 1000
    assert seen == [spark.sparkContext.defaultParallelism]
