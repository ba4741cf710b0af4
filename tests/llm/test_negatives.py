"""Hard negatives against brute force: ties, repeated and unusable rows, several vector lengths."""

import math
import random

import numpy as np
import pytest

from touchline.llm import negatives
from touchline.llm.hilbert import hilbert_keys

SCHEMA = "vec_id long, embedding array<float>, label int, size string, chunk int, windows int"


def by_force(rows, every, positives, count, low=80, high=100):
    usable = [(i, label, [math.floor(256 * float(np.float32(x))) for x in v])
              for i, v, label, *_ in rows
              if i is not None and label is not None and v is not None
              and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for k, (i, label, v) in enumerate(usable):
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, other == label)
                        for n, (j, other, w) in enumerate(usable) if n != k and len(w) == len(v))
        for ps, j, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and low * -ps <= 100 * -s[0] <= high * -ps]
            out += [(i, j, r + 1, n, -ps, -s) for r, (s, n, _) in enumerate(fits[:count])]
    return sorted(out)


def rows():
    rng = random.Random(3)
    found = []
    for i in range(900):
        size = 0 if i % 97 == 0 else 3 if i % 11 == 0 else 6
        center = [2.0, -1.0, 0.5, 1.0, 1.0, -2.0][:size] if i % 3 else [0.0] * size
        vector = [round(rng.gauss(c, 0.1 if i % 2 else 1), 1) for c in center]
        found.append((i, vector, rng.choice([0, 0, 0, 1, 2]), "x", 1, 2))
    same = [1.0, 2.0, -1.0, 0.0, 0.0, 1.0]
    found += [(1000 + i, same, i % 4 % 2, "x", 1, 2) for i in range(300)]  # one common vector
    found += [(7, same, 1, "x", 1, 2), (20, found[20][1], found[20][2], None, None, None),
              (None, same, 1, "x", 1, 2), (2000, None, 1, "x", 1, 2), (2001, same, None, "x", 1, 2),
              (2002, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1, "x", 1, 2),
              (2003, [math.nan] * 6, 1, "x", 1, 2), (2004, [math.inf] * 6, 1, "x", 1, 2),
              (2005, [3e12] * 6, 1, "x", 1, 2), (2010, [2e12] * 6, 1, "x", 1, 2)]
    return found


def result(spark, found, every=10, positives=5, count=5):
    data = spark.createDataFrame(found, SCHEMA).repartition(3)
    got = negatives.hard_negatives(negatives.scaled(data, 256), every, positives, count)
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score,
                   r.negative_score) for r in got.collect())


@pytest.mark.parametrize("block", [256, 4])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "GROUP_ROWS", 20 if block == 4 else 256)
    found = [r for r in rows() if r[0] not in (2005, 2010)]
    assert result(spark, found) == by_force(found, 10, 5, 5)


def test_scores_beyond_exact_floats(spark):
    rng = random.Random(8)
    found = [(i, [rng.choice([1e5, 99999.0, 3.0, -2e4]) for _ in range(4)], i % 2, "", 0, 0)
             for i in range(60)]
    assert result(spark, found, 6, 2, 3) == by_force(found, 6, 2, 3)


def test_no_rows_and_no_partner(spark):
    assert result(spark, []) == []
    assert result(spark, [(0, [1.0], 1, "", 0, 0)]) == []
    assert result(spark, [(0, [1.0], 1, "", 0, 0), (1, [1.0], 1, "", 0, 0)]) == []
    assert result(spark, rows()[-2:]) == by_force(rows()[-2:], 10, 5, 5) == []


def test_bounds_hold_and_exclude():
    rng = np.random.default_rng(1)
    rows_, anchors = rng.integers(-99, 99, (500, 8)), rng.integers(-99, 99, (20, 8))
    low, high = rows_.min(0)[None], rows_.max(0)[None]
    least, most = negatives.bounds(anchors, low, high)
    scores = anchors @ rows_.T
    assert (least <= scores).all() and (scores <= most).all()
    # Clustered rows: blocks along the curve leave most of the others out.
    centers = rng.normal(0, 300, (40, 8))
    points = np.concatenate([rng.normal(c, 5, (50, 8)) for c in centers]).astype(np.int64)
    cells = np.clip((points + 1500) // 24, 0, 127)
    points = points[np.argsort(hilbert_keys(cells, 7), kind="stable")]
    blocks = points.reshape(-1, 50, 8)
    _, most = negatives.bounds(points[:100], blocks.min(1), blocks.max(1))
    fifth = np.sort(points[:100] @ points.T, 1)[:, -6]
    assert (most >= fifth[:, None]).mean() < 0.5


def test_neighbours_on_the_curve_are_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3), -1).reshape(-1, 3)
    keys = hilbert_keys(grid, 3)
    assert sorted(keys.tolist()) == list(range(512))
    steps = np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1)
    assert (steps == 1).all()
