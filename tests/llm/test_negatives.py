"""Hard negatives against all scores, and what the bounds of the tree save."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from parcelgrid.llm import negatives
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string"


def mined_by_force(rows):
    """The query contract, one score at a time."""
    use = []
    for vec_id, vector, label, *_ in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = int(np.fmod(label + 1, 10))
        use.append((vec_id, label, [int(np.floor(256 * float(np.float32(x)))) for x in vector]))
    out = Counter()
    last = lambda i: (i is None, i or 0)
    for a, (anchor, label, vector) in enumerate(use):
        if anchor is None or anchor % 100:
            continue
        scored = sorted(
            ((-sum(x * y for x, y in zip(vector, v)), last(i), i, lab) for k, (i, lab, v) in enumerate(use) if k != a),
            key=lambda r: r[:2],
        )
        for ps, _, positive, _ in [s for s in scored if s[3] == label][:5]:
            fits = [s for s in scored if s[3] != label and 80 * -ps <= 100 * -s[0] <= 100 * -ps][:5]
            for rank, (ns, _, negative, _) in enumerate(fits, 1):
                out[anchor, positive, rank, negative, -ps, -ns] += 1
    return out


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = negatives.mine(negatives.quantized(frame), F.col("id") % 100 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined_by_force(rows)
    assert Counter(map(tuple, got.collect())) == want
    return want


def clustered(rng, n, width=16, spread=0.05, centres=6):
    tops = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(centres)]
    return [[c + rng.gauss(0, spread) for c in rng.choice(tops)] for _ in range(n)]


@pytest.mark.parametrize("shelf, cell", [(1024, 4096), (7, 100)])
def test_clustered_vectors(spark, monkeypatch, shelf, cell):
    monkeypatch.setattr(negatives, "SHELF", shelf)
    monkeypatch.setattr(negatives, "CELL", cell)
    rng = random.Random(1)
    ids = [i * 20 for i in range(350)]
    rows = [(i, v, 1 if rng.random() < 0.4 else rng.randrange(5)) for i, v in zip(ids, clustered(rng, 350))]
    assert len(check(spark, rows)) > 100


def test_copies_and_ties(spark):
    rng = random.Random(2)
    one = [rng.gauss(0, 1) for _ in range(8)]
    rows = [(i, one, i % 3) for i in range(0, 1200, 10)]  # a hot vector: every score ties
    rows += [(300, one, 2), (300, one, 2), (300, [x / 2 for x in one], 2), (None, one, 0), (None, one, 1)]
    assert len(check(spark, rows)) > 100


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 1), (100, None, 1), (200, [1.0, None], 1), (300, [nan, 1.0], 2), (400, [inf, 1.0], 2), (500, [1.0, 1.0], None),
        (600, [], 3), (1, [], 3), (2, [1.0], 1), (3, [1.0, 0.5, 7.0], 2), (4, [0.9, 0.5], 2), (-100, [-1.0, -0.5], 1), (7, [0.95, 0.5], 9),
        (700, [-1e-9, 2.0], 5), (8, [1.0, 0.45], -4), (None, [1.0, 0.5], 0), (800, [0.0, 0.0], 4), (9, [0.0, 0.0], 4), (10, [0.0, 0.0], 5),
    ]
    assert check(spark, rows)
    check(spark, rows[1:2])
    check(spark, [(1, [1.0], 1), (2, [1.0], 2)])
    assert negatives.mine(negatives.quantized(spark.createDataFrame([], SCHEMA)), F.col("id") % 100 == 0).count() == 0


def test_large_components_stay_exact(spark):
    rng = random.Random(3)
    rows = [(i * 50, [rng.uniform(-1, 1) * 2e5 for _ in range(4)], i % 2) for i in range(60)]
    assert check(spark, rows)
    frame = spark.createDataFrame([(0, [1e15], 1, "x"), (1, [1e15], 1, "x")], SCHEMA)
    with pytest.raises(Exception, match="may not fit a long"):
        negatives.mine(negatives.quantized(frame), F.col("id") % 100 == 0).collect()


def test_bounds_hold_and_save_scores():
    rng = random.Random(4)
    x = np.floor(256 * np.array(clustered(rng, 3000, 32, 0.02)))
    a = x[::30]
    order, parent, edge = negatives.spanning_forest(a)
    assert sorted(order) == list(range(len(a))) and (parent < np.arange(len(a))).all()
    assert (parent < 0).sum() == 6  # one tree a cluster
    a = a[order]
    truth = x @ a.T
    scored = 0

    def want(place, low, high):
        assert (low <= truth[:, place]).all() and (truth[:, place] <= high).all()
        return np.nonzero(high >= negatives._least_kept(low, 6))[0]

    for place, index, score in negatives.walk(a, parent, edge, x, want):
        assert (score == truth[index, place]).all()
        best = negatives._best(score, index, 6)
        assert list(index[best]) == list(negatives._best(truth[:, place], np.arange(len(x)), 6))
        scored += len(index)
    assert scored < 0.4 * len(x) * len(a), scored / (len(x) * len(a))
