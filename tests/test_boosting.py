"""Penalised boosting against the same rounds in plain numpy, and the penalties' effect."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewalk.operators import boosting, tree_tables
from tidewalk.sources import tables

SCHEMA = "k int, x1 double, x2 double, fwd_ret_20d double"


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 12, size=(160, 2)).astype(float)
    return x, 3 * (x[:, 0] > 5) + x[:, 1] / 4 + rng.normal(size=160) / 10


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y = data
    rows = [(i, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return tables.materialise(spark.createDataFrame(rows, SCHEMA), "boosting-test")


def scores(spark, frame, settings):
    nodes = tables.materialise(boosting.fit_boosted(frame, ["x1", "x2"], ["k"], settings), "nodes")
    scored = tree_tables.score_by_nodes(frame, nodes, ["x1", "x2"], ["k"], settings.depth)
    return np.array([r.prediction for r in scored.orderBy("k").collect()]), nodes


def plain_rounds(x, y, settings):
    """Single splits on all rows and columns."""
    p = np.full(len(y), y.mean())
    for _ in range(settings.rounds):
        r, best = y - p, None
        for c in range(x.shape[1]):
            for cut in np.unique(x[:, c])[:-1]:
                left = x[:, c] <= cut
                score = r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum()
                if best is None or score > best[0] + 1e-12:
                    best = score, left
        for side in (best[1], ~best[1]):
            total = r[side].sum()
            p[side] += settings.step * np.sign(total) * max(abs(total) - settings.l1, 0) / (side.sum() + settings.l2)
    return p


@pytest.mark.parametrize("l1, l2", [(0.0, 0.0), (0.5, 1.0), (20.0, 30.0)])
def test_rounds_equal_plain_ones(spark, data, frame, l1, l2):
    settings = boosting.Boosting(rounds=4, depth=1, step=0.3, l1=l1, l2=l2, row_share=1.0, column_share=1.0)
    found, nodes = scores(spark, frame, settings)
    assert np.allclose(found, plain_rounds(*data, settings), atol=1e-9)
    assert nodes.select("tree").distinct().count() == 5


def test_penalties_shrink_and_draws_repeat(spark, data, frame):
    drawn = dict(rounds=3, depth=3, step=0.3, row_share=0.7, column_share=0.5)
    free, _ = scores(spark, frame, boosting.Boosting(**drawn, l1=0.0, l2=0.0))
    held, nodes = scores(spark, frame, boosting.Boosting(**drawn, l1=5.0, l2=50.0))
    again, _ = scores(spark, frame, boosting.Boosting(**drawn, l1=5.0, l2=50.0))
    assert held.std() < free.std() and np.array_equal(held, again)
    used = nodes.where("feature is not null").groupBy("tree").agg(F.countDistinct("feature").alias("n")).collect()
    assert all(r.n == 1 for r in used)  # half of two columns
    other, _ = scores(spark, frame, boosting.Boosting(**drawn, l1=5.0, l2=50.0, seed=7))
    assert not np.allclose(held, other)


def test_no_rows_are_an_error(spark, frame):
    with pytest.raises(ValueError, match="no rows"):
        boosting.fit_boosted(frame.limit(0), ["x1"], ["k"])
