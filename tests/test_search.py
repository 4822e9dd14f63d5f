"""Weight searches against fine grids, with bounds that bind."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.blend import weights as W
from pricelab.blend.candidates import blend_inputs, candidate_sums, evaluate


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(13, 0.8, 2000)
    a, b = base + rng.normal(0.03, 0.08, 2000), base * 1.01 + rng.normal(0, 0.15, 2000)
    rows = [(i, i % 3, *map(float, r)) for i, r in enumerate(zip(np.expm1(base), np.expm1(a), np.expm1(b)))]
    return spark.createDataFrame(rows, "building_id long, fold int, y double, p0 double, p1 double").repartition(4).cache()


def grid_best(data, loss, low, high):
    """The least loss over ever finer grids of two bounded weights and an intercept within bounds."""
    centre, width = (low + high) / 2, (high - low) / 2
    for _ in range(9):
        axes = [np.unique(np.clip(np.linspace(c - w, c + w, 9), lo, hi)) for c, w, lo, hi in zip(centre, width, low, high)]
        points = [np.array(p) for p in np.stack(np.meshgrid(*axes), -1).reshape(-1, 3)]
        found = min(evaluate(data, points, loss), key=lambda e: e["loss"])
        centre, width = found["w"], width * 0.5
    return found["loss"]


@pytest.mark.parametrize("loss", ["mape", "mse", "mae", "smooth"])
def test_bounds_that_bind(two, loss):
    low, high = np.array([0.0, 0.0, -0.02]), np.array([0.55, 0.45, 0.02])
    search = W.optimize_weights(two, "y", ["p0", "p1"], loss=loss, bounds=list(zip(low, high)), select="loss", max_iter=60)
    data = blend_inputs(two, "y", ["p0", "p1"]).persist()
    best = grid_best(data, loss, low, high)
    w = np.array(search.weights)
    got = evaluate(data, [w], loss)[0]["loss"]
    assert (w >= low - 1e-12).all() and (w <= high + 1e-12).all() and ((w <= low) | (w >= high)).any()
    assert got <= best * (1 + 1e-5)


@pytest.mark.parametrize("loss", ["mape", "mse"])
def test_free_weights_stand_at_a_minimum(two, loss):
    search = W.optimize_weights(two, "y", ["p0", "p1"], loss=loss, select="loss", max_iter=60)
    data, w = blend_inputs(two, "y", ["p0", "p1"]), np.array(search.weights)
    around = [w + s * v for v in (*np.eye(3), np.array([1.0, -1.0, 0.0])) for s in (1e-4, -1e-4, 1e-3, -1e-3)]
    here, *there = [e["loss"] for e in evaluate(data, [w, *around], loss)]
    assert here <= min(there) * (1 + 1e-6)


def test_starts_and_hopeless_data(spark, two):
    search = W.WeightSearch(["a", "b", "c"], "y", bounds=[(0, 1)] * 3 + [(-1, 1)])
    starts = np.array(search.starts())
    assert (starts[:3] == np.eye(3, 4)).all() and (starts[3:].sum(axis=1) == pytest.approx(1.0)) and (starts[:, 3] == 0).all()
    with pytest.raises(ValueError, match="finite"):
        W.optimize_weights(two.withColumn("y", F.lit(0.0)), "y", ["p0", "p1"], loss="mape", max_iter=2)


def test_folds_in_step_are_the_searches_one_by_one(two):
    fits, scores, mean, _ = W.fold_weight_ensemble(two, "y", ["p0", "p1"], loss="mse", select="loss", max_iter=30)
    for f, (fit, score) in enumerate(zip(fits, scores)):
        alone = W.optimize_weights(two.where(F.col("fold") != f), "y", ["p0", "p1"], loss="mse", select="loss", max_iter=30)
        data = blend_inputs(two.where(F.col("fold") != f), "y", ["p0", "p1"])
        mine, theirs = evaluate(data, [np.array(fit.weights), np.array(alone.weights)], "mse")
        assert mine["loss"] == pytest.approx(theirs["loss"], rel=1e-6)
        assert score == pytest.approx(evaluate(blend_inputs(two.where(F.col("fold") == f), "y", ["p0", "p1"]), [np.array(fit.weights)])[0]["score"])
    assert mean == pytest.approx(np.mean([f.weights for f in fits], axis=0).tolist())


def test_sums_per_fold_add_up(two):
    data = blend_inputs(two, "y", ["p0", "p1"], fold="fold")
    points = [np.array([0.5, 0.5, 0.0]), np.array([0.3, 0.6, 0.1])]
    parts, whole = candidate_sums(data, points, "smooth", slopes=True, by_fold=True), candidate_sums(data, points, "smooth", slopes=True)
    for k in range(2):
        assert sum(parts[f, k] for f in range(3)) == pytest.approx(whole[0, k], rel=1e-9)
