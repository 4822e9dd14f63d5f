"""Lasso paths, numbered grids, ranked grids and metrics per boosting round, against direct computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.blend import grid as G, weights as W
from pricelab.models import importance as I, jobs as J, lasso as L, nodes as N
from pricelab.operators import metrics as M


def descend(x, y, alpha, steps=200_000):
    """Proximal gradient descent on the centred data, run until it stands."""
    x, y = x - x.mean(0), y - y.mean()
    c, g = x.T @ x / len(x), x.T @ y / len(x)
    step, b = 1.0 / np.linalg.eigvalsh(c).max(), np.zeros(x.shape[1])
    for _ in range(steps):
        z = b - step * (c @ b - g)
        new = np.sign(z) * np.maximum(np.abs(z) - step * alpha, 0.0)
        if np.abs(new - b).max() < 1e-15:
            break
        b = new
    return b


@pytest.fixture(scope="module")
def stack(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(13, 1, 900)
    preds = [base + rng.normal(0, s, 900) for s in (0.1, 0.2, 0.05, 0.4)]
    price, preds = np.expm1(base), np.expm1(preds)
    rows = [(i, i % 4, float(price[i]), float(1 + i % 9), *map(float, preds[:, i])) for i in range(900)]
    return spark.createDataFrame(rows, "building_id long, fold int, y double, area double, p0 double, p1 double, p2 double, p3 double").repartition(5).cache()


PREDS = ["p0", "p1", "p2", "p3"]


@pytest.mark.parametrize("area", [None, "area"])
def test_lines_of_all_folds_and_penalties(stack, area):
    pdf = stack.toPandas()
    a = 1.0 if area is None else pdf[area].to_numpy()
    x = np.log1p(pdf[PREDS].to_numpy() / (a if area is None else a[:, None]))
    y = np.log1p(pdf["y"].to_numpy() / a)
    ready, inputs = J.stack_inputs(stack, "y", PREDS, area)
    moments = L.fold_moments(ready, inputs, "__y", "fold")
    whole = moments[0] + moments[1] + moments[2] + moments[3]
    alphas = (0, 0.0001, 0.001, 0.02, 0.3)
    for f in range(4):
        rows = pdf["fold"].to_numpy() != f
        lines = L.lines_of(whole - moments[f], alphas)
        for alpha in alphas:
            got = lines[float(alpha)]
            want = np.linalg.lstsq(x[rows] - x[rows].mean(0), y[rows] - y[rows].mean(), rcond=None)[0] if alpha == 0 else descend(x[rows], y[rows], alpha)
            assert got.coefficients == pytest.approx(want, abs=1e-8)
            assert got.intercept == pytest.approx(y[rows].mean() - x[rows].mean(0) @ want, abs=1e-7)
    assert (lines[0.3].coefficients == 0).any()


def test_held_out_scores_match_the_aggregate(stack):
    fit = J.stack_linear(stack, "y", PREDS, alphas=(0, 0.001, 0.1), area="area")
    ready, inputs = J.stack_inputs(stack, "y", PREDS, "area")
    moments = L.fold_moments(ready, inputs, "__y", "fold")
    whole = moments[0] + moments[1] + moments[2] + moments[3]
    for r in fit.scores.collect():
        line = L.lines_of(whole - moments[r["fold"]], [r["alpha"]])[r["alpha"]]
        price = J.linear_price(PREDS, line.coefficients, line.intercept, "area")
        assert r["score"] == pytest.approx(stack.where(F.col("fold") == r["fold"]).agg(M.hit_score("y", price)).first()[0], abs=1e-9)
    assert fit.scores.count() == 12


def test_stacks_with_gaps_copies_and_constants(spark, stack):
    with pytest.raises(ValueError, match="1 rows have gaps"):
        J.stack_linear(stack.withColumn("p1", F.when(F.col("building_id") != 3, F.col("p1"))), "y", PREDS)
    twice = stack.withColumns({"p4": F.col("p2"), "p5": F.lit(5.0)})
    fit = J.stack_linear(twice, "y", [*PREDS, "p4", "p5"], alphas=(0, 0.0005))
    assert np.isfinite(fit.coefficients).all() and fit.coefficients[5] == 0.0
    one = J.stack_linear(stack, "y", PREDS, alphas=(0, 0.0005))
    best = lambda f: f.scores.agg(F.max("score")).first()[0]
    assert best(fit) == pytest.approx(best(one), abs=12)


@pytest.mark.parametrize("n, steps", [(1, 4), (2, 5), (3, 5), (4, 6), (8, 3)])
def test_numbered_vectors_are_the_listed_grid(n, steps):
    grid = W.simplex_grid(n, steps)
    assert G.grid_size(n, steps) == len(grid)
    assert [tuple(w) for w in G.unrank(np.arange(len(grid)), n, steps)] == grid
    if n > 1:
        last = G.grid_size(37, steps) - 1
        assert G.unrank(np.array([0, last]), 37, steps)[:, [0, -1]].tolist() == [[0.0, 1.0], [1.0, 0.0]]


@pytest.mark.parametrize("metric", G.GRID_METRICS)
@pytest.mark.parametrize("log", [False, True])
def test_grid_scores_match_the_aggregates(stack, metric, log, monkeypatch):
    monkeypatch.setattr(G, "VECTORS", 7)
    gappy = stack.withColumn("p1", F.when(F.col("building_id") % 50 != 3, F.col("p1"))).withColumn("y", F.when(F.col("building_id") != 5, F.col("y")).otherwise(0.0))
    got = {tuple(r)[:-1]: r[-1] for r in G.score_grid(gappy, "y", PREDS, 3, metric, log).collect()}
    want = {tuple(r)[:-1]: r[-1] for r in M.score_weight_grid(gappy, "y", PREDS, W.simplex_grid(4, 3), metric, log).collect()}
    assert set(got) == set(want) and len(got) == 20
    assert all(got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_best_of_a_grid_in_ranges(stack, monkeypatch):
    every = sorted(map(tuple, W.simplex_grid_blend(stack, "y", PREDS, 4, "mape").collect()), key=lambda r: (r[-1], r[0]))
    monkeypatch.setattr(G, "HELD_VECTORS", 10)
    got = sorted(map(tuple, W.simplex_grid_blend(stack, "y", PREDS, 4, "mape", best=6).collect()), key=lambda r: (r[-1], r[0]))
    assert [r[0] for r in got] == [r[0] for r in every[:6]]
    top = W.simplex_grid_blend(stack, "y", PREDS, 4, "score", best=1).first()
    assert top["score"] == pytest.approx(max(r[-1] for r in W.simplex_grid_blend(stack, "y", PREDS, 4).collect()))


@pytest.mark.parametrize("log", [False, True])
def test_ranked_metrics_of_many_vectors(stack, log):
    weights = [(1, 0, 0, 0), (0.5, 0.5, 0, 0), (0.1, 0.2, 0.3, 0.4), (0, 0, 0, 1)]
    labelled = stack.withColumn("label", (F.col("y") > 500_000).cast("int"))
    coarse = labelled.withColumns({p: F.round(F.col(p), -5) for p in PREDS})
    for metric, truth in (("gini", "y"), ("auc", "label")):
        got = {r["weight_id"]: r[metric] for r in M.score_weight_grid(coarse, truth, PREDS, weights, metric, log).collect()}
        assert len(got) == 4
        for i, w in enumerate(weights):
            blend = coarse.withColumn("b", M.blended(PREDS, w, log))
            one = M.auc(blend, truth, "b") if metric == "auc" else M.gini_normalized(blend, truth, "b", "building_id")
            assert got[i] == pytest.approx(one.first()[metric], rel=1e-9)


@pytest.fixture(scope="module")
def sales(spark):
    df = spark.range(600).select(
        F.col("id").alias("building_id"), (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") * 37 % 101).cast("double").alias("x"),
        F.when(F.col("id") % 11 != 0, (F.col("id") * 53 % 17).cast("double")).alias("z"), (F.col("id") % 5 + 1).cast("double").alias("area"),
    )
    return df.withColumn("price", F.col("area") * (1000 + 40 * F.col("x") + F.coalesce("z", F.lit(3.0)) * 9)).withColumn("lp", F.log1p(F.col("price") / F.col("area"))).cache()


def test_every_round_matches_the_shorter_model(sales):
    make = lambda k: (lambda: J.boosted_trees("lp", max_iter=k, depth=3, step=0.3, early_stop=False))
    curve = {(r["fold"], r["part"], r["iteration"]): r for r in I.price_curve(sales, make(5), ["x", "z"], "lp", "price", "area").collect()}
    assert len(curve) == 3 * 2 * 5
    ready = J.assemble(sales, ["x", "z"])
    for f in range(3):
        for k in (1, 3, 5):
            priced = J.fit_on(make(k)(), ready.where(F.col("fold") != f)).transform(ready).withColumn("p", F.expm1("y_raw") * F.col("area"))
            for part, rows in (("val", priced.where(F.col("fold") == f)), ("train", priced.where(F.col("fold") != f))):
                want = rows.agg(M.hit_score("price", "p"), M.mape("price", "p"), M.msle("price", "p"), M.mse("lp", "y_raw")).first()
                got = curve[f, part, k]
                assert [got[m] for m in ("score", "mape", "msle", "mse")] == pytest.approx(list(want), rel=1e-9)
    mean = {(r["part"], r["iteration"]): r for r in I.mean_price_curve(I.price_curve(sales, make(2), ["x"], "lp", "price", "area")).collect()}
    assert {r["folds"] for r in mean.values()} == {3} and mean["train", 2]["mse"] < mean["train", 1]["mse"]


def test_forest_rounds_and_split_counts(sales):
    ready = J.assemble(sales, ["x", "z", "area"])
    for est in (J.random_forest("lp", trees=4, depth=4), J.boosted_trees("lp", max_iter=4, depth=3, early_stop=False)):
        model = J.fit_on(est, ready)
        x = np.array([r[0].toArray() for r in ready.select(J.FEATURES).collect()])
        last = N.trees_of(model, sales).rounds(x)[:, -1]
        assert last == pytest.approx([r[0] for r in model.transform(ready).select("y_raw").collect()], rel=1e-9)
        got = {r["feat"]: r for r in N.split_importance(model, ["x", "z", "area"], sales).collect()}
        assert [got[c]["gain"] for c in ("x", "z", "area")] == pytest.approx(model.featureImportances.toArray().tolist(), abs=1e-9)
        assert sum(r["splits"] for r in got.values()) == sum((t.numNodes - 1) // 2 for t in model.trees)
