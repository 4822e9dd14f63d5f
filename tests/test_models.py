import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.blend import means as B
from pricelab.blend import weights as W
from pricelab.blend.candidates import blend_inputs, evaluate
from pricelab.functions.keys import seeded_bucket
from pricelab.functions.targets import target_inverse
from pricelab.models import importance as I
from pricelab.models import jobs as J
from pricelab.models import search as S
from pricelab.operators import metrics as M
from pricelab.session import stored


@pytest.fixture(scope="module")
def sales(spark):
    """Log price driven by x, with a noise feature z."""
    df = spark.range(1500).select(
        F.col("id").alias("building_id"),
        (F.col("id") * 7919 % 1009 / 100).alias("x"),
        (F.col("id") * 104729 % 997 / 100).alias("z"),
        F.lit(2.0).alias("building_area"),
        seeded_bucket(1, "id", 3).alias("fold"),
    )
    df = df.withColumn("lp", F.lit(8.0) + F.col("x") / 3).withColumn("total_price", F.expm1("lp") * 2)
    return stored(df.withColumn("grp", (F.col("x") > 5).cast("int")))


@pytest.fixture(scope="module")
def blend(spark):
    df = spark.range(2000).select(F.col("id").alias("building_id"), (F.lit(1000.0) + F.col("id")).alias("total_price"), (F.col("id") % 3).alias("fold"))
    wave = lambda k, s: F.col("total_price") * (1 + ((F.col("building_id") * k % 41) - 20) / F.lit(100.0) * s)
    return stored(df.withColumns({"p1": wave(7, 0.5), "p2": wave(11, 1.0), "p3": wave(3, 2.0)}))


PREDS = ["p1", "p2", "p3"]
inverse = lambda: target_inverse("y_raw", "building_area")
trees = lambda rounds=6, **kw: J.boosted_trees("lp", max_iter=rounds, depth=3, step=0.4, **kw)


def test_cross_predict_covers_every_row_once_and_beats_the_mean(spark, sales):
    result = J.cross_predict(sales, trees, ["x", "z"], folds=range(3), test=sales.limit(50))
    assert result.oof.select("building_id").distinct().count() == result.oof.count() == 1500
    assert result.test.count() == 50 and set(result.test.columns) == {"building_id", "target_0", "target_1", "target_2"}
    r = result.oof.agg(M.mse("lp", "y_raw").alias("m"), F.var_pop("lp").alias("v")).first()
    assert r["m"] < 0.1 * r["v"]
    assert len(result.best_iterations) == 3
    model = J.refit_full(sales, lambda n: trees(n, early_stop=False), ["x", "z"], result.best_iterations)
    assert model.getNumTrees == max(1, int(np.mean(result.best_iterations) * 1.2))


def test_seeds_repeat(spark, sales):
    a, b = (J.cross_predict(sales, trees, ["x"], folds=range(3)).oof.agg(F.sum("y_raw")).first()[0] for _ in range(2))
    assert a == pytest.approx(b, rel=1e-9)


def test_segments_predict_their_own_rows(spark, sales):
    out = J.segment_models(sales, "grp", [0, 1], lambda: trees(3), ["x"], folds=range(3))
    assert out.select("building_id").distinct().count() == out.count() == 1500
    doubled = J.segment_models(sales, "grp", [0, 1], lambda: trees(3, weighted=True), ["x"], folds=[0], duplicate=True)
    assert doubled.count() == sales.where("fold = 0").count()


def test_classifier_votes(spark, sales):
    held, votes, scores = J.group_classifier(sales, "grp", ["x", "z"], sales.limit(40), folds=range(3), max_iter=3, depth=2)
    assert held.count() == 1500 and votes.count() == 40
    assert min(s["acc"] for s in scores) > 0.95 and min(s["auc"] for s in scores) > 0.95


def test_linear_stack_prefers_a_useful_penalty(spark, blend):
    fit = J.stack_linear(blend, "total_price", PREDS, alphas=(0.0, 10.0), folds=range(3))
    assert fit.alpha == 0.0 and fit.scores.count() == 6
    score = lambda p: blend.agg(M.mape("total_price", p)).first()[0]
    assert score(fit.prediction()) < min(score(F.col(p)) for p in PREDS)


def test_lasso_matches_its_closed_form(spark):
    """One centered variable: the coefficient shrinks by alpha over the variance."""
    df = spark.range(400).select((F.col("id") % 2).alias("fold"), (F.exp(F.col("id") % 20 / 10) - 1).alias("p"))
    df = df.withColumn("y", F.expm1(F.log1p("p") * 2 + 1))
    fit = J.stack_linear(df, "y", ["p"], alphas=(0.05,), folds=range(2))
    var = df.agg(F.var_pop(F.log1p("p"))).first()[0]
    assert fit.coefficients[0] == pytest.approx((2 * var - 0.05) / var, rel=1e-4)


def test_search_prunes_below_the_floor(spark, sales):
    params = [{"feature": "x"}, {"feature": "z"}]
    search = lambda floor: S.random_search(
        sales, lambda p: trees(4), params, lambda p: [p["feature"]], "lp", inverse(), folds=range(2), floor=floor
    )
    scores = {r["params"]["feature"]: r["score"] for r in search(None).collect()}
    assert scores["z"] < scores["x"]
    out = search((scores["z"] + scores["x"]) / 2)
    assert [r["params"] for r in out.collect()] == [{"feature": "x"}]
    assert len(out.first()["scores"]) == 2


def test_fits_share_one_queue_and_nothing_is_fitted_twice(spark, sales, monkeypatch):
    queues, fitted = [], []
    run, fit = J.run_all, S.fit_fold
    monkeypatch.setattr(S, "run_all", lambda tasks, n: queues.append(len(tasks)) or run(tasks, n))
    monkeypatch.setattr(S, "fit_fold", lambda est, *a: fitted.append(est) or fit(est, *a))
    S.step_removal(sales, lambda: trees(1), ["z", "x"], ["x", "z", "building_area"], [0, 1, 2], "lp", inverse())
    S.single_addition(sales, lambda: trees(1), ["x"], ["z"], "lp", inverse())
    assert queues == [9, 6]
    fitted.clear()
    out = S.param_grid(sales, trees(2, early_stop=False), {"maxDepth": [1, 2]}, ["x"], "lp", top=1)
    sets = out.count()
    assert len(fitted) == 3 * sets and out.where("search_round = 2").count() == sets - 2
    with pytest.raises(ValueError, match="must hold 0 to 3"):
        S.param_grid(sales, trees(1, early_stop=False), {"maxDepth": [1]}, ["x"], "lp", folds=4)
    fitted.clear()
    known = {"feature": "x"}
    done = [(known, f, S.fold_scores(sales, trees(1), ["x"], "lp", inverse(), "total_price", "fold", f)) for f in range(3)]
    S.random_search(sales, lambda p: trees(1), [known, {"feature": "z"}], lambda p: [p["feature"]], "lp", inverse(), done=done)
    assert len(fitted) == 6


def test_grid_scores_are_those_of_a_cross_validator(spark, sales):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.ml.tuning import CrossValidator

    est = trees(2, early_stop=False)
    rows = S.param_grid(sales, est, {"maxDepth": [1, 2]}, ["x", "z"], "lp", top=1).where("search_round = 1").collect()
    cv = CrossValidator(
        estimator=est, estimatorParamMaps=[{est.maxDepth: d} for d in (1, 2)], numFolds=3, foldCol="fold",
        evaluator=RegressionEvaluator(labelCol="lp", predictionCol="y_raw"),
    ).fit(J.assemble(sales, ["x", "z"]).select(J.FEATURES, "lp", "fold"))
    assert [r["rmse"] for r in rows] == pytest.approx(list(cv.avgMetrics), rel=1e-9)


def test_a_fold_is_one_scan_and_large_tables_take_fewer_fits(spark, sales, monkeypatch):
    ready, held = J.assemble(sales, ["x", "z"]), F.col("fold") == 1
    two = J.fit_on(trees(), ready.where(~held), ready.where(held))
    one = J.fit_fold(trees(), ready, held)
    body = lambda m: m.toDebugString.split("\n", 1)[1]
    assert body(one) == body(two)
    cores = spark.sparkContext.defaultParallelism
    assert J.fit_layout(sales) == (None, min(J.MOST_FITS, 2 * cores))
    monkeypatch.setattr(J, "ROWS_PER_FIT_TASK", 500)
    assert J.fit_layout(sales)[0] == 3 and J.in_parts(sales, 3).rdd.getNumPartitions() <= 3
    monkeypatch.setattr(J, "ROWS_PER_FIT_TASK", 1)
    assert J.fit_layout(sales) == (1500, 1)


def test_side_by_side_tasks_keep_their_own_local_properties(spark):
    from threading import Barrier

    gate, sc = Barrier(4), spark.sparkContext

    def one(i):
        sc.setLocalProperty("pricelab.task", str(i))
        gate.wait(30)
        return sc.getLocalProperty("pricelab.task")

    assert J.run_all([lambda i=i: one(i) for i in range(4)], 4) == ["0", "1", "2", "3"]


def test_sweep_does_not_cache_its_frame(spark, sales, monkeypatch):
    from pricelab.encoders.geometry import GeoCluster

    levels, fit = [], GeoCluster._fit_one
    monkeypatch.setattr(GeoCluster, "_fit_one", lambda self, p, k, s: levels.append(p.storageLevel.useMemory) or fit(self, p, k, s))
    costs = {r["k"]: r["inertia"] for r in GeoCluster(seeds=[1]).sweep(sales, range(2, 5), ("x", "z")).collect()}
    assert levels == [False] * 3 and costs[2] > costs[3] > costs[4]


def test_drawn_parameters_are_unique():
    space = {"a": [1, 2, 3], "b": [4, 5]}
    drawn = S.draw_params(space, 10, seed=3, seeds=[{"a": 1, "b": 4}])
    assert len(drawn) == 6 and drawn[0] == {"a": 1, "b": 4}
    assert all(drawn.count(d) == 1 for d in drawn)
    assert S.draw_params(space, 4, seed=3) == S.draw_params(space, 4, seed=3)
    assert {"a": 2, "b": 4} in S.grid_around([{"a": 1, "b": 4}], space)


def test_permutation_importance_ranks_the_driver(spark, sales):
    rows = I.permutation_importance(sales, trees, ["x", "z"], inverse(), folds=[0]).collect()
    score = {r["feat"]: r["score"] for r in rows}
    assert score["x"] < score["z"] <= score["none"] + 200
    one_by_one = {}
    ready = [J.assemble(part, ["x", "z"]) for part in (sales.where("fold <> 0"), sales.where("fold = 0"))]
    model = J.fit_on(trees(), *ready)
    moved = I.with_donors(sales.where("fold = 0"), ["x", "z"], "building_id", 42)
    for feat in ("none", "x", "z"):
        variant = moved if feat == "none" else moved.withColumn(feat, F.col(f"__d_{feat}"))
        one_by_one[feat] = model.transform(J.assemble(variant, ["x", "z"])).agg(M.hit_score("total_price", inverse())).first()[0]
    assert score == pytest.approx(one_by_one, rel=1e-12)
    donors = I.with_donors(sales, ["x"], "building_id", 1)
    assert donors.count() == 1500
    assert sorted(r[0] for r in donors.select("__d_x").collect()) == sorted(r[0] for r in sales.select("x").collect())


def test_curve_and_tree_importance(spark, sales):
    curve = I.mean_curve(I.iteration_curve(sales, lambda: trees(4, early_stop=False), ["x"], folds=[0])).orderBy("iteration").collect()
    assert len(curve) == 4 and curve[-1]["train_mse"] < curve[0]["train_mse"]
    model = J.fit_on(trees(3, early_stop=False), J.assemble(sales, ["x", "z"]))
    gain = {r["feat"]: r["gain"] for r in I.tree_importance(model, ["x", "z"], sales).collect()}
    assert gain["x"] > gain["z"] and sum(gain.values()) == pytest.approx(1.0)


def test_sweeps(spark, sales):
    removed = S.step_removal(sales, lambda: trees(3), ["z", "x"], ["x", "z", "building_area"], [0, 2], "lp", inverse(), folds=[0])
    assert {r["params"]["n_feats_rm"]: r["score"] for r in removed.collect()}["0"] > removed.collect()[-1]["score"]
    added = S.single_addition(sales, lambda: trees(3), ["z"], ["x"], "lp", inverse(), folds=[0])
    assert added.first()["params"] == {"added": "x"}


def test_simplex_grid():
    grid = W.simplex_grid(3, 5)
    assert len(grid) == len(set(grid)) == 21
    assert all(sum(w) == pytest.approx(1.0) for w in grid)


def test_small_and_large_grids_agree(spark, blend, monkeypatch):
    small = sorted(map(tuple, W.simplex_grid_blend(blend, "total_price", PREDS, steps=3, metric="mape", log=True).collect()))
    monkeypatch.setattr(M, "CANDIDATES_PER_PASS", 4)
    large = sorted(map(tuple, W.simplex_grid_blend(blend, "total_price", PREDS, steps=3, metric="mape", log=True).collect()))
    assert [r[:4] for r in small] == [r[:4] for r in large]
    assert [r[4] for r in small] == pytest.approx([r[4] for r in large])


def test_candidate_scores_match_the_aggregates(spark, blend):
    points = [np.array([0.5, 0.3, 0.2]), np.array([1.0, 0.0, 0.0])]
    for log in (True, False):
        got = evaluate(blend_inputs(blend, "total_price", PREDS, log=log), points, "smooth", log)
        for p, g in zip(points, got):
            want = blend.agg(
                M.hit_score("total_price", M.blended(PREDS, p, log)), M.mape("total_price", M.blended(PREDS, p, log)),
                M.smooth_score("total_price", M.blended(PREDS, p, log)),
            ).first()
            assert (g["score"], g["mape"], g["loss"]) == pytest.approx(tuple(want), rel=1e-9)


@pytest.mark.parametrize("loss", ["mape", "mse", "mae", "smooth"])
def test_slopes_match_differences(spark, blend, loss):
    data = blend_inputs(blend.where("building_id % 41 <> 20"), "total_price", PREDS)
    w, h = np.array([0.41, 0.33, 0.27, 0.01]), 1e-6
    steps = [w + s * h * np.eye(4)[j] for j in range(4) for s in (1, -1)]
    grad = evaluate(data, [w], loss, slopes=True)[0]["grad"]
    ends = [e["loss"] for e in evaluate(data, steps, loss)]
    numeric = [(ends[2 * j] - ends[2 * j + 1]) / (2 * h) for j in range(4)]
    assert grad == pytest.approx(numeric, rel=2e-2)


def test_optimised_weights_beat_every_model(spark, blend):
    search = W.optimize_weights(blend, "total_price", PREDS, loss="mape", select="loss", max_iter=6)
    best_single = min(blend.agg(M.mape("total_price", p)).first()[0] for p in PREDS)
    got = blend.agg(M.mape("total_price", search.prediction()), M.hit_score("total_price", search.prediction())).first()
    assert tuple(got) == pytest.approx((search.mape, search.score))
    assert got[0] < 0.9 * best_single


def test_selection_by_score_tracks_the_best_hit_score(spark, blend):
    search = W.optimize_weights(blend, "total_price", PREDS, loss="smooth", max_iter=3)
    equal = blend.agg(M.hit_score("total_price", B.log_mean_blend(PREDS))).first()[0]
    assert search.score > equal


def test_bounds_hold(spark, blend):
    bounds = [(0, 1)] * 3 + [(-2, 2)]
    search = W.optimize_weights(blend, "total_price", PREDS, loss="mape", bounds=bounds, select="loss", max_iter=4)
    assert all(lo - 1e-12 <= w <= hi + 1e-12 for w, (lo, hi) in zip(search.weights, bounds))


def test_fold_ensemble_scores_held_out_rows(spark, blend):
    fits, scores, mean, price = W.fold_weight_ensemble(blend, "total_price", PREDS, folds=range(3), loss="mape", max_iter=2)
    assert len(fits) == len(scores) == 3 and len(mean) == 4
    assert blend.select(price.alias("p")).where("p is null").count() == 0


def test_refine_only_improves(spark, blend):
    rows = W.random_refine_blend(blend, "total_price", PREDS, moves=60, batch=30).orderBy("move").collect()
    assert [r["score"] for r in rows] == sorted(r["score"] for r in rows)
    assert all(sum(r["weights"]) == pytest.approx(1.0) and min(r["weights"]) >= 0 for r in rows)


def test_backward_subset_trials(spark, blend):
    rows = B.backward_subset_mean(blend, "total_price", PREDS).collect()
    assert [sum(1 for r in rows if r["step"] == s) for s in range(3)] == [1, 3, 2]


def test_blend_guards(spark, blend, capsys):
    B.weighted_blend(PREDS, [0.5, 0.2, 0.2])
    assert "weights sum" in capsys.readouterr().out
    assert B.no_zeros(blend, PREDS) and not B.no_zeros(blend.withColumn("p1", F.lit(0.0)), PREDS)


def test_rows_without_a_fold_or_segment_are_errors(spark, sales):
    from pyspark.sql import functions as F

    with pytest.raises(ValueError, match="no fold"):
        J.cross_predict(sales.withColumn("fold", F.when(F.col("fold") > 0, F.col("fold"))), lambda: None, ["x"])
    with pytest.raises(ValueError, match="no model"):
        J.segment_models(sales, "grp", [0], lambda: None, ["x"])


def test_registered_jobs_run_whole(spark, monkeypatch):
    """Registered model queries use every penalty, five folds, all sets, a floor that can prune and the top three."""
    from pricelab.plans import blends, jobs

    seen = {}

    def note(name):
        def run(df, *args, **kw):
            seen[name] = (args, kw)
            raise StopIteration

        return run

    sf = "/root/testdata/sf0.001"
    for module, name, query in (
        (J, "stack_linear", jobs.q_stack_linear), (S, "param_grid", jobs.q_param_grid), (S, "random_search", jobs.q_random_search),
        (S, "step_removal", jobs.q_step_removal), (W, "fold_weight_ensemble", blends.q_fold_weight_ensemble),
    ):
        monkeypatch.setattr(module, name, note(name))
        monkeypatch.setattr(S, "fold_scores", lambda *a: {"score": 4000.0})
        with pytest.raises(StopIteration):
            query(spark, sf)
    assert "alphas" not in seen["stack_linear"][1] and list(seen["stack_linear"][1]["folds"]) == list(range(5))
    assert len(seen["random_search"][0][1]) == 18 and 3000 < seen["random_search"][1]["floor"] < 4000
    assert "top" not in seen["param_grid"][1] and seen["param_grid"][1]["folds"] == 5
    assert list(seen["step_removal"][0][3]) == [0, 1, 2, 3, 4]
    assert list(seen["fold_weight_ensemble"][1]["folds"]) == list(range(5)) and seen["fold_weight_ensemble"][1]["max_iter"] >= 100
    assert jobs._trees().getMaxIter() >= 20


def test_unlisted_folds_come_from_the_data(spark, sales, blend):
    five = stored(sales.withColumn("fold", F.col("building_id") % 5))
    small = lambda: trees(1, early_stop=False)
    lengths = lambda out: {len(r["scores"]) for r in out.collect()}
    assert lengths(S.random_search(five, lambda p: small(), [{"a": 1}], lambda p: ["x"], "lp", inverse())) == {5}
    assert lengths(S.step_removal(five, small, ["z"], ["x", "z"], [1], "lp", inverse())) == {5}
    assert lengths(S.single_addition(five, small, ["x"], [], "lp", inverse())) == {5}
    assert {r["fold"] for r in I.iteration_curve(five, small, ["x"]).collect()} == set(range(5))
    assert {r["fold"] for r in I.permutation_importance(five, small, ["x"], inverse()).collect()} == set(range(5))
    assert len(W.fold_weight_ensemble(blend, "total_price", PREDS, loss="mape", max_iter=1)[0]) == 3


def test_listed_folds_must_cover_the_data(spark, sales, blend):
    with pytest.raises(ValueError, match="leave out"):
        J.cross_predict(sales, trees, ["x"], folds=[0, 1])
    with pytest.raises(ValueError, match="leave out"):
        W.fold_weight_ensemble(blend, "total_price", PREDS, folds=[0])
    with pytest.warns(UserWarning, match="not validated"):
        J.fold_values(sales, "fold", [0], whole=False)


def test_towns_rare_in_train_but_in_test_are_kept(spark, sales, monkeypatch):
    from pricelab.encoders.stages import FeatureSteps

    town = F.when(F.col("building_id") == 7, "rare_both").when(F.col("building_id") == 8, "rare_train").otherwise("big")
    df = stored(sales.withColumn("town", town))
    test = stored(spark.createDataFrame([("rare_both",)], "town string").crossJoin(df.drop("town").limit(1)))
    made = []

    def steps():
        made.append(FeatureSteps(["x"], ["town"], "lp", rare=["town"], scale=False, codes=None))
        return made[-1]

    def nulled():
        return {r["value"] for s in made for r in s.rare_nuller.rare["town"].collect()}

    small = lambda *a: trees(1, early_stop=False)
    J.cross_predict(df, small, ["x"], folds=range(3), test=test, steps=steps)
    assert nulled() == {"rare_train"}
    made.clear()
    model, fitted = J.refit_full(df, small, ["x"], [1], steps=steps, test=test)
    assert nulled() == {"rare_train"} and fitted.features() == ["x", "encoded_town"] and model.numFeatures == 2
    made.clear()
    out = J.segment_models(df, "grp", [0, 1], small, ["x"], steps=steps, test=test)
    assert out.count() == 1500 and nulled() == {"rare_train"}
