"""Model jobs: seeded fits, checked by rows only (a least-squares stack has an SQL twin)."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import functions as F

from pricelab.functions.rows import row_mean
from pricelab.functions.targets import target_inverse, target_transform, threshold_flag
from pricelab.encoders.stages import FeatureSteps
from pricelab.models import importance as I
from pricelab.models import jobs as J
from pricelab.models import lasso as L
from pricelab.models import search as S
from pricelab.operators import metrics as M
from pricelab.operators.quantiles import split_by
from pricelab.operators.tables import union_rows
from pricelab.plans.fixtures import MODELS, fold_of, fold_sql, predictions_wide, transactions, with_preds, with_txn
from pricelab.plans.registry import query
from pricelab.session import stored

ID, PRICE, AREA = "building_id", "total_price", "building_area"
TARGET = "log_per_area_total_price"
FEATURES = [AREA, "land_area", "txn_floor", "total_floor", "txn_dt", "lat", "lon", "parking_price"]
PREDS = [f"pred_{m}" for m in MODELS]
FOLDS = range(5)
# Share of the known set's mean score below which a searched set drops out; folds differ by several percent.
FLOOR_SHARE = 0.9


def _inverse():
    return target_inverse("y_raw", AREA)


def _frame(spark, sf_dir, *more):
    """Feature table with folds, written once because every fold reads it again."""
    df = target_transform(transactions(spark, sf_dir, [*FEATURES, *more, "is_test"]))
    return stored(df.withColumn("fold", fold_of(len(FOLDS))))


def _trees(rounds=20, **more):
    return J.boosted_trees(TARGET, max_iter=rounds, **more)


def _steps():
    return FeatureSteps(
        FEATURES, ["town"], TARGET, fill={"land_area": "median", "parking_price": -1.0, "txn_floor": 0.0, "total_floor": 0.0},
        rare=["town"], scale=False, codes=None,
    )


def _prices(oof):
    return oof.select(ID, "fold", PRICE, _inverse().alias("y_pred"))


@query("cross_predict")
def q_cross_predict(spark, sf_dir):
    df = _frame(spark, sf_dir, "town", "village", "city")
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    result = J.cross_predict(train, _trees, FEATURES, folds=FOLDS, test=test, steps=_steps)
    oof = _prices(result.oof).select(ID, F.lit("cv").alias("kind"), "y_pred")
    mean = row_mean([f"target_{f}" for f in FOLDS])
    tests = result.test.join(test.select(ID, AREA), ID).select(
        ID, F.lit("test-kfold").alias("kind"), target_inverse(mean, AREA).alias("y_pred")
    )
    return oof.unionByName(tests)


@query("boosted_trees")
def q_boosted_trees(spark, sf_dir):
    df = _frame(spark, sf_dir)
    ready = J.assemble(df, FEATURES)
    model = J.fit_on(_trees(), ready.where("fold <> 0"), ready.where("fold = 0"))
    return _prices(model.transform(ready))


@query("random_forest")
def q_random_forest(spark, sf_dir):
    df = _frame(spark, sf_dir)
    result = J.cross_predict(df, lambda: J.random_forest(TARGET), FEATURES, folds=FOLDS)
    return _prices(result.oof)


@query("refit_full")
def q_refit_full(spark, sf_dir):
    df = _frame(spark, sf_dir, "town")
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    cv = J.cross_predict(train, _trees, FEATURES, folds=FOLDS, test=test, steps=_steps)
    make = lambda rounds: _trees(rounds, early_stop=False)
    model, fitted = J.refit_full(train, make, FEATURES, cv.best_iterations, steps=_steps, test=test)
    return model.transform(J.assemble(fitted.transform(test), fitted.features())).select(ID, _inverse().alias(PRICE))


def _grouped(spark, sf_dir, *more):
    return _frame(spark, sf_dir, *more).withColumn("price_group_pred", split_by(AREA, [60.0, 140.0]))


@query("segment_models")
def q_segment_models(spark, sf_dir):
    df = _grouped(spark, sf_dir, "town")
    test = df.where("is_test")
    return _prices(J.segment_models(df, "price_group_pred", [0, 1, 2], _trees, FEATURES, folds=FOLDS, steps=_steps, test=test))


@query("segment_models_duplicated")
def q_segment_models_duplicated(spark, sf_dir):
    df = _grouped(spark, sf_dir)
    make = lambda: _trees(weighted=True)
    return _prices(J.segment_models(df, "price_group_pred", [0, 1, 2], make, FEATURES, folds=FOLDS, duplicate=True))


@query("group_classifier")
def q_group_classifier(spark, sf_dir):
    df = _frame(spark, sf_dir).withColumn("price_group", threshold_flag(TARGET, 7.5))
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    held, votes, _ = J.group_classifier(train, "price_group", FEATURES, test, folds=FOLDS)
    return held.select(ID, F.lit("cv").alias("kind"), "price_group_pred").unionByName(
        votes.select(ID, F.lit("test-kfold").alias("kind"), "price_group_pred")
    )


@query(
    "stack_linear_fit",
    with_preds(
        """SELECT round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept
        FROM (SELECT ln(1 + total_price) AS y, ln(1 + pred_1) AS x FROM preds)"""
    ),
)
def q_stack_linear_fit(spark, sf_dir):
    """Unpenalised stack on one model: its line is ordinary least squares."""
    df = stored(predictions_wide(spark, sf_dir).withColumn("fold", fold_of(len(FOLDS))))
    fit = J.stack_linear(df, PRICE, ["pred_1"], alphas=[0.0], folds=FOLDS)
    one = df.agg(F.count(F.lit(1)).alias("n"))
    return one.select(F.round(F.lit(fit.coefficients[0]), 6).alias("slope"), F.round(F.lit(fit.intercept), 6).alias("intercept"))


@query(
    "stack_linear_two",
    with_preds(
        """SELECT round(b1, 6) AS w1, round(b2, 6) AS w2, round(my - b1 * m1 - b2 * m2, 5) AS intercept FROM (
          SELECT (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) AS b1, (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) AS b2, my, m1, m2 FROM (
            SELECT covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2, covar_pop(x1, x2) AS v12, var_pop(x1) AS v1, var_pop(x2) AS v2,
                   avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2
            FROM (SELECT ln(1 + total_price) AS y, ln(1 + pred_1) AS x1, ln(1 + pred_2) AS x2 FROM preds)))"""
    ),
)
def q_stack_linear_two(spark, sf_dir):
    """Unpenalised stack on two models, against the normal equations."""
    df = predictions_wide(spark, sf_dir).withColumn("fold", fold_of(len(FOLDS)))
    fit = J.stack_linear(df, PRICE, ["pred_1", "pred_2"], alphas=[0.0], folds=FOLDS)
    weights = [F.round(F.lit(w), 6).alias(f"w{i + 1}") for i, w in enumerate(fit.coefficients)]
    return df.agg(F.count(F.lit(1)).alias("n")).select(*weights, F.round(F.lit(fit.intercept), 5).alias("intercept"))


@query(
    "stack_linear_path",
    with_preds(
        f"""SELECT alpha, input, TRUE AS optimal, n FROM (SELECT unnest([{", ".join(f"{float(a)!r}::DOUBLE" for a in J.STACK_ALPHAS)}]) AS alpha),
        (SELECT unnest([{", ".join(f"'__x{i}'" for i in range(len(MODELS)))}]) AS input), (SELECT count(*) AS n FROM preds)"""
    ),
)
def q_stack_linear_path(spark, sf_dir):
    """Every penalty's line meets the Lasso's optimality conditions over all rows."""
    df = stored(predictions_wide(spark, sf_dir, [AREA]).withColumn("fold", fold_of(len(FOLDS))))
    ready, inputs = J.stack_inputs(df, PRICE, PREDS, AREA)
    moments = reduce(L.Moments.__add__, L.fold_moments(ready, inputs, "__y", "fold").values())
    found = L.path_conditions(ready, inputs, "__y", L.lines_of(moments, J.STACK_ALPHAS))
    return found.select("alpha", "input", "optimal").join(F.broadcast(df.agg(F.count(F.lit(1)).alias("n"))))


@query("stack_linear")
def q_stack_linear(spark, sf_dir):
    df = stored(predictions_wide(spark, sf_dir, [AREA]).withColumn("fold", fold_of(len(FOLDS))))
    fit = J.stack_linear(df, PRICE, PREDS, area=AREA, folds=FOLDS)
    return df.select(ID, PRICE, fit.prediction().alias("y_pred"))


@query("stack_boosted")
def q_stack_boosted(spark, sf_dir):
    df = stored(predictions_wide(spark, sf_dir).withColumn("fold", fold_of(len(FOLDS))))
    make = lambda target: J.boosted_trees(target)
    return J.stack_boosted(df, PRICE, PREDS, make, folds=FOLDS).oof.select(ID, PRICE, "y_pred")


@query("param_grid")
def q_param_grid(spark, sf_dir):
    est = _trees(early_stop=False)
    space = {"maxDepth": [3, 4, 5], "stepSize": [0.1, 0.2]}
    return S.param_grid(_frame(spark, sf_dir), est, space, FEATURES, TARGET, folds=len(FOLDS))


@query("random_search")
def q_random_search(spark, sf_dir):
    space = {"depth": [2, 3, 4], "step": [0.2, 0.4], "n_feats_rm": [0, 1, 2]}
    known = {"depth": 3, "step": 0.4, "n_feats_rm": 0}
    params = S.draw_params(space, 18, seed=7, seeds=[known])
    make = lambda p: J.boosted_trees(TARGET, depth=p["depth"], step=p["step"])
    ranked = ["lon", "lat", "txn_dt"]
    features_of = lambda p: [c for c in FEATURES if c not in ranked[: p["n_feats_rm"]]]
    df = _frame(spark, sf_dir)
    # A set must come near the known one's mean score.
    parts, fits = J.fit_layout(df)
    with J.fit_rows(df, make(known), FEATURES, fold=F.col("fold")) as rows:
        tasks = [partial(S.fold_scores, df, make(known), features_of(known), TARGET, _inverse(), PRICE, "fold", f, parts, rows) for f in FOLDS]
        done = [(known, f, scored) for f, scored in zip(FOLDS, J.run_all(tasks, J.at_a_time(rows, fits)))]
        floor = FLOOR_SHARE * sum(scored["score"] for _, _, scored in done) / len(done)
        return S.random_search(
            df, make, params, features_of, TARGET, _inverse(), folds=FOLDS, floor=floor, keep_pruned=True, done=done, rows=rows
        )


@query("iteration_curve")
def q_iteration_curve(spark, sf_dir):
    curve = I.price_curve(_frame(spark, sf_dir), lambda: _trees(early_stop=False), FEATURES, TARGET, PRICE, AREA, folds=FOLDS)
    return I.mean_price_curve(curve)


@query(
    "iteration_curve_last",
    with_txn(
        f"""SELECT fold, part, TRUE AS same, CASE part WHEN 'val' THEN held ELSE n - held END AS n FROM (
          SELECT {fold_sql(5)} AS fold, count(*) AS held, sum(count(*)) OVER ()::BIGINT AS n FROM txn GROUP BY 1),
        (SELECT unnest(['train', 'val']) AS part)"""
    ),
)
def q_iteration_curve_last(spark, sf_dir):
    """The curve's last round against the models' own predictions, per fold and part, scored by the aggregates."""
    df, rounds = _frame(spark, sf_dir), 8
    make = lambda: _trees(rounds, early_stop=False)
    curve = I.price_curve(df, make, FEATURES, TARGET, PRICE, AREA, folds=FOLDS).where(F.col("iteration") == rounds)
    ready = J.assemble(df, FEATURES)
    with J.fit_rows(df, make(), FEATURES, fold=F.col("fold")) as rows:
        models = J.run_all([partial(J.fit_other_folds, make(), ready, "fold", f, rows, FEATURES) for f in FOLDS], J.at_a_time(rows, 1))
    scored = []
    for f, model in zip(FOLDS, models):
        priced = model.transform(ready).withColumn("y_pred", F.expm1("y_raw") * F.col(AREA))
        part = F.when(F.col("fold") == f, "val").otherwise("train")
        scored.append(
            priced.groupBy(part.alias("part")).agg(
                F.count(F.lit(1)).alias("n"), M.hit_score(PRICE, "y_pred").alias("s"), M.msle(PRICE, "y_pred").alias("l"), M.mse(TARGET, "y_raw").alias("m")
            ).withColumn("fold", F.lit(f))
        )
    both = curve.join(union_rows(*scored), ["fold", "part"])
    same = reduce(lambda a, b: a & b, [F.abs(F.col(a) - F.col(b)) < 1e-6 for a, b in (("score", "s"), ("msle", "l"), ("mse", "m"))])
    return both.select("fold", "part", same.alias("same"), "n")


@query("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    return I.permutation_importance(_frame(spark, sf_dir), _trees, FEATURES, _inverse(), folds=FOLDS)


@query("step_removal")
def q_step_removal(spark, sf_dir):
    ranked = ["lon", "lat", "txn_dt", "parking_price"]
    return S.step_removal(_frame(spark, sf_dir), _trees, ranked, FEATURES, range(len(ranked) + 1), TARGET, _inverse(), folds=FOLDS)


@query("single_addition")
def q_single_addition(spark, sf_dir):
    base = ["lat", "lon", "txn_dt"]
    extra = [c for c in FEATURES if c not in base]
    return S.single_addition(_frame(spark, sf_dir), _trees, base, extra, TARGET, _inverse(), folds=FOLDS)


@query("tree_importance")
def q_tree_importance(spark, sf_dir):
    df = _frame(spark, sf_dir)
    model = J.fit_on(_trees(early_stop=False), J.assemble(df, FEATURES))
    return I.tree_importance(model, FEATURES, df)


@query(
    "tree_importance_nodes",
    with_txn(
        f"""SELECT feat, TRUE AS same_gain, TRUE AS same_splits, n
        FROM (SELECT unnest([{", ".join(repr(c) for c in FEATURES)}]) AS feat), (SELECT count(*) AS n FROM txn)"""
    ),
)
def q_tree_importance_nodes(spark, sf_dir):
    """Gain shares from the node table against the model's own, and split counts against its inner nodes."""
    df = _frame(spark, sf_dir)
    model = J.fit_on(_trees(8, early_stop=False), J.assemble(df, FEATURES))
    own = spark.createDataFrame([(c, float(v)) for c, v in zip(FEATURES, model.featureImportances.toArray())], "feat string, own double")
    # A binary tree has one leaf more than inner nodes.
    inner = sum((t.numNodes - 1) // 2 for t in model.trees)
    found = I.tree_importance(model, FEATURES, df).join(own, "feat")
    total = found.agg((F.sum("splits") == inner).alias("same_splits"))
    rows = df.agg(F.count(F.lit(1)).alias("n"))
    return found.join(F.broadcast(total)).join(F.broadcast(rows)).select("feat", (F.abs(F.col("gain") - F.col("own")) < 1e-9).alias("same_gain"), "same_splits", "n")
