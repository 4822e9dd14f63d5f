"""Model jobs with a least-squares learner: folds, segments and refits against lines that SQL fits itself."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from pricelab.blend import weights as W
from pricelab.encoders.geometry import GeoCluster, PcaReduce
from pricelab.functions.rows import row_mean
from pricelab.functions.targets import target_inverse, target_transform
from pricelab.models import jobs as J
from pricelab.models import search as S
from pricelab.operators.quantiles import split_by
from pricelab.plans.fixtures import (
    MODELS, fold_of, fold_sql, hit_sql, predictions_wide, rounded, stored_transactions, transactions, with_preds, with_txn,
)
from pricelab.plans.registry import query
from pricelab.session import stored

ID, PRICE, AREA = "building_id", "total_price", "building_area"
TARGET = "log_per_area_total_price"
FOLDS = range(5)
CUTS = [60.0, 140.0]
PREDS = [f"pred_{m}" for m in MODELS]

_BASE = f"""base AS (SELECT building_id, is_test, total_price, {fold_sql(len(FOLDS))} AS fold, building_area AS x, lat, lon,
CASE WHEN building_area < {CUTS[0]} THEN 0 WHEN building_area < {CUTS[1]} THEN 1 ELSE 2 END AS seg, ln(1 + total_price / building_area) AS y FROM txn)"""
_FOLDS = f"f AS (SELECT unnest(range({len(FOLDS)})) AS fold)"
# The price of a raw prediction, on a log scale so that six digits mean the same at any size.
_LOG_PRICE = "round(ln((exp({}) - 1) * x), 6)"


def _frame(spark, sf_dir, *more):
    df = target_transform(transactions(spark, sf_dir, [AREA, *more, "is_test"]))
    return stored(df.withColumn("fold", fold_of(len(FOLDS))))


def _line(**more):
    return LinearRegression(featuresCol=J.FEATURES, labelCol=TARGET, predictionCol="y_raw", solver="normal", **more)


def _log_price(raw):
    return F.round(F.log(target_inverse(raw, AREA)), 6).alias("log_price")


@query(
    "cross_predict_line",
    with_txn(
        f"""SELECT building_id, 'cv' AS kind, {_LOG_PRICE.format("a + b * x")} AS log_price FROM base JOIN ln USING (fold) WHERE NOT is_test
        UNION ALL SELECT building_id, 'test-kfold', {_LOG_PRICE.format("avg(a + b * x)")} FROM base, ln WHERE is_test GROUP BY building_id, x""",
        _BASE, _FOLDS,
        """ln AS (SELECT f.fold, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
        FROM f JOIN base ON base.fold <> f.fold AND NOT is_test GROUP BY f.fold)""",
    ),
)
def q_cross_predict_line(spark, sf_dir):
    """Out-of-fold and test predictions of one line per fold."""
    df = _frame(spark, sf_dir)
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    result = J.cross_predict(train, _line, [AREA], folds=FOLDS, test=test)
    tests = result.test.join(test.select(ID, AREA), ID)
    return result.oof.select(ID, F.lit("cv").alias("kind"), _log_price("y_raw")).unionByName(
        tests.select(ID, F.lit("test-kfold").alias("kind"), _log_price(row_mean([f"target_{f}" for f in FOLDS])))
    )


@query(
    "refit_full_line",
    with_txn(
        f"""SELECT building_id, {_LOG_PRICE.format("a + b * x")} AS log_price
        FROM base, (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM base WHERE NOT is_test) WHERE is_test""",
        _BASE,
    ),
)
def q_refit_full_line(spark, sf_dir):
    """The line of all train rows, applied to the test rows."""
    df = _frame(spark, sf_dir)
    model = J.refit_full(df.where(~F.col("is_test")), lambda rounds: _line(), [AREA], [0])
    return model.transform(J.assemble(df.where("is_test"), [AREA])).select(ID, _log_price("y_raw"))


def _segment_sql(copies: str) -> str:
    return with_txn(
        f"""SELECT building_id, base.seg, {_LOG_PRICE.format("a + b * x")} AS log_price FROM base JOIN ln USING (fold, seg)""",
        _BASE, _FOLDS,
        f"""ln AS (SELECT f.fold, s.seg, regr_slope(y, x) AS b, regr_intercept(y, x) AS a
        FROM f, (SELECT unnest(range({len(CUTS) + 1})) AS seg) s, base t, {copies} GROUP BY f.fold, s.seg)""",
    )


def _segments(spark, sf_dir, make, duplicate):
    df = _frame(spark, sf_dir).withColumn("seg", split_by(AREA, CUTS))
    out = J.segment_models(df, "seg", range(len(CUTS) + 1), make, [AREA], folds=FOLDS, duplicate=duplicate)
    return out.select(ID, "seg", _log_price("y_raw"))


@query("segment_models_line", _segment_sql("(SELECT 1) WHERE t.fold <> f.fold AND t.seg = s.seg"))
def q_segment_models_line(spark, sf_dir):
    """One line per segment and fold."""
    return _segments(spark, sf_dir, _line, False)


@query(
    "segment_models_duplicated_line",
    _segment_sql("(SELECT unnest([1, 2]) AS copy) WHERE t.fold <> f.fold AND (copy = 1 OR t.seg = s.seg)"),
)
def q_segment_models_duplicated_line(spark, sf_dir):
    """Lines of all rows, those of the own segment counted twice."""
    return _segments(spark, sf_dir, lambda: _line(weightCol=J.WEIGHT), True)


_SWEEP = [
    _BASE, _FOLDS,
    """v AS (SELECT *, 'lat' AS added, lat AS x2 FROM base UNION ALL SELECT *, 'lon', lon FROM base UNION ALL SELECT *, 'none', 0e0 FROM base)""",
    """m AS (SELECT f.fold, added, covar_pop(x, y) AS c1, covar_pop(x2, y) AS c2, covar_pop(x, x2) AS v12, var_pop(x) AS v1, var_pop(x2) AS v2,
    avg(y) AS my, avg(x) AS m1, avg(x2) AS m2 FROM f JOIN v ON v.fold <> f.fold GROUP BY f.fold, added)""",
    """w AS (SELECT *, CASE WHEN added = 'none' THEN c1 / v1 ELSE (c1 * v2 - c2 * v12) / (v1 * v2 - v12 * v12) END AS b1,
    CASE WHEN added = 'none' THEN 0 ELSE (c2 * v1 - c1 * v12) / (v1 * v2 - v12 * v12) END AS b2 FROM m)""",
    """p AS (SELECT v.fold, added, total_price, x, y, my + b1 * (x - m1) + b2 * (x2 - m2) AS raw FROM v JOIN w USING (fold, added))""",
    f"""s AS (SELECT fold, added, {hit_sql("total_price", "((exp(raw) - 1) * x)")} AS score, avg((raw - y) * (raw - y)) AS mse,
    avg(abs(raw - y)) AS mae FROM p GROUP BY fold, added)""",
]
_SWEPT = "round(avg(score), 5) AS score, round(avg(mse), 6) AS mse, round(avg(mae), 6) AS mae"


def _swept(found, name, param):
    scores = found.select(F.col("params")[param].alias(name), F.round("score", 5).alias("score"), "mse", "mae")
    return rounded(scores, 6, ["mse", "mae"])


@query("single_addition_line", with_txn(f"SELECT added, {_SWEPT} FROM s GROUP BY added", *_SWEEP))
def q_single_addition_line(spark, sf_dir):
    """The area alone and with one coordinate more, per-fold scores averaged."""
    df = _frame(spark, sf_dir, "lat", "lon")
    found = S.single_addition(df, _line, [AREA], ["lat", "lon"], TARGET, target_inverse("y_raw", AREA), folds=FOLDS)
    return _swept(found, "added", "added")


@query(
    "step_removal_line",
    with_txn(f"SELECT CASE added WHEN 'none' THEN '1' ELSE '0' END AS n_feats_rm, {_SWEPT} FROM s WHERE added <> 'lon' GROUP BY added", *_SWEEP),
)
def q_step_removal_line(spark, sf_dir):
    """Area and latitude, then the area without it."""
    df = _frame(spark, sf_dir, "lat")
    found = S.step_removal(df, _line, ["lat"], [AREA, "lat"], [0, 1], TARGET, target_inverse("y_raw", AREA), folds=FOLDS)
    return _swept(found, "n_feats_rm", "n_feats_rm")


@query(
    "PcaReduce_two",
    with_txn(
        """SELECT building_id, round(abs((building_area - mx) * cos(t) + (lat - my) * sin(t)), 6) AS pca_0,
        round(abs((lat - my) * cos(t) - (building_area - mx) * sin(t)), 6) AS pca_1 FROM txn,
        (SELECT avg(building_area) AS mx, avg(lat) AS my,
          atan2(2 * covar_samp(building_area, lat), var_samp(building_area) - var_samp(lat)) / 2 AS t FROM txn)"""
    ),
)
def q_pca_reduce_two(spark, sf_dir):
    """Components of two columns are a rotation by a known angle; signs are free."""
    df = stored_transactions(spark, sf_dir, [AREA, "lat", "is_test"])
    reduced = PcaReduce(2).fit(df.where(~F.col("is_test")), df.where("is_test"), [AREA, "lat"]).transform(df)
    return rounded(reduced.select(ID, F.abs("pca_0").alias("pca_0"), F.abs("pca_1").alias("pca_1")), 6)


@query("GeoCluster_nearest", with_txn("SELECT is_test, count(*) AS n, TRUE AS nearest FROM txn GROUP BY is_test"))
def q_geo_cluster_nearest(spark, sf_dir):
    """Every row is in the cluster whose centre is nearest."""
    df = stored_transactions(spark, sf_dir, ["lat", "lon", "is_test"])
    fitted = GeoCluster(6).fit(df.where(~F.col("is_test")), df.where("is_test"))
    away = [F.pow(F.col("lat") - F.lit(float(a)), 2) + F.pow(F.col("lon") - F.lit(float(o)), 2) for a, o in fitted.model.clusterCenters()]
    own = F.get(F.array(*away), F.col("encoded_latlon"))
    return fitted.transform(df).groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(own <= F.least(*away) + F.lit(1e-9)).alias("nearest")
    )


@query(
    "random_refine_start",
    with_preds(f"""SELECT round({hit_sql("total_price", "((1.003e0 * pred_1 + 1.003e0 * pred_2 + 1.003e0 * pred_3) / 3)")}, 6) AS score, TRUE AS rising, TRUE AS on_simplex FROM preds"""),
)
def q_random_refine_start(spark, sf_dir):
    """The search starts at the mean's score, only rises, and stays on the simplex."""
    # Errors are whole percents: moved off the hit rate's edge.
    df = stored(predictions_wide(spark, sf_dir).select(ID, PRICE, *[(F.col(p) * F.lit(1.003)).alias(p) for p in PREDS]))
    found = W.random_refine_blend(df, PRICE, PREDS, moves=400)
    total = F.aggregate("weights", F.lit(0.0), lambda a, w: a + w)
    inside = (F.abs(total - 1) < 1e-9) & (F.array_min("weights") >= 0)
    rows = found.agg(
        F.min_by("score", "move").alias("score"), (F.array_sort(F.collect_list("score")) == F.transform(
            F.array_sort(F.collect_list(F.struct("move", "score"))), lambda r: r["score"])).alias("rising"),
        F.bool_and(inside).alias("on_simplex"),
    )
    return rounded(rows, 6)
