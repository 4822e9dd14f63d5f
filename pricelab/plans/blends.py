"""Blends and weight searches over the stand-in models."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.blend import means as B
from pricelab.blend import weights as W
from pricelab.functions.targets import target_transform
from pricelab.plans.fixtures import MODELS, fold_of, hit_sql, predictions_wide, rounded, transactions, with_preds, with_txn
from pricelab.plans.registry import query
from pricelab.session import stored

ID, PRICE, AREA = "building_id", "total_price", "building_area"
PREDS = [f"pred_{m}" for m in MODELS]

# Fixed value: bound on search steps that starts reach only if they never converge.
MOST_STEPS = 200


@query(
    "kfold_test_mean",
    with_txn(
        """SELECT building_id, round(greatest(exp((lp + (lp + 0.25e0) + (lp - 0.5e0)) / 3) - 1, 0) * building_area, 2) AS total_price
        FROM (SELECT *, ln(1 + total_price / building_area) AS lp FROM txn)"""
    ),
)
def q_kfold_test_mean(spark, sf_dir):
    lp = F.col("log_per_area_total_price")
    df = target_transform(transactions(spark, sf_dir, [AREA])).withColumns(
        {"target_0": lp, "target_1": lp + 0.25, "target_2": lp - 0.5}
    )
    return df.select(ID, F.round(B.kfold_test_mean(["target_0", "target_1", "target_2"], AREA), 2).alias(PRICE))


@query(
    "log_mean_blend",
    with_preds(
        """SELECT building_id, round(ln(1 + exp((ln(1 + pred_1) + ln(1 + pred_2) + ln(1 + pred_3)) / 3) - 1), 8) AS log_of_log1p_mean,
        round((ln(pred_1) + ln(pred_2) + ln(pred_3)) / 3, 8) AS log_of_log_mean FROM preds"""
    ),
)
def q_log_mean_blend(spark, sf_dir):
    # Compared on the log scale, where no value is an exact decimal.
    df = predictions_wide(spark, sf_dir)
    return df.select(
        ID, F.round(F.log1p(B.log_mean_blend(PREDS)), 8).alias("log_of_log1p_mean"),
        F.round(F.log(B.log_mean_blend(PREDS, plus_one=False)), 8).alias("log_of_log_mean"),
    )


@query("mean_blend", with_preds("SELECT building_id, round((pred_1 + pred_2 + pred_3) / 3, 5) AS mean FROM preds"))
def q_mean_blend(spark, sf_dir):
    return predictions_wide(spark, sf_dir).select(ID, F.round(B.mean_blend(PREDS), 5).alias("mean"))


@query(
    "weighted_blend",
    with_preds(
        """SELECT building_id, round(0.5e0 * pred_1 + 0.3e0 * pred_2 + 0.2e0 * pred_3, 6) AS plain,
        round(ln(1 + greatest(exp(0.5e0 * ln(1 + pred_1) + 0.3e0 * ln(1 + pred_2) + 0.2e0 * ln(1 + pred_3)) - 1, 0)), 8) AS log_of_logged FROM preds"""
    ),
)
def q_weighted_blend(spark, sf_dir):
    df, w = predictions_wide(spark, sf_dir), [0.5, 0.3, 0.2]
    return df.select(
        ID, F.round(B.weighted_blend(PREDS, w), 6).alias("plain"),
        F.round(F.log1p(B.weighted_blend(PREDS, w, log=True)), 8).alias("log_of_logged"),
    )


@query(
    "ratio_blend",
    with_preds("SELECT building_id, round(0.25e0 * ln(pred_1) + 0.75e0 * ln(pred_2) + 0e0 * ln(pred_3), 8) AS log_total_price FROM preds"),
)
def q_ratio_blend(spark, sf_dir):
    return predictions_wide(spark, sf_dir).select(ID, F.round(F.log(B.ratio_blend(PREDS, [0.25, 0.75, 0.0])), 8).alias("log_total_price"))


@query(
    "simplex_grid_blend",
    with_preds(
        f"""SELECT w1, w2, w3, round({hit_sql('total_price', 'b')}, 6) AS score FROM (
        SELECT a / 5e0 AS w1, c / 5e0 AS w2, (5 - a - c) / 5e0 AS w3, total_price,
               1.003e0 * (a / 5e0 * pred_1 + c / 5e0 * pred_2 + (5 - a - c) / 5e0 * pred_3) AS b
        FROM preds, (SELECT unnest(range(0, 6)) AS a), (SELECT unnest(range(0, 6)) AS c) WHERE a + c <= 5) GROUP BY w1, w2, w3"""
    ),
)
def q_simplex_grid_blend(spark, sf_dir):
    df = predictions_wide(spark, sf_dir).withColumns({p: F.col(p) * F.lit(1.003) for p in PREDS})
    return rounded(W.simplex_grid_blend(df, PRICE, PREDS).drop("weight_id"), 6)


#: Stand-ins for eight models: an error that repeats with these numbers.
GRID_MODULI = (3, 5, 7, 11, 13, 17, 19, 23)
_EIGHT_SQL = ", ".join(f"total_price * (1e0 + ((building_id % {m}) - {m // 2}) / 1e2) AS q{i + 1}" for i, m in enumerate(GRID_MODULI))
_UNITS = " + ".join(f"g{i}" for i in range(1, 8))


@query(
    "simplex_grid_blend_eight",
    with_txn(
        f"""SELECT {", ".join(f"u{i} / 5e0 AS w{i}" for i in range(1, 9))}, round(avg(abs(({
            " + ".join(f"u{i} / 5e0 * q{i}" for i in range(1, 9))}) - total_price) / total_price), 6) AS mape
        FROM q, u GROUP BY {", ".join(f"u{i}" for i in range(1, 9))}""",
        f"q AS (SELECT total_price, {_EIGHT_SQL} FROM txn)",
        f"""u AS (SELECT {", ".join(f"g{i} AS u{i}" for i in range(1, 8))}, 5 - ({_UNITS}) AS u8
        FROM {", ".join(f"(SELECT unnest(range(0, 6)) AS g{i})" for i in range(1, 8))} WHERE {_UNITS} <= 5)""",
    ),
)
def q_simplex_grid_blend_eight(spark, sf_dir):
    """All 792 vectors of eight models in steps of a fifth, in one plan."""
    df = transactions(spark, sf_dir, [ID, PRICE])
    names = [f"q{i + 1}" for i in range(len(GRID_MODULI))]
    error = lambda m: F.col(PRICE) * (F.lit(1.0) + (F.col(ID) % m - F.lit(m // 2)) / F.lit(100.0))
    df = df.withColumns({c: error(m) for c, m in zip(names, GRID_MODULI)})
    return rounded(W.simplex_grid_blend(df, PRICE, names, metric="mape").drop("weight_id"), 6)


@query(
    "simplex_grid_best",
    with_preds(
        """SELECT w1, w2, w3, round(avg(abs(b - total_price) / total_price), 6) AS mape FROM (
        SELECT a / 20e0 AS w1, c / 20e0 AS w2, (20 - a - c) / 20e0 AS w3, total_price,
               a / 20e0 * pred_1 + c / 20e0 * pred_2 + (20 - a - c) / 20e0 * pred_3 AS b
        FROM preds, (SELECT unnest(range(0, 21)) AS a), (SELECT unnest(range(0, 21)) AS c) WHERE a + c <= 20)
        GROUP BY w1, w2, w3 ORDER BY avg(abs(b - total_price) / total_price) LIMIT 5"""
    ),
)
def q_simplex_grid_best(spark, sf_dir):
    """The best five of the 231 vectors in steps of a twentieth."""
    best = W.simplex_grid_blend(predictions_wide(spark, sf_dir), PRICE, PREDS, steps=20, metric="mape", best=5)
    return rounded(best.drop("weight_id"), 6)


def _mean_sql(models: list[int]) -> str:
    terms = " + ".join(f"ln(1 + 1.003e0 * pred_{m})" for m in models)
    return hit_sql("total_price", f"(exp(({terms}) / {len(models)}) - 1)")


def _subsets_cte() -> str:
    pairs = [[1, 2, 3], [2, 3], [1, 3], [1, 2], [3], [2], [1]]
    rows = [f"SELECT '{','.join(f'pred_{m}' for m in s)}' AS models, {len(s)} AS size, {_mean_sql(s)} AS score FROM preds" for s in pairs]
    return "s AS (" + " UNION ALL ".join(rows) + ")"


@query(
    "backward_subset_mean",
    with_preds(
        """SELECT CAST(3 - size AS INTEGER) AS step, models, round(score, 6) AS score FROM s
        WHERE size >= 2 OR (SELECT models FROM s WHERE size = 2 ORDER BY score DESC LIMIT 1) LIKE '%' || models || '%'""",
        _subsets_cte(),
    ),
)
def q_backward_subset_mean(spark, sf_dir):
    df = stored(predictions_wide(spark, sf_dir).withColumns({p: F.col(p) * F.lit(1.003) for p in PREDS}))
    return rounded(B.backward_subset_mean(df, PRICE, PREDS), 6)


def _blend_frame(spark, sf_dir):
    """Predictions, area and fold, written once for the many passes of a search."""
    df = predictions_wide(spark, sf_dir, [AREA]).withColumn("fold", fold_of())
    return stored(df.select(ID, PRICE, AREA, "fold", *PREDS))


@query("random_refine_blend")
def q_random_refine_blend(spark, sf_dir):
    return W.random_refine_blend(_blend_frame(spark, sf_dir), PRICE, PREDS)


@query("optimize_weights")
def q_optimize_weights(spark, sf_dir):
    df = _blend_frame(spark, sf_dir)
    search = W.optimize_weights(df, PRICE, PREDS, area=AREA, loss="smooth", max_iter=MOST_STEPS)
    return df.select(ID, PRICE, search.prediction().alias("y_pred"))


@query("fold_weight_ensemble")
def q_fold_weight_ensemble(spark, sf_dir):
    df = _blend_frame(spark, sf_dir)
    _, _, _, blend = W.fold_weight_ensemble(df, PRICE, PREDS, folds=range(5), loss="mape", max_iter=MOST_STEPS)
    return df.select(ID, PRICE, blend.alias("y_pred"))
