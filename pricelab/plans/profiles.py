"""Column profiles on the transactions view."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.functions.errors import error_columns
from pricelab.functions.targets import target_transform
from pricelab.operators import profile as P
from pricelab.plans.fixtures import (
    fold_of, fold_sql, predictions_long, predictions_wide, rounded, stored_transactions, transactions, with_preds, with_txn,
)
from pricelab.plans.registry import query
from pricelab.session import materialize
from pricelab.sources.results import importance_table

ID, PRICE, AREA = "building_id", "total_price", "building_area"
NUMERIC = ["total_price", "building_area", "land_area", "parking_price"]


def _union_sql(rows: list[str]) -> str:
    return "\nUNION ALL ".join(rows)


@query("value_counts", with_txn("SELECT town AS value, count(*) AS n FROM txn GROUP BY town"))
def q_value_counts(spark, sf_dir):
    return P.value_counts(transactions(spark, sf_dir, ["town"]), "town")


_COUNTED = ["town", "village", "building_type", "txn_dt", "land_area"]


@query(
    "distinct_counts",
    with_txn(
        _union_sql(
            f"""SELECT '{c}' AS "column", count(DISTINCT {c}) FILTER (NOT is_test) AS train, count(DISTINCT {c}) FILTER (is_test) AS test FROM txn"""
            for c in _COUNTED
        )
    ),
)
def q_distinct_counts(spark, sf_dir):
    df = stored_transactions(spark, sf_dir, [*_COUNTED, "is_test"])
    return P.distinct_counts(df.where(~F.col("is_test")), df.where("is_test"), _COUNTED)


_NULLABLE = ["land_area", "parking_price", "building_material", "txn_floor", "town"]


@query(
    "null_profile",
    with_txn(
        _union_sql(
            f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null, round(avg(CASE WHEN {c} IS NULL THEN 1e0 ELSE 0e0 END), 8) AS share FROM txn"""
            for c in _NULLABLE
        )
    ),
)
def q_null_profile(spark, sf_dir):
    return rounded(P.null_profile(transactions(spark, sf_dir, _NULLABLE), _NULLABLE), 8)


_KINDS = [("total_price", "float"), ("txn_dt", "int"), ("town", "categorical"), ("is_test", "categorical"), ("one", "int"), ("land_area", "float")]


@query(
    "column_kind",
    with_txn(
        _union_sql(
            f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n_null, count(DISTINCT {c}) AS n_distinct,
            CASE WHEN count(DISTINCT {c}) = 1 AND count({c}) = count(*) THEN 'constant'
                 WHEN count(DISTINCT {c}) = 2 AND count({c}) = count(*) THEN 'binary' ELSE '{base}' END AS kind FROM t"""
            for c, base in _KINDS
        ),
        "t AS (SELECT *, 1 AS one FROM txn)",
    ),
)
def q_column_kind(spark, sf_dir):
    df = stored_transactions(spark, sf_dir, [c for c, _ in _KINDS if c != "one"]).withColumn("one", F.lit(1))
    return P.column_kind(df, [c for c, _ in _KINDS])


def _moments_sql(c: str, *more: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
    round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, {", ".join(more)} FROM txn"""


@query("summary_stats", with_txn(_union_sql([_moments_sql(c, f"round(median({c}), 4) AS median") for c in NUMERIC])))
def q_summary_stats(spark, sf_dir):
    return rounded(P.summary_stats(stored_transactions(spark, sf_dir, NUMERIC), NUMERIC), 4)


@query(
    "describe",
    with_txn(
        _union_sql(
            [_moments_sql(c, *[f"round(quantile_cont({c}, {q / 100}), 4) AS q{q}" for q in (25, 50, 75)]) for c in NUMERIC]
        )
    ),
)
def q_describe(spark, sf_dir):
    return rounded(P.describe(stored_transactions(spark, sf_dir, NUMERIC), NUMERIC), 4)


@query(
    "skewness_table",
    with_txn(
        _union_sql(
            f"""SELECT '{c}' AS "column", round(skewness({c}), 6) AS skew,
            round(skewness({c}) * (count({c}) - 2) / sqrt(CAST(count({c}) AS DOUBLE) * (count({c}) - 1)), 6) AS skew_pop,
            skewness({c}) > 0.5e0 AS right_skewed FROM txn"""
            for c in NUMERIC
        )
    ),
)
def q_skewness_table(spark, sf_dir):
    return rounded(P.skewness_table(transactions(spark, sf_dir, NUMERIC), NUMERIC, limit=0.5), 6)


_CORR_COLS = ["building_area", "land_area", "txn_dt", "lat", "parking_price"]


@query(
    "corr_with_target",
    with_txn(
        'SELECT "column", round(c, 8) AS corr, round(abs(c), 8) AS abs_corr, CAST(row_number() OVER (ORDER BY abs(c) DESC) AS INTEGER) AS cum_count FROM ('
        + _union_sql([f"""SELECT '{c}' AS "column", corr({c}, ln(1 + total_price)) AS c FROM txn""" for c in _CORR_COLS])
        + ")"
    ),
)
def q_corr_with_target(spark, sf_dir):
    df = target_transform(transactions(spark, sf_dir, [*_CORR_COLS, AREA]))
    return rounded(P.corr_with_target(df, _CORR_COLS, "log_total_price"), 8)


@query(
    "corr_matrix",
    with_txn(
        _union_sql(
            f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 8) AS corr FROM txn"
            for i, a in enumerate(_CORR_COLS)
            for b in _CORR_COLS[i + 1 :]
        )
    ),
)
def q_corr_matrix(spark, sf_dir):
    return rounded(P.corr_matrix(transactions(spark, sf_dir, _CORR_COLS), _CORR_COLS), 8)


def _iv_sql(c: str) -> str:
    return f"""SELECT '{c}' AS feature, round(sum(woe * diff), 8) AS iv FROM (
    SELECT ln(((n0 + 0.5e0) / f) / ((n1 + 0.5e0) / t)) AS woe, n0 / f - n1 / t AS diff FROM
    (SELECT {c}, count(*) FILTER (event) AS n1, count(*) FILTER (NOT event) AS n0 FROM ev WHERE {c} IS NOT NULL GROUP BY {c}),
    (SELECT count(*) FILTER (event) AS t, count(*) FILTER (NOT event) AS f FROM ev))"""


@query(
    "woe_iv",
    with_txn(
        _union_sql([_iv_sql(c) for c in ("town", "village", "building_material")]),
        "ev AS (SELECT *, total_price / building_area > (SELECT median(total_price / building_area) FROM txn) AS event FROM txn)",
    ),
)
def q_woe_iv(spark, sf_dir):
    df = target_transform(stored_transactions(spark, sf_dir, [AREA, "town", "village", "building_material"]))
    flagged = P.above_median(df, "per_area_total_price")
    return rounded(P.woe_iv(flagged, ["town", "village", "building_material"], "event"), 8)


@query(
    "group_stats",
    with_txn(
        """SELECT town, count(*) AS n_txn, min(building_area) AS min_area, max(building_area) AS max_area, round(avg(building_area), 6) AS mean_area,
        round(avg(lp), 6) AS mean_target, round(min(lp), 6) AS min_target, round(max(lp), 6) AS max_target,
        round(count(*) / avg(building_area), 6) AS txn_per_mean_area, round(log10(count(*)), 6) AS log_n_txn,
        round(log10(count(*) / avg(building_area)), 6) AS log_txn_per_mean_area
        FROM (SELECT *, ln(1 + total_price / building_area) AS lp FROM txn) GROUP BY town"""
    ),
)
def q_group_stats(spark, sf_dir):
    df = target_transform(transactions(spark, sf_dir, [AREA, "town"]))
    return rounded(P.group_stats(df, "town", AREA, "log_per_area_total_price"), 6)


@query(
    "histogram",
    with_txn(
        """SELECT grp, bin, round(lo + bin * w, 4) AS left_edge, n, round(n / (sum(n) OVER (PARTITION BY grp) * w), 10) AS density FROM (
          SELECT CAST(is_test AS INTEGER) AS grp, CAST(least(floor((total_price - lo) / w), 19) AS INTEGER) AS bin, any_value(lo) AS lo, any_value(w) AS w, count(*) AS n
          FROM txn, (SELECT min(total_price) AS lo, (max(total_price) - min(total_price)) / 20 AS w FROM txn) GROUP BY 1, 2)"""
    ),
)
def q_histogram(spark, sf_dir):
    df = transactions(spark, sf_dir, ["is_test"]).withColumn("grp", F.col("is_test").cast("int"))
    out = P.histogram(df, PRICE, 20, by="grp")
    return rounded(rounded(out, 4, ["left_edge"]), 10, ["density"])


@query(
    "residual_sign_share",
    with_preds(
        """SELECT count(*) AS n, round(avg(CASE WHEN pe > 0 THEN 1e0 ELSE 0e0 END), 8) AS positive_pe,
        round(avg(CASE WHEN le > 0 THEN 1e0 ELSE 0e0 END), 8) AS positive_log_error
        FROM (SELECT (pred_1 - total_price) / total_price AS pe, ln(1 + pred_1) - ln(1 + total_price) AS le FROM preds) WHERE NOT abs(le) < 0.1e0"""
    ),
)
def q_residual_sign_share(spark, sf_dir):
    df = error_columns(predictions_wide(spark, sf_dir), PRICE, "pred_1", small_log=0.1)
    return rounded(P.residual_sign_share(df, "small_log_error", ["pe", "log_error"]), 8)


@query(
    "importance_diff",
    with_preds(
        """SELECT model_id, round(mae, 4) AS avg, round(mae - (SELECT mae FROM m WHERE model_id = 1), 4) AS diff FROM m""",
        f"m AS (SELECT model_id, avg(mae) AS mae FROM (SELECT model_id, {fold_sql()} AS fold, avg(abs(y_pred - y_true)) AS mae FROM plong GROUP BY ALL) GROUP BY model_id)",
    ),
)
def q_importance_diff(spark, sf_dir):
    scores = (
        predictions_long(spark, sf_dir)
        .groupBy("model_id", fold_of().alias("fold"))
        .agg(F.avg(F.abs(F.col("y_pred") - F.col("y_true"))).alias("mae"))
    )
    diff = P.importance_diff(materialize(importance_table(scores, "model_id", "fold", "mae")), base=1)
    return rounded(diff.withColumnRenamed("feat", "model_id"), 4)
