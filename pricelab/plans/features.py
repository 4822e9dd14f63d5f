"""Column expressions on the transactions view, and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.functions.calendar import bucket_trunc, calendar_features, day_diff
from pricelab.functions.errors import (
    asymmetric_sq_error, banded_sq_error, error_columns, score_fraction, score_mape, smooth_hit,
)
from pricelab.functions.keys import add_intercept, category_to_int, compose_place_keys
from pricelab.functions.rows import row_dot, row_mean, row_vote
from pricelab.functions.targets import (
    area_ratio, building_age_years, height_ratio, target_column, target_inverse, target_transform, threshold_flag,
    top_floor,
)
from pricelab.encoders.numeric import SkewLog
from pricelab.operators import metrics as M
from pricelab.operators.filters import (
    error_within, fill_constants, finite_only, keep_scored_features, null_rare_categories, null_slice, segment_filter,
    value_slice,
)
from pricelab.operators.joins import lookup_join
from pricelab.operators.ranks import rank_level, stratified_folds
from pricelab.operators.tables import rename_drop, select_features
from pricelab.plans.fixtures import (
    fold_of, fold_sql, hit_sql, predictions_long, predictions_wide, rounded, transactions, with_preds, with_txn,
)
from pricelab.plans.registry import query
from pricelab.session import materialize, stored
from pricelab.sources.results import importance_table

ID, PRICE, AREA = "building_id", "total_price", "building_area"


@query(
    "target_transform",
    with_txn(
        """SELECT building_id, round(ln(1 + total_price), 8) AS log_total_price,
        total_price / nullif(building_area, 0) AS per_area_total_price,
        round(ln(1 + total_price / nullif(building_area, 0)), 8) AS log_per_area_total_price FROM txn"""
    ),
)
def q_target_transform(spark, sf_dir):
    df = target_transform(transactions(spark, sf_dir, [AREA]))
    names = [target_column(log, per_area) for log, per_area in ((True, False), (False, True), (True, True))]
    return rounded(df.select(ID, *names), 8, [n for n in names if n.startswith("log")])


@query(
    "target_inverse",
    with_txn(
        """SELECT building_id, round(greatest(exp(lp) - 1, 0) * building_area, 2) AS log_per_area,
        round(greatest(exp(lt) - 1, 0), 2) AS log_total, round((lp - 9) * building_area, 4) AS per_area, round(lp - 9, 6) AS plain
        FROM (SELECT *, ln(1 + total_price / nullif(building_area, 0)) AS lp, ln(1 + total_price) - 12.5e0 AS lt FROM txn)"""
    ),
)
def q_target_inverse(spark, sf_dir):
    df = target_transform(transactions(spark, sf_dir, [AREA])).withColumns(
        {"lp": F.col("log_per_area_total_price"), "lt": F.col("log_total_price") - 12.5}
    )
    return df.select(
        ID,
        F.round(target_inverse("lp", AREA), 2).alias("log_per_area"),
        F.round(target_inverse("lt", log=True, per_area=False), 2).alias("log_total"),
        F.round(target_inverse(F.col("lp") - 9, AREA, log=False, per_area=True), 4).alias("per_area"),
        F.round(target_inverse(F.col("lp") - 9, log=False, per_area=False), 6).alias("plain"),
    )


@query(
    "area_ratio",
    with_txn(
        """SELECT building_id, round(building_area / nullif(land_area, 0), 6) AS building_per_land_area,
        round(land_area / nullif(building_area, 0), 6) AS land_per_building_area FROM txn"""
    ),
)
def q_area_ratio(spark, sf_dir):
    df = transactions(spark, sf_dir, [AREA, "land_area"])
    return df.select(
        ID,
        F.round(area_ratio(AREA, "land_area"), 6).alias("building_per_land_area"),
        F.round(area_ratio("land_area", AREA), 6).alias("land_per_building_area"),
    )


@query(
    "height_ratio",
    with_txn(
        """SELECT building_id, round(CAST(txn_floor AS DOUBLE) / nullif(total_floor, 0), 6) AS height_r,
        coalesce(txn_floor = total_floor, false) AS top_floor FROM txn"""
    ),
)
def q_height_ratio(spark, sf_dir):
    df = transactions(spark, sf_dir, ["txn_floor", "total_floor"])
    return df.select(
        ID,
        F.round(height_ratio("txn_floor", "total_floor"), 6).alias("height_r"),
        top_floor("txn_floor", "total_floor").alias("top_floor"),
    )


_PMOD = "((({d}) % {k}) + {k}) % {k}"


def _calendar_sql(d: str) -> str:
    year = _PMOD.format(d=d, k=365)
    return f"""CAST({_PMOD.format(d=d, k=7)} AS INTEGER) AS dow_{d}, CAST({year} AS INTEGER) AS day_in_year_{d},
    CAST(floor(({year}) / 30.4167e0) AS INTEGER) AS month_{d}, CAST(floor(({year}) / 91.25e0) AS INTEGER) AS quarter_{d},
    CAST(floor(({d}) / 365.25e0) AS INTEGER) AS year_{d}"""


@query(
    "calendar_features",
    with_txn(
        f"""SELECT building_id, {_calendar_sql('txn_dt')}, {_calendar_sql('gap')}
        FROM (SELECT building_id, txn_dt, txn_dt - building_complete_dt AS gap FROM txn)"""
    ),
)
def q_calendar_features(spark, sf_dir):
    df = transactions(spark, sf_dir, ["txn_dt", "building_complete_dt"])
    df = df.select(ID, "txn_dt", (F.col("txn_dt") - F.col("building_complete_dt")).alias("gap"))
    return calendar_features(calendar_features(df, "txn_dt"), "gap").drop("txn_dt", "gap")


@query(
    "day_diff",
    with_txn("SELECT building_id, txn_dt - building_complete_dt AS dt_diff FROM txn"),
)
def q_day_diff(spark, sf_dir):
    df = transactions(spark, sf_dir, ["txn_dt", "building_complete_dt"])
    return df.select(ID, day_diff("txn_dt", "building_complete_dt").alias("dt_diff"))


@query(
    "building_age_years",
    with_txn("SELECT building_id, CAST(floor((txn_dt - building_complete_dt) / 365.25e0) AS BIGINT) AS building_age FROM txn"),
)
def q_building_age_years(spark, sf_dir):
    df = transactions(spark, sf_dir, ["txn_dt", "building_complete_dt"])
    return df.select(ID, building_age_years(day_diff("txn_dt", "building_complete_dt")).alias("building_age"))


@query(
    "bucket_trunc",
    with_txn(
        """SELECT building_id, CAST(trunc(gap / 7e0) AS INTEGER) AS weeks, CAST(trunc(gap / 30e0) AS INTEGER) AS months
        FROM (SELECT building_id, txn_dt - building_complete_dt AS gap FROM txn)"""
    ),
)
def q_bucket_trunc(spark, sf_dir):
    gap = day_diff("txn_dt", "building_complete_dt")
    df = transactions(spark, sf_dir, ["txn_dt", "building_complete_dt"])
    return df.select(ID, bucket_trunc(gap, 7).alias("weeks"), bucket_trunc(gap, 30).alias("months"))


@query(
    "compose_key",
    with_txn(
        """SELECT building_id, coalesce(city, 'nan') || '-' || coalesce(town, 'nan') AS town,
        coalesce(city, 'nan') || '-' || coalesce(town, 'nan') || '-' || coalesce(village, 'nan') AS village
        FROM (SELECT building_id, city, town, CASE WHEN building_id % 11 = 0 THEN NULL ELSE village END AS village FROM txn)"""
    ),
)
def q_compose_key(spark, sf_dir):
    df = transactions(spark, sf_dir, ["city", "town", "village"])
    df = df.withColumn("village", F.when(F.col(ID) % 11 != 0, F.col("village")))
    return compose_place_keys(df).select(ID, "town", "village")


@query(
    "shift_log10",
    with_txn(
        """SELECT building_id, round(log10(0.1e0 + gap - least((SELECT min(txn_dt - building_complete_dt) FROM txn WHERE NOT is_test), 0)), 6)
        AS gap FROM (SELECT building_id, greatest(txn_dt - building_complete_dt, (SELECT min(txn_dt - building_complete_dt)
        FROM txn WHERE NOT is_test)) AS gap FROM txn)"""
    ),
)
def q_shift_log10(spark, sf_dir):
    df = transactions(spark, sf_dir, ["txn_dt", "building_complete_dt", "is_test"])
    df = df.select(ID, "is_test", day_diff("txn_dt", "building_complete_dt").alias("gap"))
    train = df.where(~F.col("is_test"))
    # The shift is learned on train; test gaps below its minimum are raised to it.
    low = train.agg(F.min("gap")).first()[0]
    return rounded(SkewLog().fit(train, ["gap"], skewed=["gap"]).transform(df.withColumn("gap", F.greatest("gap", F.lit(low)))).drop("is_test"))


@query(
    "fill_constants",
    with_txn(
        """SELECT building_id, coalesce(parking_price, -1e0) AS parking_price, coalesce(land_area, 0e0) AS land_area FROM txn"""
    ),
)
def q_fill_constants(spark, sf_dir):
    df = transactions(spark, sf_dir, ["parking_price", "land_area"])
    return fill_constants(df, {"parking_price": -1.0, "land_area": 0.0}).select(ID, "parking_price", "land_area")


@query(
    "error_columns",
    with_preds(
        """SELECT building_id, round((pred_1 - total_price) / total_price, 6) AS pe, round(abs((pred_1 - total_price) / total_price), 6) AS ape,
        round(ln(1 + pred_1) - ln(1 + total_price), 6) AS log_error,
        abs((pred_1 - total_price) / total_price) < 0.155e0 AS small_error,
        abs(ln(1 + pred_1) - ln(1 + total_price)) < 0.1e0 AS small_log_error FROM preds"""
    ),
)
def q_error_columns(spark, sf_dir):
    df = error_columns(predictions_wide(spark, sf_dir), PRICE, "pred_1", small=0.155, small_log=0.1)
    return rounded(df.select(ID, "pe", "ape", "log_error", "small_error", "small_log_error"))


@query(
    "smooth_hit",
    with_preds(
        """SELECT building_id, round(1 / (1 + exp(-50 * (x - 0.1e0))) + 0.1e0 * x, 6) AS smooth
        FROM (SELECT building_id, abs(pred_1 - total_price) / total_price AS x FROM preds)"""
    ),
)
def q_smooth_hit(spark, sf_dir):
    df = predictions_wide(spark, sf_dir)
    x = F.abs(F.col("pred_1") - F.col(PRICE)) / F.col(PRICE)
    return df.select(ID, F.round(smooth_hit(x), 6).alias("smooth"))


_LOG_RESIDUAL = "(SELECT building_id, ln(1 + pred_1) - ln(1 + total_price) AS r FROM preds)"


@query(
    "banded_sq_error",
    with_preds(
        f"""SELECT count(*) AS n, round(avg(CASE WHEN r <= -0.1e0 THEN r * r - 0.9e0 * 0.01e0 WHEN r >= 0.095e0
        THEN r * r - 0.9e0 * 0.095e0 * 0.095e0 ELSE r * r * 0.1e0 END), 8) AS loss FROM {_LOG_RESIDUAL}"""
    ),
)
def q_banded_sq_error(spark, sf_dir):
    df = predictions_wide(spark, sf_dir)
    r = F.log1p("pred_1") - F.log1p(PRICE)
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(banded_sq_error(r, -0.1, 0.095)), 8).alias("loss"))


@query(
    "asymmetric_sq_error",
    with_preds(f"SELECT count(*) AS n, round(avg(CASE WHEN -r < 0 THEN 10 * r * r ELSE r * r END), 8) AS loss FROM {_LOG_RESIDUAL}"),
)
def q_asymmetric_sq_error(spark, sf_dir):
    df = predictions_wide(spark, sf_dir)
    r = F.log1p(PRICE) - F.log1p("pred_1")
    return df.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(asymmetric_sq_error(r)), 8).alias("loss"))


@query(
    "threshold_flag",
    with_txn("SELECT building_id, CAST(ln(1 + total_price / building_area) > 7.5e0 AS INTEGER) AS expensive FROM txn"),
)
def q_threshold_flag(spark, sf_dir):
    df = target_transform(transactions(spark, sf_dir, [AREA]))
    return df.select(ID, threshold_flag("log_per_area_total_price", 7.5).alias("expensive"))


@query(
    "row_mean",
    with_txn(
        """SELECT building_id, round((coalesce(land_area, 0) + coalesce(parking_price, 0) + building_area)
        / (1 + CAST(land_area IS NOT NULL AS INTEGER) + CAST(parking_price IS NOT NULL AS INTEGER)), 6) AS mean FROM txn"""
    ),
)
def q_row_mean(spark, sf_dir):
    df = transactions(spark, sf_dir, ["land_area", "parking_price", AREA])
    return df.select(ID, F.round(row_mean(["land_area", "parking_price", AREA]), 6).alias("mean"))


@query("row_dot", with_preds("SELECT building_id, round(0.5e0 * pred_1 + 0.3e0 * pred_2 + 0.2e0 * pred_3, 6) AS dot FROM preds"))
def q_row_dot(spark, sf_dir):
    df = predictions_wide(spark, sf_dir)
    return df.select(ID, F.round(row_dot(["pred_1", "pred_2", "pred_3"], [0.5, 0.3, 0.2]), 6).alias("dot"))


@query(
    "row_vote",
    """WITH v AS (SELECT o_orderkey AS building_id, unnest([o_orderkey % 2, o_orderkey % 3, o_orderkey % 5]) AS v FROM orders),
    n AS (SELECT building_id, v, count(*) AS n FROM v GROUP BY ALL)
    SELECT building_id, v AS vote FROM n QUALIFY row_number() OVER (PARTITION BY building_id ORDER BY n DESC, v) = 1""",
)
def q_row_vote(spark, sf_dir):
    df = transactions(spark, sf_dir, [ID])
    return df.select(ID, row_vote([F.col(ID) % 2, F.col(ID) % 3, F.col(ID) % 5]).alias("vote"))


@query(
    "score_fraction",
    with_preds(
        f"""SELECT model_id, round(s % 1, 6) AS fraction, round(1 - s % 1, 6) AS mape
        FROM (SELECT model_id, {hit_sql()} AS s FROM plong GROUP BY model_id)"""
    ),
)
def q_score_fraction(spark, sf_dir):
    scores = M.score_by_group(predictions_long(spark, sf_dir), ["model_id"], "y_true", "y_pred", ["score"])
    return rounded(scores.select("model_id", score_fraction("score").alias("fraction"), score_mape("score").alias("mape")))


@query(
    "select_features",
    with_txn("SELECT building_id, building_area, land_area, town, txn_floor FROM txn"),
)
def q_select_features(spark, sf_dir):
    cols = select_features([ID, AREA, "land_area", "lat", "town"], add=["txn_floor", "town"], remove=["lat", "none"])
    return transactions(spark, sf_dir, cols).select(*cols)


@query("rename_drop", with_preds("SELECT building_id, pred_1 AS total_price_predict FROM preds"))
def q_rename_drop(spark, sf_dir):
    df = predictions_wide(spark, sf_dir)
    return rename_drop(df, {"pred_1": "total_price_predict"}, [PRICE, "pred_2", "pred_3"])


@query("add_intercept", "SELECT o_orderkey AS building_id, 1e0 AS constant_1 FROM orders")
def q_add_intercept(spark, sf_dir):
    return add_intercept(transactions(spark, sf_dir, [ID])).select(ID, "constant_1")


@query("category_to_int", "SELECT o_orderkey AS building_id, CAST(o_orderkey % 5 = 4 AS INTEGER) AS is_test FROM orders")
def q_category_to_int(spark, sf_dir):
    return category_to_int(transactions(spark, sf_dir, ["is_test"]), "is_test").select(ID, "is_test")


@query(
    "finite_only",
    with_txn(
        "SELECT building_id, round(ln(txn_dt - building_complete_dt), 6) AS log_gap FROM txn WHERE txn_dt - building_complete_dt > 0"
    ),
)
def q_finite_only(spark, sf_dir):
    gap = day_diff("txn_dt", "building_complete_dt").cast("double")
    log_gap = F.when(gap < 0, F.lit(float("nan"))).when(gap == 0, F.lit(float("-inf"))).otherwise(F.log(gap))
    df = transactions(spark, sf_dir, ["txn_dt", "building_complete_dt"]).withColumn("log_gap", log_gap)
    return finite_only(df, "log_gap").select(ID, F.round("log_gap", 6).alias("log_gap"))


@query(
    "null_slice",
    with_txn(
        """SELECT 'unknown' AS part, count(*) AS n, round(avg(total_price), 4) AS mean_price FROM txn WHERE parking_price IS NULL
        UNION ALL SELECT 'known', count(*), round(avg(total_price), 4) FROM txn WHERE parking_price IS NOT NULL"""
    ),
)
def q_null_slice(spark, sf_dir):
    df = transactions(spark, sf_dir, ["parking_price"])
    stats = [F.count(F.lit(1)).alias("n"), F.round(F.avg(PRICE), 4).alias("mean_price")]
    return (
        null_slice(df, "parking_price").agg(F.lit("unknown").alias("part"), *stats)
        .unionByName(null_slice(df, "parking_price", known=True).agg(F.lit("known").alias("part"), *stats))
    )


@query("value_slice", with_txn("SELECT building_id, building_area FROM txn WHERE village = 'BUILDING'"))
def q_value_slice(spark, sf_dir):
    return value_slice(transactions(spark, sf_dir, [AREA, "village"]), "village", "BUILDING").select(ID, AREA)


@query(
    "segment_filter",
    with_txn("SELECT building_id, total_price FROM txn WHERE CAST(ln(1 + total_price / building_area) > 7.5e0 AS INTEGER) = 1"),
)
def q_segment_filter(spark, sf_dir):
    df = target_transform(transactions(spark, sf_dir, [AREA]))
    df = df.withColumn("price_group_pred", threshold_flag("log_per_area_total_price", 7.5))
    return segment_filter(df, 1).select(ID, PRICE)


_RARE_SQL = """cells AS (SELECT building_id, is_test, txn_dt // 3 AS cell FROM txn),
counts AS (SELECT cell, count(*) AS n FROM cells WHERE NOT is_test GROUP BY cell),
rare AS (SELECT cell FROM counts WHERE n <= 14 AND cell NOT IN (SELECT cell FROM cells WHERE is_test))"""


@query(
    "null_rare_categories",
    with_txn(
        """SELECT building_id, CASE WHEN cell IN (SELECT cell FROM rare) THEN NULL ELSE cell END AS cell
        FROM cells WHERE NOT is_test""",
        _RARE_SQL,
    ),
)
def q_null_rare_categories(spark, sf_dir):
    df = transactions(spark, sf_dir, ["txn_dt", "is_test"]).withColumn("cell", F.floor(F.col("txn_dt") / 3).cast("int"))
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    return null_rare_categories(train, "cell", 14, test).select(ID, "cell")


@query(
    "error_within",
    with_preds(
        """SELECT t AS error_limit, count(*) FILTER (abs((pred_1 - total_price) / total_price) < t) AS n,
        round(count(*) FILTER (abs((pred_1 - total_price) / total_price) < t) / count(*), 8) AS share
        FROM preds, (SELECT unnest([0.055e0, 0.105e0, 0.3e0]) AS t) GROUP BY t"""
    ),
)
def q_error_within(spark, sf_dir):
    df = error_columns(predictions_wide(spark, sf_dir), PRICE, "pred_1")
    return rounded(error_within(df, "pe", [0.055, 0.105, 0.3]), 8)


@query(
    "keep_scored_features",
    with_preds(
        """SELECT p.model_id, sum(CAST(p.mae > b.mae AS INTEGER)) > 0 AND NOT (avg(p.mae) >= avg(b.mae) - 2000) AS one_fold_better,
        avg(p.mae) >= avg(b.mae) - 2000 AS at_base
        FROM s p JOIN s b ON p.fold = b.fold AND b.model_id = 3 WHERE p.model_id <> 3 GROUP BY p.model_id
        HAVING sum(CAST(p.mae > b.mae AS INTEGER)) > 0 OR avg(p.mae) >= avg(b.mae) - 2000""",
        f"s AS (SELECT model_id, {fold_sql()} AS fold, avg(abs(y_pred - y_true)) AS mae FROM plong GROUP BY ALL)",
    ),
)
def q_keep_scored_features(spark, sf_dir):
    scores = (
        predictions_long(spark, sf_dir)
        .groupBy("model_id", fold_of().alias("fold"))
        .agg(F.avg(F.abs(F.col("y_pred") - F.col("y_true"))).alias("mae"))
        .withColumn("feat", F.when(F.col("model_id") == 3, F.lit("none")).otherwise(F.col("model_id").cast("string")))
    )
    kept = keep_scored_features(materialize(importance_table(scores, "feat", "fold", "mae")), slack=2000.0)
    return kept.select(F.col("feat").cast("int").alias("model_id"), "one_fold_better", "at_base")


def flagship(spark, sf_dir):
    """Transactions to features, stratified folds, out-of-fold group mean, score per fold."""
    # Folds need id and price only, so the wide rows are never sorted.
    sales = transactions(spark, sf_dir, [ID, "is_test"]).where(~F.col("is_test")).select(ID, PRICE)
    folds = stratified_folds(rank_level(sales, PRICE, ID, 5), "level", ID, 5).select(ID, "fold")
    cols = [AREA, "land_area", "txn_dt", "building_complete_dt", "town", "is_test"]
    base = transactions(spark, sf_dir, cols).where(~F.col("is_test")).join(folds, ID)
    df = calendar_features(target_transform(base), "txn_dt").withColumns(
        {
            "dt_diff": day_diff("txn_dt", "building_complete_dt").cast("bigint"),
            "building_per_land_area": area_ratio(AREA, "land_area"),
        }
    )
    target, by = "log_per_area_total_price", ["town", "quarter_txn_dt"]
    table = stored(df.select("fold", PRICE, AREA, *by, target, "dt_diff", "building_per_land_area"))
    # Leave-fold-out sums: overall less own fold, both pre-aggregated per (town, quarter).
    cells = table.groupBy(*by, "fold").agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    totals = cells.groupBy(*by).agg(F.sum("s").alias("ts"), F.sum("n").alias("tn"))
    state = cells.join(totals, by).select(
        *by, "fold", F.try_divide(F.col("ts") - F.col("s"), F.col("tn") - F.col("n")).alias("pred")
    )
    scored = lookup_join(table, materialize(state), {c: c for c in [*by, "fold"]}).withColumn("y_pred", target_inverse("pred", AREA))
    return rounded(
        scored.groupBy("fold").agg(
            M.hit_score(PRICE, "y_pred").alias("score"),
            M.mape(PRICE, "y_pred").alias("mape"),
            F.count(F.lit(1)).alias("n"),
            F.sum("dt_diff").alias("dt_diff"),
            F.avg("building_per_land_area").alias("ratio"),
        )
    )


FLAGSHIP_SQL = with_txn(
    f"""SELECT fold, round({hit_sql('total_price', 'y_pred')}, 6) AS score,
    round(avg(abs(y_pred - total_price) / total_price), 6) AS mape, count(*) AS n,
    CAST(sum(txn_dt - building_complete_dt) AS BIGINT) AS dt_diff,
    round(avg(building_area / nullif(land_area, 0)), 6) AS ratio
    FROM (SELECT f.*, greatest(exp(pred) - 1, 0) * building_area AS y_pred FROM f JOIN st
          ON f.town = st.town AND f.q = st.q AND f.fold = st.fold) GROUP BY fold""",
    """lv AS (SELECT *, ln(1 + total_price / building_area) AS t,
    CAST(floor((((txn_dt % 365) + 365) % 365) / 91.25e0) AS INTEGER) AS q,
    (row_number() OVER (ORDER BY total_price, building_id) - 1) // (count(*) OVER () // 5) AS level FROM txn WHERE NOT is_test)""",
    """f AS (SELECT *, CAST((row_number() OVER (PARTITION BY level ORDER BY md5('42:' || building_id), building_id) - 1) % 5
    AS INTEGER) AS fold FROM lv)""",
    "c AS (SELECT town, q, fold, sum(t) AS s, count(t) AS n FROM f GROUP BY ALL)",
    """st AS (SELECT town, q, fold, (sum(s) OVER (PARTITION BY town, q) - s) / nullif(sum(n) OVER (PARTITION BY town, q) - n, 0)
    AS pred FROM c)""",
)

query("flagship", FLAGSHIP_SQL)(flagship)
