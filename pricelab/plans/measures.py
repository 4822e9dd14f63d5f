"""Metrics, prediction joins and weight grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.blend.weights import simplex_grid
from pricelab.operators import metrics as M
from pricelab.operators.joins import (
    align_check, attach_left, count_compare, fold_train, fold_val, join_predictions, lookup_encode, paste_columns,
    whitelist_join,
)
from pricelab.functions.targets import target_transform
from pricelab.operators.ranks import category_codes
from pricelab.operators.tables import best_per_setting, history_at, merge_results, top_results
from pricelab.operators.profile import best_iteration
from pricelab.plans.fixtures import (
    MODELS, fold_of, fold_sql, hit_sql, predictions_long, predictions_wide, rounded, table, transactions, with_preds,
    with_txn,
)
from pricelab.plans.registry import query
from pricelab.session import scratch_path
from pricelab.sources.results import format_search_log, read_search_log

ID, PRICE, AREA = "building_id", "total_price", "building_area"
FOLDS_CTE = f"folded AS (SELECT *, {fold_sql()} AS fold FROM plong)"


def _folded(spark, sf_dir, cols=()):
    return predictions_long(spark, sf_dir, cols).withColumn("fold", fold_of())


@query(
    "join_predictions",
    with_preds(
        "SELECT building_id, round(pred_1, 6) AS pred_1, round(pred_3, 6) AS pred_3 FROM preds WHERE building_id % 9 <> 2"
    ),
)
def q_join_predictions(spark, sf_dir):
    long = predictions_long(spark, sf_dir).where(~((F.col(ID) % 9 == 2) & (F.col("model_id") == 3)))
    return rounded(join_predictions(long, [1, 3]))


@query(
    "attach_left",
    with_txn("SELECT building_id, total_price, CAST(total_price / building_area < 9000 AS INTEGER) AS grp FROM txn"),
)
def q_attach_left(spark, sf_dir):
    groups = transactions(spark, sf_dir, [AREA]).select(ID, (F.col(PRICE) / F.col(AREA) < 9000).cast("int").alias("grp"))
    return attach_left(transactions(spark, sf_dir, [ID]), groups, ID, require=["grp"])


@query(
    "fold_split",
    f"""WITH f AS (SELECT o_orderkey, o_totalprice, {fold_sql(key='o_orderkey')} AS fold FROM orders)
    SELECT 'val' AS part, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM f WHERE fold = 2
    UNION ALL SELECT 'train', count(*), round(sum(o_totalprice), 2) FROM f WHERE fold <> 2""",
)
def q_fold_split(spark, sf_dir):
    df = transactions(spark, sf_dir, [ID])
    ids = df.select(ID, fold_of().alias("fold"))
    stats = [F.count(F.lit(1)).alias("n"), F.round(F.sum(PRICE), 2).alias("total")]
    val = fold_val(df, 2, ids).agg(F.lit("val").alias("part"), *stats)
    return val.unionByName(fold_train(df, 2, ids).agg(F.lit("train").alias("part"), *stats))


@query("whitelist_join", "SELECT o_orderkey AS building_id, o_totalprice AS total_price FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 48)")
def q_whitelist_join(spark, sf_dir):
    kept = table(spark, sf_dir, "lineitem").where("l_quantity > 48").select(F.col("l_orderkey").alias(ID))
    return whitelist_join(transactions(spark, sf_dir, [ID]), kept)


@query(
    "lookup_encode",
    """WITH codes AS (SELECT t, row_number() OVER (ORDER BY t) - 1 AS code FROM (SELECT DISTINCT p_type AS t FROM part WHERE p_partkey % 3 <> 0))
    SELECT p_partkey, coalesce(code, -1) AS code FROM part LEFT JOIN codes ON p_type = t""",
)
def q_lookup_encode(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    codes = category_codes(part.where("p_partkey % 3 <> 0"), ["p_type"])
    return lookup_encode(part, "p_type", codes, "code", "code", -1).select("p_partkey", F.col("code").cast("bigint").alias("code"))


@query(
    "count_compare",
    """WITH c AS (SELECT l_shipdate, l_orderkey % 5 = 4 AS t FROM lineitem)
    SELECT CAST(l_shipdate AS DATE) AS value, nullif(count(*) FILTER (NOT t), 0) AS train, nullif(count(*) FILTER (t), 0) AS test
    FROM c GROUP BY l_shipdate HAVING count(*) FILTER (NOT t) > 0""",
)
def q_count_compare(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"), "l_orderkey")
    return count_compare(li.where("l_orderkey % 5 <> 4"), li.where("l_orderkey % 5 = 4"), "day")


@query(
    "align_check",
    """SELECT CAST(count(*) FILTER (o_orderkey % 10 = 3) AS BIGINT) AS only_a, CAST(count(*) FILTER (o_orderkey % 10 = 7) AS BIGINT) AS only_b,
    false AS aligned FROM orders""",
)
def q_align_check(spark, sf_dir):
    o = transactions(spark, sf_dir, [ID])
    return align_check(o.where(f"{ID} % 10 <> 7"), o.where(f"{ID} % 10 <> 3"))


@query("paste_columns", with_txn("SELECT building_id, total_price, round(ln(1 + total_price / building_area), 6) AS lp FROM txn"))
def q_paste_columns(spark, sf_dir):
    derived = target_transform(transactions(spark, sf_dir, [AREA])).select(
        ID, PRICE, F.round("log_per_area_total_price", 6).alias("lp")
    )
    return paste_columns(transactions(spark, sf_dir, [ID]), derived)


@query(
    "score_weight_grid",
    with_preds(
        f"""SELECT CAST(i AS INTEGER) AS weight_id, w[1] AS w1, w[2] AS w2, w[3] AS w3, round({hit_sql('total_price', 'b')}, 6) AS score
        FROM (SELECT i, w, total_price, w[1] * pred_1 + w[2] * pred_2 + w[3] * pred_3 AS b FROM preds,
              (SELECT * FROM (VALUES (0, [0.5e0, 0.25e0, 0.25e0]), (1, [0.2e0, 0.2e0, 0.6e0]), (2, [1e0, 0e0, 0e0])) v(i, w)))
        GROUP BY i, w"""
    ),
)
def q_score_weight_grid(spark, sf_dir):
    df = predictions_wide(spark, sf_dir)
    weights = [(0.5, 0.25, 0.25), (0.2, 0.2, 0.6), (1.0, 0.0, 0.0)]
    return rounded(M.score_weight_grid(df, PRICE, [f"pred_{m}" for m in MODELS], weights), 6)


_GRID21 = "(SELECT CAST(row_number() OVER (ORDER BY a, c) - 1 AS INTEGER) AS i, a / 5e0 AS w1, c / 5e0 AS w2, (5 - a - c) / 5e0 AS w3 " \
    "FROM (SELECT unnest(range(0, 6)) AS a), (SELECT unnest(range(0, 6)) AS c) WHERE a + c <= 5)"
_BLENDS21 = f"b AS (SELECT i, w1, w2, w3, building_id, total_price AS y, w1 * pred_1 + w2 * pred_2 + w3 * pred_3 AS o FROM preds, {_GRID21})"


@query(
    "score_weight_grid_gini",
    with_preds(
        """SELECT i AS weight_id, w1, w2, w3, round(g / p, 6) AS gini FROM (
          SELECT i, w1, w2, w3, ((sum(y * (n - r + 1)) / sum(y)) - (any_value(n) + 1) / 2e0) / any_value(n) AS g FROM (
            SELECT *, row_number() OVER (PARTITION BY i ORDER BY o DESC, building_id) AS r, count(*) OVER (PARTITION BY i) AS n FROM b)
          GROUP BY i, w1, w2, w3),
        (SELECT ((sum(y * (n - r + 1)) / sum(y)) - (any_value(n) + 1) / 2e0) / any_value(n) AS p FROM (
            SELECT total_price AS y, row_number() OVER (ORDER BY total_price DESC, building_id) AS r, count(*) OVER () AS n FROM preds))""",
        _BLENDS21,
    ),
)
def q_score_weight_grid_gini(spark, sf_dir):
    """Normalised Gini of 21 vectors in one range layout."""
    df = predictions_wide(spark, sf_dir)
    return rounded(M.score_weight_grid(df, PRICE, [f"pred_{m}" for m in MODELS], simplex_grid(3), metric="gini"), 6)


@query(
    "score_weight_grid_auc",
    with_preds(
        """SELECT i AS weight_id, w1, w2, w3, round(sum(pos * (below + neg / 2e0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)), 6) AS auc FROM (
          SELECT *, sum(neg) OVER (PARTITION BY i ORDER BY o) - neg AS below FROM (
            SELECT i, w1, w2, w3, o, sum(l) AS pos, sum(1 - l) AS neg
            FROM (SELECT *, CASE WHEN y > 150000 THEN 1 ELSE 0 END AS l FROM b) GROUP BY i, w1, w2, w3, o))
        GROUP BY i, w1, w2, w3""",
        _BLENDS21,
    ),
)
def q_score_weight_grid_auc(spark, sf_dir):
    """AUC of 21 vectors against dear sales, in one range layout."""
    df = predictions_wide(spark, sf_dir).withColumn("dear", (F.col(PRICE) > 150000).cast("int"))
    return rounded(M.score_weight_grid(df, "dear", [f"pred_{m}" for m in MODELS], simplex_grid(3), metric="auc"), 6)


def _metric_query(name: str, expression: str, digits: int = 6):
    sql = with_preds(f"SELECT model_id, round({expression}, {digits}) AS {name} FROM plong GROUP BY model_id")

    @query(name, sql)
    def run(spark, sf_dir):
        out = M.score_by_group(predictions_long(spark, sf_dir), ["model_id"], "y_true", "y_pred", [METRIC_OF.get(name, name)])
        return rounded(out.withColumnRenamed(METRIC_OF.get(name, name), name), digits)


METRIC_OF = {"hit_score": "score", "smooth_score": "smooth"}
_metric_query("mape", "avg(abs(y_pred - y_true) / y_true)")
_metric_query("hit_score", hit_sql())
_metric_query(
    "smooth_score",
    "100 * avg(1 / (1 + exp(-50 * (abs(y_pred - y_true) / y_true - 0.1e0))) + 0.1e0 * (abs(y_pred - y_true) / y_true))",
)
_metric_query("mse", "avg((y_pred - y_true) * (y_pred - y_true))", 2)
_metric_query("mae", "avg(abs(y_pred - y_true))", 4)
_metric_query("msle", "avg(pow(ln(1 + y_pred) - ln(1 + y_true), 2))", 8)


# A binary label and a coarse probability with many ties.
BINARY_CTE = """bin AS (SELECT building_id, CAST(total_price / building_area > 9000 AS INTEGER) AS label,
((building_id * 7 + CAST(floor(total_price / 1000) AS BIGINT)) % 41 + 1) / 43e0 AS prob FROM txn)"""


def binary_frame(spark, sf_dir):
    df = transactions(spark, sf_dir, [AREA])
    mix = (F.col(ID) * 7 + F.floor(F.col(PRICE) / 1000)) % 41 + 1
    return df.select(ID, (F.col(PRICE) / F.col(AREA) > 9000).cast("int").alias("label"), (mix / F.lit(43.0)).alias("prob"))


@query(
    "accuracy",
    with_txn("SELECT round(avg(CASE WHEN label = CAST(prob >= 0.5e0 AS INTEGER) THEN 1e0 ELSE 0e0 END), 8) AS accuracy FROM bin", BINARY_CTE),
)
def q_accuracy(spark, sf_dir):
    df = binary_frame(spark, sf_dir)
    return df.agg(F.round(M.accuracy("label", (F.col("prob") >= 0.5).cast("int")), 8).alias("accuracy"))


@query(
    "auc",
    with_txn(
        """SELECT round((sum(label * r) - sum(label) * (sum(label) + 1) / 2e0) / (sum(label) * CAST(sum(1 - label) AS DOUBLE)), 8) AS auc
        FROM (SELECT label, rank() OVER (ORDER BY prob) + (count(*) OVER (PARTITION BY prob) - 1) / 2e0 AS r FROM bin)""",
        BINARY_CTE,
    ),
)
def q_auc(spark, sf_dir):
    return rounded(M.auc(binary_frame(spark, sf_dir), "label", "prob"), 8)


@query("log_loss", with_txn("SELECT round(avg(-(label * ln(prob) + (1 - label) * ln(1 - prob))), 8) AS log_loss FROM bin", BINARY_CTE))
def q_log_loss(spark, sf_dir):
    return binary_frame(spark, sf_dir).agg(F.round(M.log_loss("label", "prob"), 8).alias("log_loss"))


@query(
    "gini_normalized",
    with_preds(
        """SELECT round((sum(total_price * (n - rp + 1)) / sum(total_price) - (max(n) + 1) / 2e0)
        / (sum(total_price * (n - ry + 1)) / sum(total_price) - (max(n) + 1) / 2e0), 8) AS gini
        FROM (SELECT total_price, count(*) OVER () AS n, row_number() OVER (ORDER BY pred_1 DESC, building_id) AS rp,
              row_number() OVER (ORDER BY total_price DESC, building_id) AS ry FROM preds)"""
    ),
)
def q_gini(spark, sf_dir):
    return rounded(M.gini_normalized(predictions_wide(spark, sf_dir), PRICE, "pred_1", ID), 8)


@query(
    "hit_score_log",
    with_preds(f"SELECT round({hit_sql()}, 6) AS score FROM (SELECT exp(ln(1 + total_price)) - 1 AS y_true, exp(ln(1 + pred_1 * 1.003e0)) - 1 AS y_pred FROM preds)"),
)
def q_hit_score_log(spark, sf_dir):
    # Shifted so that no error sits exactly on the 10 % limit, where logs would decide it.
    pred = F.col("pred_1") * F.lit(1.003)
    return predictions_wide(spark, sf_dir).agg(F.round(M.hit_score_log(F.log1p(PRICE), F.log1p(pred)), 6).alias("score"))


@query(
    "score_by_group",
    with_preds(
        f"""SELECT model_id, fold, round({hit_sql()}, 6) AS score, round(avg(pow(y_pred - y_true, 2)), 2) AS mse,
        round(avg(abs(y_pred - y_true)), 4) AS mae, round(avg(abs(y_pred - y_true) / y_true), 6) AS mape
        FROM folded GROUP BY model_id, fold""",
        FOLDS_CTE,
    ),
)
def q_score_by_group(spark, sf_dir):
    out = M.score_by_group(_folded(spark, sf_dir), ["model_id", "fold"], "y_true", "y_pred")
    return rounded(rounded(rounded(out, 6, ["score", "mape"]), 2, ["mse"]), 4, ["mae"])


FOLD_SCORES_CTE = f"fs AS (SELECT model_id, fold, {hit_sql()} AS score, avg(abs(y_pred - y_true)) AS mae FROM folded GROUP BY ALL)"


def _fold_scores(spark, sf_dir):
    return M.score_by_group(_folded(spark, sf_dir), ["model_id", "fold"], "y_true", "y_pred", ["score", "mae", "mape"])


@query(
    "fold_summary",
    with_preds(
        """SELECT model_id, round(avg(score), 5) AS mean, round(stddev_pop(score), 5) AS std, count(*) AS n,
        round(max(CASE WHEN fold = 0 THEN score END), 5) AS first_fold, round(max(CASE WHEN fold = 4 THEN score END), 5) AS last_fold
        FROM fs GROUP BY model_id""",
        FOLDS_CTE, FOLD_SCORES_CTE,
    ),
)
def q_fold_summary(spark, sf_dir):
    out = M.fold_summary(_fold_scores(spark, sf_dir), ["model_id"])
    ends = {"first_fold": F.col("scores")[0], "last_fold": F.element_at("scores", -1)}
    return rounded(out.withColumns(ends).drop("scores"), 5)


@query(
    "pooled_error",
    with_preds(
        """SELECT round(sqrt(avg(v)), 5) AS pooled_std, round(sqrt(avg(v)) / sqrt(5e0), 5) AS standard_error
        FROM (SELECT var_pop(score) AS v FROM fs GROUP BY model_id)""",
        FOLDS_CTE, FOLD_SCORES_CTE,
    ),
)
def q_pooled_error(spark, sf_dir):
    return rounded(M.pooled_error(M.fold_summary(_fold_scores(spark, sf_dir), ["model_id"])), 5)


# Search results: one setting per (model, fold) pair, parameters derived from the keys.


@query(
    "top_results",
    with_preds("SELECT model_id, fold, round(score, 5) AS score FROM fs ORDER BY fs.score DESC, model_id, fold LIMIT 4", FOLDS_CTE, FOLD_SCORES_CTE),
)
def q_top_results(spark, sf_dir):
    top = top_results(_fold_scores(spark, sf_dir), 4, "score", ["model_id", "fold"])
    return rounded(top.select("model_id", "fold", "score"), 5)


def _search_lines(spark, sf_dir):
    """Saved search lines, one per model and day-of-week cell, written as text."""
    cells = (
        predictions_long(spark, sf_dir)
        .groupBy("model_id", (F.col(ID) % 50).alias("cell"))
        .agg(
            M.hit_score("y_true", "y_pred").alias("score"), M.mae("y_true", "y_pred").alias("mae"),
            M.mape("y_true", "y_pred").alias("mape"),
        )
    )
    line = format_search_log(
        {"model": F.col("model_id"), "cell": F.col("cell"), "objective": F.lit("mse")},
        [F.col("score"), F.col("mae"), F.col("mape")],
        [F.col("score"), F.col("score") + 1],
    )
    noise = cells.select(F.concat(F.lit("training cell "), F.col("cell").cast("string")).alias("value"))
    path = scratch_path(spark, "searchlog")
    cells.select(line.alias("value")).unionByName(noise).write.text(path)
    return read_search_log(spark, path, ["score", "mae", "mape"])


CELL_CTE = f"""cells AS (SELECT model_id, building_id % 50 AS cell, {hit_sql()} AS score, avg(abs(y_pred - y_true)) AS mae,
avg(abs(y_pred - y_true) / y_true) AS mape FROM plong GROUP BY ALL)"""


@query(
    "parse_search_log",
    with_preds(
        """SELECT CAST(model_id AS VARCHAR) AS model, CAST(cell AS VARCHAR) AS cell, 'mse' AS objective, round(score, 5) AS score,
        round(mae, 4) AS mae, round(mape, 6) AS mape, round(score + 1, 5) AS second_fold FROM cells""",
        CELL_CTE,
    ),
)
def q_parse_search_log(spark, sf_dir):
    parsed = _search_lines(spark, sf_dir)
    p = F.col("params")
    return parsed.select(
        p["model"].alias("model"), p["cell"].alias("cell"), p["objective"].alias("objective"),
        F.round("score", 5).alias("score"), F.round("mae", 4).alias("mae"), F.round("mape", 6).alias("mape"),
        F.round(F.col("fold_lists")[0][1], 5).alias("second_fold"),
    )


@query("best_per_setting", with_preds("SELECT CAST(cell AS VARCHAR) AS cell, round(max(score), 5) AS best FROM cells GROUP BY cell", CELL_CTE))
def q_best_per_setting(spark, sf_dir):
    return rounded(best_per_setting(_search_lines(spark, sf_dir), "cell"), 5)


# Histories: per model and fold a metric value for each of 12 epochs.
HISTORY_CTE = f"""hist AS (SELECT model_id, {fold_sql()} AS fold, building_id % 12 + 1 AS epoch, avg(abs(y_pred - y_true)) AS mae,
avg(y_pred) AS loss FROM plong GROUP BY ALL)"""


def _history(spark, sf_dir):
    return (
        predictions_long(spark, sf_dir)
        .groupBy("model_id", fold_of().alias("fold"), (F.col(ID) % 12 + 1).alias("epoch"))
        .agg(M.mae("y_true", "y_pred").alias("mae"), F.avg("y_pred").alias("loss"))
    )


@query(
    "best_iteration",
    with_preds(
        """SELECT model_id, fold, epoch AS best_iteration, round(mae, 4) AS best_metric FROM hist
        QUALIFY row_number() OVER (PARTITION BY model_id, fold ORDER BY mae, epoch) = 1""",
        HISTORY_CTE,
    ),
)
def q_best_iteration(spark, sf_dir):
    return rounded(best_iteration(_history(spark, sf_dir), ["model_id", "fold"], "epoch", "mae"), 4)


@query(
    "history_at",
    with_preds(
        """SELECT h.model_id, max(e) AS epoch, round(avg(mae), 4) AS mean_mae, round(stddev_pop(mae), 4) AS std_mae,
        round(avg(loss), 4) AS mean_loss, round(stddev_pop(loss), 4) AS std_loss FROM hist h
        JOIN (SELECT model_id, CAST(round_even(avg(epoch), 0) AS INTEGER) AS e FROM (
                SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY model_id, fold ORDER BY mae, epoch) = 1)
              GROUP BY model_id) b ON h.model_id = b.model_id AND h.epoch = b.e GROUP BY h.model_id""",
        HISTORY_CTE,
    ),
)
def q_history_at(spark, sf_dir):
    ordered = lambda m: F.transform(F.array_sort(F.collect_list(F.struct("epoch", m))), lambda s: s[m])
    # Twelve epochs per fold and five folds per model: arrays of fixed size.
    per_fold = _history(spark, sf_dir).groupBy("model_id", "fold").agg(
        F.create_map(F.lit("mae"), ordered("mae"), F.lit("loss"), ordered("loss")).alias("h")
    )
    best = F.array_position(F.col("h")["mae"], F.array_min(F.col("h")["mae"]))
    results = per_fold.groupBy("model_id").agg(F.collect_list("h").alias("histories"), F.avg(best).alias("mean_best"))
    out = history_at(results, "histories", ["mae", "loss"], "mean_best")
    return rounded(out.select("model_id", "epoch", "mean_mae", "std_mae", "mean_loss", "std_loss"), 4)


@query(
    "merge_results",
    with_preds(
        """SELECT model_id, fold, round(score, 5) AS score, 1 AS search_round FROM fs WHERE fold < 3
        UNION ALL SELECT model_id, fold, round(score, 5), 2 FROM fs WHERE fold >= 2""",
        FOLDS_CTE, FOLD_SCORES_CTE,
    ),
)
def q_merge_results(spark, sf_dir):
    scores = rounded(_fold_scores(spark, sf_dir).select("model_id", "fold", "score"), 5)
    first = scores.where("fold < 3").withColumn("search_round", F.lit(1))
    second = scores.where("fold >= 2").withColumn("search_round", F.lit(2))
    return merge_results(first, second, order=["score"])
