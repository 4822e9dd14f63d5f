"""Global ranks, levels, folds, trimming and nearest values."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.operators.joins import nearest_value_join
from pricelab.operators.metrics import hit_score
from pricelab.operators.quantiles import rank_split
from pricelab.operators.ranks import (
    category_codes, global_rank, rank_level, shuffle_column, stratified_folds, trim_tails, within_group_rank,
)
from pricelab.functions.keys import seeded_text
from pricelab.functions.targets import target_transform
from pricelab.plans.fixtures import (
    fold_of, fold_sql, hit_sql, predictions_wide, rounded, stored_transactions, table, transactions, with_preds, with_txn,
)
from pricelab.plans.registry import query

ID, PRICE, AREA = "building_id", "total_price", "building_area"


@query("global_rank", "SELECT o_orderkey AS building_id, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS rank FROM orders")
def q_global_rank(spark, sf_dir):
    return global_rank(transactions(spark, sf_dir, [ID]), [PRICE, ID]).select(ID, "rank")


@query(
    "rank_level",
    """WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS i, count(*) OVER () AS n FROM orders)
    SELECT o_orderkey AS building_id, CAST(i // (n // 7) AS INTEGER) AS level FROM r""",
)
def q_rank_level(spark, sf_dir):
    return rank_level(transactions(spark, sf_dir, [ID]), PRICE, ID, 7).select(ID, "level")


@query(
    "stratified_folds",
    """WITH r AS (SELECT o_orderkey, o_totalprice, (row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1) // (count(*) OVER () // 5) AS level FROM orders)
    SELECT o_orderkey AS building_id, CAST((row_number() OVER (PARTITION BY level ORDER BY md5('42:' || o_orderkey), o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM r""",
)
def q_stratified_folds(spark, sf_dir):
    levels = rank_level(transactions(spark, sf_dir, [ID]), PRICE, ID, 5)
    return stratified_folds(levels, "level", ID, 5).select(ID, "fold")


@query("random_folds", f"SELECT o_orderkey AS building_id, {fold_sql(3, 123, 'o_orderkey')} AS fold FROM orders")
def q_random_folds(spark, sf_dir):
    return transactions(spark, sf_dir, [ID]).select(ID, fold_of(3, 123).alias("fold"))


@query(
    "trim_tails",
    with_preds(
        """SELECT building_id FROM (SELECT building_id, row_number() OVER (ORDER BY round(ln(1 + pred_1) - ln(1 + total_price), 9), building_id) - 1 AS r,
        CAST(floor(count(*) OVER () * 0.03e0 / 2) AS BIGINT) AS h, count(*) OVER () AS n FROM preds) WHERE r >= h AND r < n - h"""
    ),
)
def q_trim_tails(spark, sf_dir):
    df = predictions_wide(spark, sf_dir).withColumn("log_error", F.round(F.log1p("pred_1") - F.log1p(PRICE), 9))
    return trim_tails(df, "log_error", ID, 3).select(ID)


@query(
    "rank_split",
    with_txn(
        """SELECT building_id, CASE WHEN v < a THEN 0 WHEN v < b THEN 1 ELSE 2 END AS grp FROM t,
        (SELECT max(CASE WHEN r = n // 3 THEN v END) AS a, max(CASE WHEN r = n // 3 * 2 THEN v END) AS b
         FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS r, count(*) OVER () AS n FROM t))""",
        "t AS (SELECT building_id, total_price / building_area AS v FROM txn)",
    ),
)
def q_rank_split(spark, sf_dir):
    df = target_transform(stored_transactions(spark, sf_dir, [AREA]))
    n = table(spark, sf_dir, "orders").count()
    return rank_split(df, "per_area_total_price", [n // 3, n // 3 * 2]).select(ID, "grp")


@query(
    "category_codes",
    """SELECT 'p_brand' AS col, p_brand AS value, dense_rank() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part)
    UNION ALL SELECT 'p_type', p_type, dense_rank() OVER (ORDER BY p_type) - 1 FROM (SELECT DISTINCT p_type FROM part)""",
)
def q_category_codes(spark, sf_dir):
    return category_codes(table(spark, sf_dir, "part"), ["p_brand", "p_type"])


@query(
    "bayes_rank",
    """WITH g AS (SELECT o_custkey, (sum(o_totalprice) + c * m) / (count(*) + c) AS mean FROM orders,
      (SELECT avg(o_totalprice) AS m, count(*) / count(DISTINCT o_custkey) AS c FROM orders) GROUP BY o_custkey, c, m)
    SELECT o_custkey, row_number() OVER (ORDER BY round(mean, 6), o_custkey) - 1 AS rank FROM g""",
)
def q_bayes_rank(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice")
    overall = o.agg(F.avg("o_totalprice").alias("m"), (F.count(F.lit(1)) / F.count_distinct("o_custkey")).alias("c")).first()
    c, m = F.lit(overall["c"]), F.lit(overall["m"])
    means = o.groupBy("o_custkey").agg(((F.sum("o_totalprice") + c * m) / (F.count(F.lit(1)) + c)).alias("mean"))
    return global_rank(means, [F.round("mean", 6), "o_custkey"]).select("o_custkey", "rank")


@query(
    "shuffled_codes",
    """SELECT i, value, row_number() OVER (PARTITION BY i ORDER BY md5('42:' || i || ':' || value), value) - 1 AS code
    FROM (SELECT DISTINCT p_type AS value FROM part), (SELECT unnest(range(0, 4))::INTEGER AS i)""",
)
def q_shuffled_codes(spark, sf_dir):
    values = table(spark, sf_dir, "part").select(F.col("p_type").alias("value")).distinct()
    drawn = values.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return within_group_rank(drawn, ["i"], [seeded_text(42, "i", "value"), "value"], "code").select("i", "value", "code")


@query(
    "shuffle_column",
    """SELECT a.k AS building_id, b.v AS total_price FROM
    (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS r FROM orders) a JOIN
    (SELECT o_totalprice AS v, row_number() OVER (ORDER BY md5('7:' || o_orderkey), o_orderkey) AS r FROM orders) b ON a.r = b.r""",
)
def q_shuffle_column(spark, sf_dir):
    return shuffle_column(transactions(spark, sf_dir, [ID]), ID, PRICE, seed=7)


_NEAREST_SQL = """seen AS (SELECT DISTINCT total_price AS v FROM txn WHERE NOT is_test),
lo AS (SELECT building_id, total_price, pred_1, is_test, v AS lo FROM preds ASOF LEFT JOIN seen ON pred_1 >= v),
hi AS (SELECT building_id, v AS hi FROM preds ASOF LEFT JOIN seen ON pred_1 <= v),
snapped AS (SELECT lo.building_id, total_price, pred_1, is_test,
  CASE WHEN lo IS NULL THEN hi WHEN hi IS NULL THEN lo WHEN hi - pred_1 < pred_1 - lo THEN hi ELSE lo END AS nearest
  FROM lo JOIN hi ON lo.building_id = hi.building_id)"""


def _snapped(spark, sf_dir):
    preds = predictions_wide(spark, sf_dir, ["is_test"]).select(ID, PRICE, "pred_1", "is_test")
    seen = transactions(spark, sf_dir, ["is_test"]).where(~F.col("is_test"))
    return nearest_value_join(preds, "pred_1", seen, PRICE, ID)


@query("nearest_value_join", with_preds("SELECT building_id, nearest FROM snapped", _NEAREST_SQL))
def q_nearest_value_join(spark, sf_dir):
    return _snapped(spark, sf_dir).select(ID, "nearest")


@query(
    "snap_to_observed",
    with_preds(
        f"SELECT round({hit_sql('total_price', 'pred_1')}, 6) AS before, round({hit_sql('total_price', 'nearest')}, 6) AS after FROM snapped",
        _NEAREST_SQL,
    ),
)
def q_snap_to_observed(spark, sf_dir):
    df = _snapped(spark, sf_dir)
    return df.agg(F.round(hit_score(PRICE, "pred_1"), 6).alias("before"), F.round(hit_score(PRICE, "nearest"), 6).alias("after"))
