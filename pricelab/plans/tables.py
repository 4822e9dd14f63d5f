"""Set operations, distinct rows and feature lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.operators import tables as T
from pricelab.plans.fixtures import table, transactions, with_txn
from pricelab.plans.registry import query

ID, PRICE = "building_id", "total_price"


@query(
    "last_per_key",
    with_txn("SELECT town, txn_dt, building_id, total_price FROM txn QUALIFY row_number() OVER (PARTITION BY town ORDER BY txn_dt DESC, building_id DESC) = 1"),
)
def q_last_per_key(spark, sf_dir):
    df = transactions(spark, sf_dir, ["town", "txn_dt", ID, PRICE])
    return T.last_per_key(df, "town", ["txn_dt", ID])


@query("first_distinct", with_txn("SELECT DISTINCT town, village FROM txn"))
def q_first_distinct(spark, sf_dir):
    return T.first_distinct(transactions(spark, sf_dir, ["town", "village"]), "town", "village")


@query("unique_sorted", "SELECT DISTINCT o_totalprice AS total_price FROM orders WHERE o_totalprice IS NOT NULL")
def q_unique_sorted(spark, sf_dir):
    return T.unique_sorted(transactions(spark, sf_dir, [ID]), PRICE)


@query(
    "union_rows",
    """SELECT CAST(o_orderkey % 10 AS BIGINT) AS cell, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM
    (SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 3 = 0) GROUP BY 1""",
)
def q_union_rows(spark, sf_dir):
    df = transactions(spark, sf_dir, [ID])
    both = T.union_rows(df, df.where(f"{ID} % 3 = 0"))
    return both.groupBy((F.col(ID) % 10).alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(PRICE), 2).alias("total")
    )


@query(
    "category_diff",
    """SELECT o_custkey AS value, CASE WHEN count(*) FILTER (t) = 0 THEN 'train_only' WHEN count(*) FILTER (NOT t) = 0 THEN 'test_only' ELSE 'shared' END AS side,
    count(*) FILTER (NOT t) AS train, count(*) FILTER (t) AS test FROM (SELECT o_custkey, o_orderkey % 5 = 4 AS t FROM orders) GROUP BY o_custkey""",
)
def q_category_diff(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return T.category_diff(o.where("o_orderkey % 5 <> 4"), o.where("o_orderkey % 5 = 4"), "o_custkey")


@query(
    "drop_top_n_features",
    with_txn(
        """SELECT village FROM (SELECT village, avg(total_price) AS m FROM txn GROUP BY village)
        WHERE village <> 'MACHINERY' ORDER BY m DESC, village LIMIT 3"""
    ),
)
def q_drop_top_n_features(spark, sf_dir):
    df = transactions(spark, sf_dir, ["village"])
    diff = df.groupBy(F.col("village").alias("feat")).agg(F.avg(PRICE).alias("diff"))
    names = T.drop_top_n_features(diff, 3, base="MACHINERY")
    return diff.where(F.col("feat").isin(names)).select(F.col("feat").alias("village"))
