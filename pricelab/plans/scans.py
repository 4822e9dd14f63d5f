"""Sources, sinks and prediction tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.encoders.geometry import GeoCluster
from pricelab.operators.tables import preview, sample_rows
from pricelab.plans.fixtures import (
    fold_of, fold_sql, predictions_long, rounded, table, transactions, with_preds, with_txn,
)
from pricelab.plans.registry import query
from pricelab.session import scratch_path
from pricelab.sources.predictions import (
    choose_artifact, expand_id_ranges, read_predictions, write_predictions, write_submission,
)
from pricelab.sources.results import importance_table, load_ratio_table, load_state, read_results, save_state, write_results
from pricelab.sources.scan import read_folds, scan_typed, write_folds


@query(
    "scan_typed",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS o_totalprice,
       CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate,
       TRY_CAST(o_orderpriority AS FLOAT) IS NULL AS bad_number FROM orders""",
)
def q_scan_typed(spark, sf_dir):
    cols = ["o_orderkey", "o_totalprice", "o_custkey", "o_orderdate", "o_orderpriority"]
    df = scan_typed(
        spark, f"{sf_dir}/orders.parquet", cols,
        num=["o_totalprice", "o_orderpriority"], cat=["o_custkey"], date=["o_orderdate"], fmt="parquet",
    )
    return df.select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_custkey", "o_orderdate",
        F.col("o_orderpriority").isNull().alias("bad_number"),
    )


@query("read_folds", f"SELECT o_orderkey AS building_id, {fold_sql(key='o_orderkey')} AS fold FROM orders")
def q_read_folds(spark, sf_dir):
    folds = transactions(spark, sf_dir, ["building_id"]).select("building_id", fold_of().alias("fold"))
    path = scratch_path(spark, "folds")
    write_folds(folds, path)
    return read_folds(spark, path, key_type="bigint")


def _written_predictions(spark, sf_dir) -> str:
    """The long prediction table with all three kinds of artifacts."""
    preds = predictions_long(spark, sf_dir)
    test = F.col("building_id") % 5 == 4
    kinds = F.when(test, F.array(F.lit("test-kfold"), F.lit("test-one"))).otherwise(F.array(F.lit("cv")))
    shift = F.when(F.col("kind") == "test-one", F.lit(1.01)).otherwise(F.lit(1.0))
    table_ = preds.withColumn("kind", F.explode(kinds)).withColumn("y_pred", F.col("y_pred") * shift)
    path = scratch_path(spark, "predictions")
    write_predictions(table_, path)
    return path


@query(
    "read_predictions",
    with_preds(
        """SELECT model_id, count(*) AS n, round(sum(y_pred), 2) AS total FROM plong
        WHERE building_id % 5 <> 4 AND model_id IN (1, 3) GROUP BY model_id"""
    ),
)
def q_read_predictions(spark, sf_dir):
    preds = read_predictions(spark, _written_predictions(spark, sf_dir), [1, 3], "cv")
    return preds.groupBy("model_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("y_pred"), 2).alias("total"))


@query(
    "choose_artifact",
    with_preds(
        """SELECT building_id, model_id, CASE WHEN model_id = 2 THEN 'test-kfold' ELSE 'test-one' END AS kind,
        round(CASE WHEN model_id = 2 THEN y_pred * 1e0 ELSE y_pred * 1.01e0 END, 6) AS y_pred
        FROM plong WHERE building_id % 5 = 4"""
    ),
)
def q_choose_artifact(spark, sf_dir):
    path = _written_predictions(spark, sf_dir)
    both = read_predictions(spark, path, [1, 2, 3], "test-kfold").unionByName(
        read_predictions(spark, path, [1, 2, 3], "test-one")
    )
    return choose_artifact(both, [2]).select("building_id", "model_id", "kind", F.round("y_pred", 6).alias("y_pred"))


@query(
    "expand_id_ranges",
    """WITH r AS (SELECT c_nationkey, min(c_custkey) AS lo, max(c_custkey) AS hi FROM customer GROUP BY c_nationkey)
    SELECT c_nationkey, unnest(range(lo, lo + 6)) AS id FROM r
    UNION ALL SELECT c_nationkey, hi AS id FROM r""",
)
def q_expand_id_ranges(spark, sf_dir):
    per_nation = (
        table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg(F.min("c_custkey").alias("lo"), F.max("c_custkey").alias("hi"))
    )
    text = F.concat(F.col("lo"), F.lit("-"), F.col("lo") + 5, F.lit(","), F.col("hi"))
    return expand_id_ranges(per_nation.select("c_nationkey", text.alias("ids")), "ids").select("c_nationkey", "id")


@query("write_predictions", with_preds("SELECT building_id, round(pred_1, 4) AS total_price FROM preds WHERE building_id % 5 <> 4"))
def q_write_predictions(spark, sf_dir):
    path = _written_predictions(spark, sf_dir)
    cv = read_predictions(spark, path, [1], "cv").select("building_id", F.col("y_pred").alias("total_price"))
    out = scratch_path(spark, "submission")
    write_submission(cv, out)
    return rounded(spark.read.schema("building_id bigint, total_price double").option("header", True).csv(out), 4)


@query(
    "read_results",
    with_preds(
        f"""SELECT CAST(model_id AS VARCHAR) AS model_id, CAST({fold_sql()} AS INTEGER) AS fold, round(avg(abs(y_pred - y_true)), 4) AS mae,
        TRUE AS in_history FROM plong GROUP BY 1, 2"""
    ),
)
def q_read_results(spark, sf_dir):
    """The nested results as they come back, one row per model and fold."""
    back = q_write_results(spark, sf_dir)
    rows = back.select(F.col("params")["model_id"].alias("model_id"), F.posexplode("fold_scores").alias("fold", "mae"), "histories")
    in_history = F.get(F.get("histories", F.lit(0))["mae"], F.col("fold")) == F.col("mae")
    return rounded(rows.select("model_id", "fold", "mae", in_history.alias("in_history")), 4, ["mae"])


@query("write_results")
def q_write_results(spark, sf_dir):
    scores = (
        predictions_long(spark, sf_dir)
        .withColumn("fold", fold_of())
        .groupBy("model_id", "fold")
        .agg(F.avg(F.abs(F.col("y_pred") - F.col("y_true"))).alias("mae"))
    )
    nested = scores.groupBy("model_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("fold", "mae"))), lambda s: s["mae"]).alias("fold_scores")
    ).select(
        F.create_map(F.lit("model_id"), F.col("model_id").cast("string")).alias("params"),
        "fold_scores",
        F.array(F.create_map(F.lit("mae"), F.col("fold_scores"))).alias("histories"),
    )
    path = scratch_path(spark, "results")
    write_results(nested, path)
    return read_results(
        spark, path, "params map<string,string>, fold_scores array<double>, histories array<map<string,array<double>>>"
    )


@query("save_state")
def q_save_state(spark, sf_dir):
    txn = transactions(spark, sf_dir, ["lat", "lon", "town"])
    path = scratch_path(spark, "clusterer")
    GeoCluster(k=3, seeds=(1,), max_iter=10).fit(txn).save(path)
    clusters = GeoCluster.load(path).transform(txn).groupBy("encoded_latlon").agg(F.count(F.lit(1)).alias("n"))
    state_path = scratch_path(spark, "state")
    save_state(clusters, state_path)
    return load_state(spark, state_path)


@query(
    "preview",
    """(SELECT 'head' AS part, o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)
    UNION ALL (SELECT 'tail', o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 5)
    UNION ALL (SELECT 'sample', o_orderkey FROM orders ORDER BY md5('42:' || o_orderkey), o_orderkey LIMIT 10)""",
)
def q_preview(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    order = ["o_totalprice", "o_orderkey"]
    parts = [
        ("head", preview(o, order)), ("tail", preview(o, order, tail=True)), ("sample", sample_rows(o, 10, "o_orderkey")),
    ]
    out = None
    for name, df in parts:
        df = df.select(F.lit(name).alias("part"), "o_orderkey")
        out = df if out is None else out.unionByName(df)
    return out


@query(
    "importance_table",
    with_preds(
        f"""SELECT model_id AS feat, round(avg(mae), 4) AS avg, round(max(CASE WHEN fold = 0 THEN mae END), 4) AS fold_0,
        round(max(CASE WHEN fold = 4 THEN mae END), 4) AS fold_4 FROM (
          SELECT model_id, {fold_sql()} AS fold, avg(abs(y_pred - y_true)) AS mae FROM plong GROUP BY ALL)
        GROUP BY model_id"""
    ),
)
def q_importance_table(spark, sf_dir):
    scores = (
        predictions_long(spark, sf_dir)
        .groupBy("model_id", fold_of().alias("fold"))
        .agg(F.avg(F.abs(F.col("y_pred") - F.col("y_true"))).alias("mae"))
    )
    out = importance_table(scores, "model_id", "fold", "mae")
    return rounded(
        out.select("feat", "avg", F.col("folds")[0].alias("fold_0"), F.col("folds")[4].alias("fold_4")), 4
    )


_RATIO_SQL = """
seg AS (SELECT c_mktsegment AS segment, c_nationkey AS model, count(*) AS n, sum(c_acctbal) AS bal FROM customer GROUP BY ALL),
tot AS (SELECT segment, sum(n) AS n FROM seg GROUP BY segment),
r AS (SELECT seg.segment, model, CASE WHEN model % 4 = 0 THEN NULL ELSE seg.n / tot.n END AS in_group,
      CASE WHEN model % 5 = 0 THEN NULL ELSE tot.n / (SELECT sum(n) FROM seg) END AS share
      FROM seg JOIN tot ON seg.segment = tot.segment)"""


@query(
    "load_ratio_table",
    f"""WITH {_RATIO_SQL} SELECT segment, model, round(coalesce(in_group, 0e0), 8) AS in_group,
    round(coalesce(share, 0e0), 8) AS share, round(coalesce(in_group, 0e0) * coalesce(share, 0e0), 8) AS all_ratio FROM r""",
)
def q_load_ratio_table(spark, sf_dir):
    seg = (
        table(spark, sf_dir, "customer")
        .groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("model"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = seg.agg(F.sum("n").alias("n")).scalar()
    per_segment = seg.groupBy("segment").agg(F.sum("n").alias("t"))
    ratios = seg.join(per_segment, "segment").select(
        "segment", "model",
        F.when(F.col("model") % 4 != 0, F.col("n") / F.col("t")).alias("in_group"),
        F.when(F.col("model") % 5 != 0, F.col("t") / total).alias("share"),
    )
    return rounded(load_ratio_table(ratios, "in_group", "share"), 8)
