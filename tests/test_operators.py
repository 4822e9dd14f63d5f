import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.operators import filters as FI
from pricelab.operators import joins as J
from pricelab.operators import metrics as M
from pricelab.operators import profile as P
from pricelab.operators import tables as T
from pricelab.sources import predictions as SP
from pricelab.sources import results as SR
from pricelab.sources import scan as SC
from pricelab.session import shared_dir


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_scan_typed_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("id,x,k,d\n1,2.5,7,2020-01-02\n2,bad,,nope\n3,NaN,9,2020-01-03\n")
    df = SC.scan_typed(spark, str(path), ["id", "x", "k", "d"], num=["x"], cat=["k"], date=["d"])
    assert dict(df.dtypes) == {"id": "string", "x": "float", "k": "int", "d": "date"}
    assert [(r["id"], r["x"], r["k"], r["d"] is None) for r in df.orderBy("id").collect()] == [
        ("1", 2.5, 7, False), ("2", None, None, True), ("3", None, 9, False),
    ]


def test_read_folds_of_single_files(spark, tmp_path):
    for i in range(2):
        (tmp_path / f"id_cv{i}.csv").write_text("building_id\n" + "".join(f"b{i}{j}\n" for j in range(3)))
    got = rows(SC.read_folds(spark, str(tmp_path / "id_cv*.csv")))
    assert got == [(f"b{i}{j}", i) for i in range(2) for j in range(3)]


def test_prediction_table_prunes_by_model_and_kind(spark, tmp_path):
    path = str(tmp_path / "preds")
    df = spark.createDataFrame([(1, 10.0, 11.0)], "building_id bigint, y_true double, y_pred double")
    for model, kind in ((1, "cv"), (2, "cv"), (2, "test-one"), (2, "test-kfold")):
        SP.write_predictions(df, path, model, kind)
    got = SP.read_predictions(spark, path, [2], "cv")
    assert got.count() == 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [model_id" in plan or "PartitionFilters: [isnotnull(model_id" in plan or "model_id" in plan.split("PartitionFilters")[1][:200]
    with pytest.raises(ValueError):
        SP.write_predictions(df, path, 1, "other")


def test_search_log_lines(spark):
    text = [
        "[[(('max_depth', 16), ('objective', 'mse'), ('lr', 0.01)), 5751.5, 0.043, [5750.5, 5752.5], [0.04, 0.05]]",
        "(('max_depth', -1), ('lr', 0.1)) 5700.25 0.05 [1 2 3]",
        "training fold 1",
    ]
    got = SR.parse_search_log(spark.createDataFrame([(t,) for t in text], "value string"), means=["score", "mse"]).collect()
    assert [r["params"] for r in got] == [{"max_depth": "16", "objective": "mse", "lr": "0.01"}, {"max_depth": "-1", "lr": "0.1"}]
    assert [(r["score"], r["mse"]) for r in got] == [(5751.5, 0.043), (5700.25, 0.05)]
    assert got[0]["fold_lists"] == [[5750.5, 5752.5], [0.04, 0.05]]
    assert got[1]["fold_lists"] == [[1.0, 2.0, 3.0]]


def test_join_predictions_drops_incomplete_ids(spark):
    long = spark.createDataFrame([(1, 1, 5.0), (1, 2, 6.0), (2, 1, 7.0)], "building_id int, model_id int, y_pred double")
    assert rows(J.join_predictions(long, [1, 2])) == [(1, 5.0, 6.0)]


def test_attach_left_reports_gaps(spark):
    a, b = spark.range(3), spark.createDataFrame([(0, 1), (1, 2)], "id bigint, g int")
    assert J.attach_left(a, b, "id").count() == 3
    with pytest.raises(ValueError):
        J.attach_left(a, b, "id", require=["g"])
    assert rows(J.missing_after_join(a, b, "id")) == [(2,)]


def test_folds_split_and_align(spark):
    df = spark.range(10).select(F.col("id").alias("building_id"), (F.col("id") % 3).cast("int").alias("fold"))
    ids = df.select("building_id", "fold")
    plain = df.select("building_id")
    assert J.fold_val(plain, 1, ids).count() + J.fold_train(plain, 1, ids).count() == 10
    assert rows(J.fold_val(df, 1)) == [(1, 1), (4, 1), (7, 1)]
    assert J.align_check(df, df).first()["aligned"]
    assert tuple(J.align_check(df, df.union(df.limit(1))).first()) == (0, 1, False)


def test_count_compare_modes(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    b = spark.createDataFrame([("x",), ("z",)], "c string")
    assert rows(J.count_compare(a, b, "c")) == [("x", 2, 1), ("y", 1, None)]
    assert rows(J.count_compare(a, b, "c", "full")) == [("x", 2, 1), ("y", 1, None), ("z", None, 1)]
    assert rows(T.category_diff(a, b, "c")) == [("x", "shared", 2, 1), ("y", "train_only", 1, 0), ("z", "test_only", 0, 1)]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (4.0,), (4.0,), (9.0,)], "v double")
    assert [(r["bin"], r["n"]) for r in P.histogram(df, "v", 2, lo=0.0, hi=4.0).orderBy("bin").collect()] == [(0, 2), (1, 2)]
    assert sum(r["density"] * 2 for r in P.histogram(df, "v", 2, lo=0.0, hi=4.0).collect()) == pytest.approx(1.0)


def test_kinds_and_nulls(spark):
    df = spark.createDataFrame([(1, 0, "a", 1.5), (1, 1, "b", None), (1, 1, None, 2.0)], "k int, b int, s string, f double")
    assert {r["column"]: r["kind"] for r in P.column_kind(df).collect()} == {"k": "constant", "b": "binary", "s": "categorical", "f": "float"}
    assert P.null_columns(df) == ["s", "f"]
    approx = {r["column"]: (r["train"], r["test"]) for r in P.distinct_counts(df, df.limit(1), ["b", "s"], approx=True).collect()}
    assert approx["b"] == (2, 1)


def test_woe_by_hand(spark):
    df = spark.createDataFrame([("a", True), ("a", True), ("a", False), ("b", False)], "c string, e boolean")
    got = {r["value"]: r["woe"] for r in P.woe(df, ["c"], "e").collect()}
    assert got["a"] == pytest.approx(math.log((1.5 / 2) / (2.5 / 2)))
    assert got["b"] == pytest.approx(math.log((1.5 / 2) / (0.5 / 2)))


def test_wide_profiles_are_chunked(spark, monkeypatch):
    monkeypatch.setattr(P, "EXPRESSIONS_PER_PASS", 4)
    df = spark.range(50).select(*[(F.col("id") * (i + 1)).cast("double").alias(f"c{i}") for i in range(7)])
    assert P.null_profile(df).count() == 7
    assert P.corr_matrix(df, df.columns).count() == 21


def test_scored_features(spark):
    data = [("none", 10.0, [9.0, 11.0]), ("up", 10.5, [10.0, 11.0]), ("mixed", 9.0, [10.0, 8.0]), ("down", 8.0, [8.0, 8.0])]
    table = SR.importance_rows(spark, data)
    got = {r["feat"]: (r["at_base"], r["one_fold_better"]) for r in FI.keep_scored_features(table).collect()}
    assert got == {"up": (True, False), "mixed": (False, True)}
    diff = P.importance_diff(table)
    assert [r["feat"] for r in diff.collect()] == ["up", "none", "mixed", "down"]
    assert T.drop_top_n_features(diff, 2) == ["up", "mixed"]
    assert T.drop_top_n_features(diff, 2, keep_base_slot=True) == ["up", "mixed"]


def test_feature_lists_keep_order():
    assert T.select_features(["b", "a", "c"], add=["d", "a"], remove=["a"]) == ["b", "c", "d"]


def test_columns_by_pattern(spark):
    df = spark.createDataFrame([(1, 2, 3)], "XIV_500 int, XIV_MIN int, I_500 int")
    assert T.columns_matching(df, r"^XIV_\d+$") == ["XIV_500"]


def test_history_at_epoch(spark):
    df = spark.createDataFrame(
        [([{"loss": [3.0, 1.0, 2.0]}, {"loss": [4.0, 3.0, 0.0]}], 2.4)], "h array<map<string,array<double>>>, e double"
    )
    r = T.history_at(df, "h", ["loss"], "e").first()
    assert (r["epoch"], r["mean_loss"], r["std_loss"]) == (2, 2.0, 1.0)


def test_last_per_key_takes_the_latest(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 6), ("b", 2, 7)], "k string, dt int, v int")
    assert rows(T.last_per_key(df, "k", ["dt"])) == [("a", 3, 6), ("b", 2, 7)]


def test_weight_grid_over_several_passes(spark, monkeypatch):
    monkeypatch.setattr(M, "CANDIDATES_PER_PASS", 2)
    df = spark.createDataFrame([(100.0, 90.0, 130.0)], "y double, a double, b double")
    got = M.score_weight_grid(df, "y", ["a", "b"], [(1, 0), (0, 1), (0.5, 0.5)], metric="mape").orderBy("weight_id")
    assert [r["mape"] for r in got.collect()] == pytest.approx([0.1, 0.3, 0.1])


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_no_single_task_exchange_in_large_plans(spark):
    """Ranks and folds must not funnel rows through one task."""
    from pricelab.operators import ranks as R

    df = spark.range(30_000).select("id", (F.col("id") % 977).cast("double").alias("v"))
    for out in (R.global_rank(df, ["v", "id"]), R.stratified_folds(R.rank_level(df, "v", "id", 5), "level", "id", 5)):
        assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()


def test_columns_without_a_value_are_counted(spark):
    from pricelab.operators.profile import distinct_counts

    df = spark.createDataFrame([("a", None), ("b", None)], "x string, y string")
    assert sorted(map(tuple, distinct_counts(df, df, ["x", "y"]).collect())) == [("x", 2, 2), ("y", 0, 0)]


def test_log_lines_with_several_records_and_lists(spark):
    from pricelab.sources.results import parse_search_log

    one = "(('metric', ['mse', 'mape']), ('rate', -0.5), ('depth', None)) 12.5 0.04 0.13 0.008 [12.0, 13.0] [0.1, 0.2]"
    df = spark.createDataFrame([(f"[[{one}, {one.replace('12.5', '7.5')}",), ("nothing",)], "value string")
    got = parse_search_log(df).orderBy("score").collect()
    assert [r["score"] for r in got] == [7.5, 12.5]
    assert all(r["fold_lists"] == [[12.0, 13.0], [0.1, 0.2]] and r["params"]["rate"] == "-0.5" for r in got)


def test_corr_matrix_of_parts_gaps_and_constants(spark):
    """Against numpy over the rows where both are known; large offsets, uneven parts, constants and non-finite values."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    x[:, 1] = 1e9 + x[:, 0] * 2 + rng.normal(size=500)
    x[:, 3] = np.sort(x[:, 3]) + 1e6
    gaps = rng.random(x.shape) < 0.2
    rows = [tuple(None if g else float(v) for v, g in zip(r, m)) + (0.1, None, float("nan") if i == 7 else 1.0 * i) for i, (r, m) in enumerate(zip(x, gaps))]
    cols = ["p", "q", "r", "s", "fixed", "never", "odd"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols)).repartition(7)
    got = {(r["a"], r["b"]): r["corr"] for r in P.corr_matrix(df, cols).collect()}
    assert len(got) == 21
    for i in range(4):
        for j in range(i + 1, 4):
            both = ~gaps[:, i] & ~gaps[:, j]
            assert got[cols[i], cols[j]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-7)
    assert all(got[c, "fixed"] is None and got[c, "never"] is None for c in "pqrs") and got["fixed", "never"] is None
    seen = [c for i, c in enumerate("pqrs") if not gaps[7, i]]
    assert all(math.isnan(got[c, "odd"]) == (c in seen) for c in "pqrs")
    empty = P.corr_matrix(df.where("p > 1e12"), cols).collect()
    assert len(empty) == 21 and all(r["corr"] is None for r in empty)


def test_importances_without_a_base_row(spark):
    scores = spark.createDataFrame([("x", 1.0, [1.0])], "feat string, avg double, folds array<double>")
    for compare in (P.importance_diff, FI.keep_scored_features):
        with pytest.raises(ValueError, match="no score of 'none'"):
            compare(scores)
