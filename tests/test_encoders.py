import math

import pytest
from pyspark.sql import functions as F

from pricelab.encoders.categorical import (
    CategoryEncoder, FrequencyEncoder, MultiLabelEncoder, RareNuller, TargetMeanEncoder,
)
from pricelab.encoders.geometry import GeoCluster, PcaReduce
from pricelab.encoders.numeric import Imputer, MedianScaler, MinMaxScaler, SkewLog, StandardScaler
from pricelab.encoders.stages import FeatureSteps
from pricelab.operators.filters import fill_constants, rare_values


def values(df, c, key="id"):
    return {r[key]: r[c] for r in df.select(key, c).collect()}


def cats(spark, *vals):
    return spark.createDataFrame(list(enumerate(vals)), "id int, c string")


def test_lightgbm_codes_leave_missing_and_unseen_null(spark):
    enc = CategoryEncoder("lightgbm").fit(cats(spark, "b", "a", None), ["c"])
    assert values(enc.transform(cats(spark, "a", "b", "zz", None)), "c") == {0: 0.0, 1: 1.0, 2: None, 3: None}


def test_keras_codes_reserve_zero(spark):
    enc = CategoryEncoder("keras", reserve_missing=True).fit(cats(spark, "b", "a"), ["c"])
    assert enc.n_classes == {"c": 3}
    assert values(enc.transform(cats(spark, "a", "b", "zz", None)), "c") == {0: 1, 1: 2, 2: 0, 3: 0}


def test_keras_codes_with_missing_in_train(spark):
    enc = CategoryEncoder("keras").fit(cats(spark, "b", None), ["c"])
    assert enc.n_classes == {"c": 2}
    assert values(enc.transform(cats(spark, "b", "zz")), "c") == {0: 1, 1: 0}


def test_keras_codes_raise_without_a_slot(spark):
    enc = CategoryEncoder("keras").fit(cats(spark, "b", "a"), ["c"])
    assert values(enc.transform(cats(spark, "a")), "c") == {0: 0}
    with pytest.raises(Exception, match="without a code"):
        enc.transform(cats(spark, "zz")).collect()


def smoothed(rows):
    """Value -> smoothed mean, by hand."""
    m = sum(y for _, y in rows) / len(rows)
    groups = {}
    for v, y in rows:
        groups.setdefault(v, []).append(y)
    c = len(rows) / len(groups)
    return {v: (sum(ys) + c * m) / (len(ys) + c) for v, ys in groups.items()}, m


ROWS = [("a", 1.0), ("a", 2.0), ("b", 9.0), (None, 8.0), (None, 9.0), ("c", 1.0)]


def target_frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, v, y) for i, (v, y) in enumerate(rows)], "id int, c string, y double")


def test_target_ranks_with_missing(spark):
    enc = TargetMeanEncoder().fit(target_frame(spark), ["c"], "y")
    means, overall = smoothed([(v or "?", y) for v, y in ROWS])
    order = sorted([*means.values(), overall])
    rank = lambda x: order.index(x) + 1
    got = values(enc.transform(cats(spark, "a", "b", "c", None, "new")), "encoded_c")
    assert got == {0: rank(means["a"]), 1: rank(means["b"]), 2: rank(means["c"]), 3: rank(means["?"]), 4: rank(overall)}
    assert enc.unknown_share(cats(spark, "a", "new", None, "other"))["c"] == 0.5


def test_target_ranks_parity_shares_the_higher_rank(spark):
    enc = TargetMeanEncoder(parity=True).fit(target_frame(spark), ["c"], "y")
    means, overall = smoothed([(v or "?", y) for v, y in ROWS])
    order = sorted([*means.values(), overall])
    shared = max(order.index(means["?"]), order.index(overall)) + 1
    got = values(enc.transform(cats(spark, None, "new", "a")), "encoded_c")
    assert got == {0: shared, 1: shared, 2: order.index(means["a"]) + 1}


def test_target_ties_break_by_value(spark):
    enc = TargetMeanEncoder().fit(target_frame(spark, [("y", 1.0), ("x", 1.0), ("z", 4.0)]), ["c"], "y")
    got = values(enc.transform(cats(spark, "x", "y", "z", None)), "encoded_c")
    assert (got[0], got[1], got[2]) == (1, 2, 4)
    assert got[3] == 3


def test_target_encoder_refuses_missing_targets(spark):
    with pytest.raises(ValueError):
        TargetMeanEncoder().fit(spark.createDataFrame([("a", None)], "c string, y double"), ["c"], "y")


@pytest.mark.parametrize("n,expected", [(1, 3), (2, 4), (3, 4), (12, 4)])
def test_multi_label_counts_and_codes(spark, n, expected):
    names = [chr(97 + i) for i in range(n)]
    enc = MultiLabelEncoder(4, seed=1).fit(cats(spark, *names), ["c"])
    # n values plus the missing and unknown labels.
    assert enc.n_cols["c"] == min(4, math.factorial(min(n + 2, 10)) // 2) == min(expected, enc.n_cols["c"])
    out = enc.transform(cats(spark, *names, None, "unseen", "unseen2"))
    for i in range(enc.n_cols["c"]):
        got = values(out, f"lencoded_{i}_c")
        assert sorted({got[k] for k in range(n + 2)}) == list(range(n + 2))
        assert got[n + 1] == got[n + 2]


def test_frequency_encoder(spark):
    enc = FrequencyEncoder().fit(cats(spark, "a", "a", "b", None), "c")
    assert values(enc.transform(cats(spark, "a", "b", "q", None)), "n_txn_per_c") == {0: 2, 1: 1, 2: None, 3: None}


def test_rare_values_kept_when_the_other_set_has_them(spark):
    train, test = cats(spark, "a", "a", "a", "b", "c", "c", None), cats(spark, "b")
    assert {r["value"]: r["n"] for r in rare_values(train, "c", 2, test).collect()} == {"c": 2}
    assert {r["value"] for r in rare_values(train, "c", 2).collect()} == {"b", "c"}
    out = RareNuller(2).fit(train, ["c"], test).transform(train)
    assert values(out, "c") == {0: "a", 1: "a", 2: "a", 3: "b", 4: None, 5: None, 6: None}


def test_imputer_rules(spark):
    rows = [(1.0, 1.0, 5.0), (2.0, 1.0, 5.0), (3.0, 1.0, 2.0), (4.0, 2.0, 2.0), (5.0, 90.0, 1.0), (None, None, None)]
    df = spark.createDataFrame(rows, "even double, skewed double, m double")
    imp = Imputer().fit(df, ["even", "skewed", "m"], {"m": "mode"})
    assert imp.values == {"even": 3.0, "skewed": 1.0, "m": 2.0}
    parity = Imputer(parity=True).fit(df.withColumn("even", F.col("even") * F.col("even")), ["even"])
    assert parity.rules == {"even": "median"} and parity.values == {"even": 9.0}
    assert Imputer().fit(df, ["even"], {"even": -1.0}).transform(df).where("even = -1").count() == 1


def test_fill_constants_covers_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.0,)], "x double")
    assert [r["x"] for r in fill_constants(df, {"x": -1.0}).collect()] == [-1.0, -1.0, 2.0]


@pytest.mark.parametrize("make", [StandardScaler, MedianScaler, lambda: MinMaxScaler(-1, 3)])
def test_scalers_invert(spark, make):
    df = spark.createDataFrame([(float(x), float(x * x)) for x in range(9)], "a double, b double")
    scaler = make().fit(df, ["a", "b"])
    back = scaler.inverse_transform(scaler.transform(df))
    for got, want in zip(back.orderBy("a").collect(), df.collect()):
        assert tuple(got) == pytest.approx(tuple(want), abs=1e-9)


def test_min_max_of_a_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "a double")
    scaler = MinMaxScaler(0, 1).fit(df, ["a"])
    assert [r["a"] for r in scaler.transform(df).collect()] == [0.0, 0.0]
    assert [r["a"] for r in scaler.transform(df.withColumn("a", F.lit(6.0))).collect()] == [1.0, 1.0]


def test_skew_log_picks_columns_and_shifts(spark):
    df = spark.createDataFrame([(float(x), -3.0 if x else 800.0) for x in range(30)], "flat double, heavy double")
    fitted = SkewLog().fit(df, ["flat", "heavy"])
    assert fitted.cols == ["heavy"] and fitted.mins == {"heavy": -3.0}
    assert min(r["heavy"] for r in fitted.transform(df).collect()) == pytest.approx(-1.0)


def test_fit_ignores_validation_rows(spark):
    df = spark.range(60).select(
        F.col("id").cast("int").alias("id"), (F.col("id") % 4).cast("string").alias("c"),
        (F.col("id") % 7).cast("double").alias("x"), F.col("id").cast("double").alias("y"), (F.col("id") % 3).alias("fold"),
    )
    changed = df.withColumns({
        "x": F.when(F.col("fold") == 0, F.col("x") * 100).otherwise(F.col("x")),
        "y": F.when(F.col("fold") == 0, -F.col("y")).otherwise(F.col("y")),
    })
    outs = []
    for frame in (df, changed):
        steps = FeatureSteps(["x"], ["c"], "y", fill={"x": "median"}, rare=["c"], rare_threshold=1).fit(frame.where("fold <> 0"))
        outs.append(sorted(map(tuple, steps.transform(df.where("fold = 0")).select("id", "x", "c", "encoded_c", "y_scaled").collect())))
    assert outs[0] == outs[1]


def test_feature_steps_invert_the_target(spark):
    df = spark.range(20).select(F.col("id").cast("double").alias("y"), (F.col("id") % 5).cast("double").alias("x"), F.lit("k").alias("c"))
    steps = FeatureSteps(["x"], ["c"], "y").fit(df)
    back = steps.target_inverse(steps.transform(df), "y_scaled", "back")
    assert sorted(r["back"] for r in back.collect()) == pytest.approx([float(i) for i in range(20)])


def test_geo_clusters_find_separate_places(spark, tmp_path):
    df = spark.range(90).select("id", ((F.col("id") % 3) * 50 + F.col("id") / 100).alias("lat"), (F.col("id") % 3 * -20).cast("double").alias("lon"))
    fitted = GeoCluster(3, seeds=(1, 2)).fit(df)
    labels = {(r["id"] % 3, r["encoded_latlon"]) for r in fitted.transform(df).collect()}
    assert len(labels) == 3
    fitted.save(str(tmp_path / "clusters"))
    again = GeoCluster.load(str(tmp_path / "clusters"))
    assert {(r["id"] % 3, r["encoded_latlon"]) for r in again.transform(df).collect()} == labels
    costs = {r["k"]: r["inertia"] for r in GeoCluster(seeds=(1,)).sweep(df, [2, 3]).collect()}
    assert costs[3] < costs[2]


def test_pca_is_centered_and_ordered(spark):
    df = spark.range(80).select(
        "id", (F.col("id") + 1000).cast("double").alias("a"), (F.col("id") * 2 + F.col("id") % 3).cast("double").alias("b"),
        F.when(F.col("id") > 3, F.lit(1.0)).alias("gap"),
    )
    fitted = PcaReduce(2).fit(df, None, ["a", "b", "gap"])
    out = fitted.transform(df)
    assert out.columns == ["id", "gap", "pca_0", "pca_1"]
    means = out.agg(F.avg("pca_0"), F.avg("pca_1"), F.variance("pca_0"), F.variance("pca_1")).first()
    assert means[0] == pytest.approx(0, abs=1e-6) and means[1] == pytest.approx(0, abs=1e-6)
    assert means[2] > means[3]
    assert sum(fitted.explained()) == pytest.approx(1.0)


def test_rows_with_gaps_stay(spark):
    from pricelab.encoders.geometry import GeoCluster, PcaReduce

    rows = [(i, float(i % 7), float(i % 5)) for i in range(40)] + [(40, None, 1.0), (41, float("nan"), 2.0)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double")
    out = GeoCluster(3, seeds=(1,)).fit(df).transform(df)
    assert out.count() == 42 and out.where("encoded_latlon IS NULL").count() == 2
    full = df.where("id < 40")
    parts = PcaReduce(2).fit(full, None, ["lat", "lon"]).transform(df)
    assert parts.count() == 42 and parts.where("pca_0 IS NULL").count() == 2
