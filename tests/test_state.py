"""Encoder states written and read back by another session; searches and joins that hide nothing."""

import pytest
from pyspark.sql import functions as F

from pricelab.encoders.categorical import CategoryEncoder, FrequencyEncoder, MultiLabelEncoder, RareNuller, TargetMeanEncoder
from pricelab.encoders.geometry import GeoCluster
from pricelab.encoders.numeric import Imputer, MedianScaler, MinMaxScaler, SkewLog, StandardScaler
from pricelab.encoders.stages import FeatureSteps
from pricelab.encoders.state import encoder_state, from_state, load_encoder, save_encoder
from pricelab.models import jobs as J, search as S
from pricelab.operators.joins import join_predictions


@pytest.fixture(scope="module")
def train(spark):
    names = F.array(*[F.lit(x) for x in ("été", "b", "c d", "e'\"")])
    return spark.range(200).select(
        "id", F.when(F.col("id") % 9 != 0, F.get(names, (F.col("id") % 4).cast("int"))).alias("town"),
        F.when(F.col("id") == 77, "once").otherwise("often").alias("kind"),
        F.when(F.col("id") % 7 != 0, F.exp(F.col("id") / 20)).alias("x"), (F.col("id") / 3).alias("z"), F.col("id").cast("double").alias("y"),
    ).cache()


FITTED = {
    "lightgbm": lambda t: CategoryEncoder().fit(t, ["town", "kind"]),
    "keras": lambda t: CategoryEncoder("keras", True).fit(t, ["town"]),
    "target": lambda t: TargetMeanEncoder().fit(t, ["town", "kind"], "y"),
    "target_parity": lambda t: TargetMeanEncoder(True).fit(t, ["town"], "y"),
    "labels": lambda t: MultiLabelEncoder(3).fit(t, ["town"]),
    "frequency": lambda t: FrequencyEncoder().fit(t, "town"),
    "rare": lambda t: RareNuller(2).fit(t, ["kind", "town"]),
    "imputer": lambda t: Imputer().fit(t, ["x", "z", "town"], {"town": "mode"}),
    "standard": lambda t: StandardScaler().fit(t, ["x", "z"]),
    "median": lambda t: MedianScaler().fit(t, ["x", "z"]),
    "range": lambda t: MinMaxScaler(-1, 1).fit(t, ["x", "z"]),
    "skew": lambda t: SkewLog().fit(t, ["x", "z"]),
    "chain": lambda t: FeatureSteps(["x", "z"], ["town"], "y", fill={"x": "median"}, rare=["kind"], skewed=None).fit(t),
    "short_chain": lambda t: FeatureSteps(["x"], ["town"], "y", fill={"x": -1.0}, rare=["kind"], scale=False, codes=None, target_encode=False).fit(t),
}


@pytest.mark.parametrize("name", sorted(FITTED))
def test_state_comes_back_in_another_session(spark, train, tmp_path, name):
    fitted, path = FITTED[name](train), f"file://{tmp_path}/state"
    other = train.withColumn("town", F.when(F.col("id") % 10 == 3, "new").otherwise(F.col("town")))
    if name == "keras":
        other = train
    save_encoder(fitted, path, spark)
    back = load_encoder(spark.newSession(), path)
    same = lambda e: sorted(map(str, e.transform(other).collect()))
    assert type(back) is type(fitted) and same(back) == same(fitted)
    if name == "chain":
        assert back.features() == fitted.features()
        scaled = back.transform(train)
        inverse = back.target_inverse(scaled, "y_scaled", "y_back")
        assert inverse.agg(F.max(F.abs(F.col("y") - F.col("y_back")))).first()[0] < 1e-9


def test_other_versions_and_kinds_are_refused(spark, train):
    state = encoder_state(FITTED["standard"](train), spark)
    with pytest.raises(ValueError, match="version"):
        from_state(state.withColumn("version", F.lit(99)))
    with pytest.raises(TypeError, match="state"):
        encoder_state(GeoCluster(), spark)


def test_sweep_takes_the_best_seed(spark):
    points = spark.range(300).select((F.col("id") % 5 * 10 + F.col("id") % 3).cast("double").alias("lat"), (F.col("id") % 7).cast("double").alias("lon"))
    cost = lambda seeds: {r["k"]: r["inertia"] for r in GeoCluster(seeds=seeds, max_iter=20).sweep(points, range(3, 6)).collect()}
    one, both = cost((1,)), cost((1, 2, 3))
    assert set(both) == {3, 4, 5} and all(both[k] <= one[k] + 1e-9 for k in both)


def test_two_predictions_of_one_model_are_an_error(spark):
    rows = [(1, 1, 5.0), (1, 2, 6.0), (2, 1, 5.0), (2, 2, 7.0)]
    schema = "building_id long, model_id int, y_pred double"
    assert join_predictions(spark.createDataFrame(rows, schema), [1, 2]).count() == 2
    with pytest.raises(Exception, match="several predictions"):
        join_predictions(spark.createDataFrame([*rows, (2, 1, 9.0)], schema), [1, 2]).collect()


def test_pruned_sets_keep_their_folds(spark):
    df = spark.range(300).select(
        F.col("id").alias("building_id"), (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") * 7 % 13).cast("double").alias("z"),
    ).withColumn("total_price", 1000 + 200 * F.col("x")).withColumn("lp", F.log1p("total_price"))
    make = lambda p: J.boosted_trees("lp", max_iter=4, depth=3, step=0.5, early_stop=False)
    search = lambda floor, **k: S.random_search(df, make, [{"f": "x"}, {"f": "z"}], lambda p: [p["f"]], "lp", F.expm1("y_raw"), floor=floor, **k)
    free = {r["params"]["f"]: r["score"] for r in search(None).collect()}
    floor = (free["x"] + free["z"]) / 2
    got = {r["params"]["f"]: r for r in search(floor, keep_pruned=True).collect()}
    assert len(got["x"]["scores"]) == 3 and got["x"]["pruned_at"] is None
    assert len(got["z"]["scores"]) < 3 and got["z"]["pruned_at"] is not None
    assert "pruned_at" not in search(floor).columns
