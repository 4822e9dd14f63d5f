import math

import pytest
from pyspark.sql import functions as F

from pricelab.functions.calendar import bucket_trunc, calendar_features
from pricelab.functions.errors import asymmetric_sq_error, banded_sq_error, is_hit, smooth_hit, smooth_hit_slope
from pricelab.functions.keys import compose_place_keys
from pricelab.functions.rows import row_dot, row_mean, row_vote
from pricelab.functions.targets import building_age_years, target_inverse, target_transform, top_floor
from pricelab.operators import metrics as M
from pricelab.sources.predictions import expand_id_ranges


def one(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_zero_and_missing_area_give_null(spark):
    df = target_transform(spark.createDataFrame([(100.0, 0.0), (100.0, None), (100.0, 4.0)], "total_price double, building_area double"))
    assert one(df, F.col("per_area_total_price")) == [None, None, 25.0]
    assert one(df, F.col("log_per_area_total_price"))[2] == pytest.approx(math.log1p(25))


def test_plain_targets_are_not_clipped(spark):
    df = spark.createDataFrame([(-0.5, 10.0)], "p double, a double")
    assert one(df, target_inverse("p", "a")) == [0.0]
    assert one(df, target_inverse("p", "a", log=False)) == [-5.0]
    assert one(df, target_inverse("p", log=False, per_area=False)) == [-0.5]


def test_calendar_of_negative_days_is_floored(spark):
    row = calendar_features(spark.createDataFrame([(-3,)], "d int"), "d").first()
    assert (row["dow_d"], row["day_in_year_d"], row["year_d"]) == (4, 362, -1)
    assert (row["month_d"], row["quarter_d"]) == (11, 3)


def test_truncation_goes_toward_zero(spark):
    df = spark.createDataFrame([(-13,), (13,)], "d int")
    assert one(df, bucket_trunc("d", 7)) == [-1, 1]
    assert one(df, building_age_years("d")) == [-1, 0]


def test_top_floor_needs_known_floors(spark):
    df = spark.createDataFrame([(3, 3), (None, None), (2, 3)], "f int, t int")
    assert one(df, top_floor("f", "t")) == [True, False, False]


def test_village_key_uses_the_rewritten_town(spark):
    df = compose_place_keys(spark.createDataFrame([("c", "t", None)], "city string, town string, village string"))
    assert tuple(df.first()) == ("c", "c-t", "c-t-nan")


def test_hits_treat_nan_and_null_as_misses(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(100.0, 110.0), (100.0, nan), (100.0, None), (100.0, inf), (nan, nan)], "y double, p double")
    assert one(df, is_hit("y", "p")) == [True, False, False, False, False]


def test_hit_rate_rounds_half_to_even(spark):
    # 10001 hits of 20000 rows: rate 0.50005.
    df = spark.range(20000).select(
        F.lit(100.0).alias("y"), F.when(F.col("id") < 10001, F.lit(100.0)).otherwise(F.lit(200.0)).alias("p")
    )
    rate = df.agg(M.hit_rate("y", "p")).first()[0]
    assert rate == 0.5


def test_banded_loss_is_continuous(spark):
    df = spark.createDataFrame([(-0.1,), (-0.1 - 1e-9,), (0.05,), (0.2,)], "r double")
    at, beyond, inside, high = one(df, banded_sq_error("r", -0.1, 0.1))
    assert at == pytest.approx(beyond, abs=1e-8)
    assert at == pytest.approx(0.1 * 0.01)
    assert inside == pytest.approx(0.1 * 0.0025)
    assert high == pytest.approx(0.04 - 0.9 * 0.01)


def test_asymmetric_loss(spark):
    df = spark.createDataFrame([(-2.0,), (2.0,)], "r double")
    assert one(df, asymmetric_sq_error("r")) == [40.0, 4.0]


def test_smooth_hit_slope_is_its_derivative(spark):
    df = spark.createDataFrame([(0.02,), (0.1,), (0.3,)], "x double")
    h = 1e-6
    numeric = one(df, (smooth_hit(F.col("x") + h) - smooth_hit(F.col("x") - h)) / (2 * h))
    assert one(df, smooth_hit_slope("x")) == pytest.approx(numeric, rel=1e-5)


def test_row_reductions(spark):
    df = spark.createDataFrame([(1, 2, 2), (3, 1, 2), (None, 5, None)], "a int, b int, c int")
    assert one(df, row_vote(["a", "b", "c"])) == [2, 1, 5]
    assert one(df, row_mean(["a", "b", "c"]))[2] == 5.0
    assert one(df, row_dot(["a", "b", "c"], [1, 10, 100])) == [221.0, 213.0, None]


def test_id_ranges(spark):
    df = expand_id_ranges(spark.createDataFrame([("1-3,7, 9-10",)], "t string"), "t")
    assert [r["id"] for r in df.collect()] == [1, 2, 3, 7, 9, 10]
