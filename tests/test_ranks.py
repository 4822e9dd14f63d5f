import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from pricelab.operators import quantiles as Q
from pricelab.operators import ranks as R
from pricelab.operators.joins import lookup_join, nearest_value_join
from pricelab.operators.metrics import auc, gini_normalized, prefix_sum

slow = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def skewed(spark, n=3000):
    """A third of all rows share one value."""
    return spark.range(n).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 37 % 101).cast("double")).alias("v")
    )


@pytest.fixture
def large_paths(monkeypatch):
    """Send small inputs down the paths made for large ones."""
    monkeypatch.setattr(R, "_SMALL_INPUT", 0)
    monkeypatch.setattr(Q, "_SMALL_INPUT", 0)


@slow
@given(partitions=st.integers(1, 40))
def test_global_rank_is_a_permutation_in_order(spark, partitions):
    rows = R.global_rank(skewed(spark), ["v", "id"], partitions=partitions).collect()
    assert sorted(r["rank"] for r in rows) == list(range(3000))
    by_rank = sorted(rows, key=lambda r: r["rank"])
    assert [(r["v"], r["id"]) for r in by_rank] == sorted((r["v"], r["id"]) for r in rows)


def test_a_hot_value_spreads_over_partitions(spark):
    laid = R.ordered_layout(skewed(spark), ["v", "id"], 8)
    largest = max(R.layout_counts(laid).values())
    assert largest < 3000 / 3 * 0.75


def test_order_stats_are_exact(spark, large_paths):
    df = skewed(spark)
    expected = sorted((r["v"], r["id"]) for r in df.collect())
    got = R.order_stats(df, "v", [0, 999, 1500, 2999], tie=["id"])
    assert {p: (r["v"], r["id"]) for p, r in got.items()} == {p: expected[p] for p in (0, 999, 1500, 2999)}


def test_values_at_positions_with_a_hot_value(spark):
    expected = sorted(r["v"] for r in skewed(spark).collect())
    assert Q.values_at_positions(skewed(spark), "v", [0, 1000, 2999]) == {p: expected[p] for p in (0, 1000, 2999)}


def test_order_stats_reject_positions_outside(spark):
    with pytest.raises(ValueError):
        R.order_stats(skewed(spark), "v", [3000], tie=["id"])


def test_exact_quantiles_against_sorting(spark, large_paths):
    df = skewed(spark).withColumn("w", F.when(F.col("id") % 5 != 0, F.col("id") * 1.5)).withColumn("none", F.lit(None).cast("double"))
    got = Q.exact_quantiles(df, ["v", "w", "none"], [0.25, 0.5, 0.9])
    for c in ("v", "w"):
        values = sorted(r[c] for r in df.collect() if r[c] is not None)
        for p, x in zip((0.25, 0.5, 0.9), got[c]):
            h = (len(values) - 1) * p
            lo = values[int(h)]
            assert x == pytest.approx(lo + (values[min(int(h) + 1, len(values) - 1)] - lo) * (h - int(h)))
    assert got["none"] == [None, None, None]


def test_small_and_large_quantile_paths_agree(spark, monkeypatch):
    df = skewed(spark)
    small = Q.exact_quantiles(df, ["v"], [0.1, 0.5])
    monkeypatch.setattr(Q, "_SMALL_INPUT", 0)
    assert Q.exact_quantiles(df, ["v"], [0.1, 0.5]) == small


@pytest.mark.parametrize("n,k,levels", [(11, 5, 6), (9, 5, 9), (10, 5, 5)])
def test_rank_level_has_extra_levels(spark, n, k, levels):
    df = spark.range(n).select("id", (F.col("id") * 10).cast("double").alias("v"))
    got = {r["id"]: r["level"] for r in R.rank_level(df, "v", "id", k).collect()}
    assert got == {i: i // (n // k) for i in range(n)}
    assert len(set(got.values())) == levels


@pytest.mark.parametrize("pct,kept", [(1, 198), (3, 194), (5, 190)])
def test_trim_tails_size(spark, pct, kept):
    df = spark.range(200).select("id", (F.col("id") % 50).cast("double").alias("v"))
    assert R.trim_tails(df, "v", "id", pct).count() == kept


def test_rank_split_uses_strictly_below(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3, 4, 5)], "v double")
    got = sorted((r["v"], r["grp"]) for r in Q.rank_split(df, "v", [2, 4]).collect())
    assert got == [(1.0, 0), (2.0, 1), (2.0, 1), (3.0, 1), (4.0, 2), (5.0, 2)]


def test_stratified_folds_partition_each_level(spark):
    df = spark.range(1003).select("id", F.when(F.col("id") < 700, F.lit(0)).otherwise(F.lit(1)).alias("level"))
    rows = R.stratified_folds(df, "level", "id", 5).groupBy("level", "fold").count().collect()
    sizes = {(r["level"], r["fold"]): r["count"] for r in rows}
    assert sum(sizes.values()) == 1003
    for level in (0, 1):
        per = [sizes[(level, f)] for f in range(5)]
        assert max(per) - min(per) <= 1


def test_shuffle_column_is_a_permutation(spark):
    df = skewed(spark, 500)
    out = R.shuffle_column(df, "id", "v", seed=1)
    assert sorted(r["v"] for r in out.collect()) == sorted(r["v"] for r in df.collect())
    assert [r["id"] for r in out.orderBy("id").collect()] == list(range(500))
    assert [r["v"] for r in out.orderBy("id").collect()] != [r["v"] for r in df.orderBy("id").collect()]


def test_within_group_rank_paths_agree(spark, monkeypatch):
    df = spark.range(300).select((F.col("id") % 2).alias("g"), (F.col("id") * 7 % 300).alias("x"))
    small = {(r["g"], r["x"]): r["r"] for r in R.within_group_rank(df, ["g"], ["x"], "r").collect()}
    monkeypatch.setattr(R, "_SMALL_INPUT", 0)
    large = {(r["g"], r["x"]): r["r"] for r in R.within_group_rank(df, ["g"], ["x"], "r").collect()}
    assert small == large


def test_nearest_value_edges_and_ties(spark):
    seen = spark.createDataFrame([(10.0,), (20.0,), (20.0,), (40.0,), (None,)], "v double")
    asked = [(1, 10.0), (2, 15.0), (3, 5.0), (4, 99.0), (5, 31.0), (6, None), (7, float("nan"))]
    out = nearest_value_join(spark.createDataFrame(asked, "id int, q double"), "q", seen, "v", "id").collect()
    assert {r["id"]: r["nearest"] for r in out} == {1: 10.0, 2: 10.0, 3: 10.0, 4: 40.0, 5: 40.0, 6: None, 7: None}


@slow
@given(seed=st.integers(0, 10_000))
def test_nearest_value_against_brute_force(spark, seed):
    rng = random.Random(seed)
    seen = sorted({rng.randint(0, 400) / 2 for _ in range(60)})
    # A third of the questions ask for the same value.
    asked = [(i, 77.25 if i % 3 == 0 else rng.randint(-40, 900) / 4) for i in range(300)]
    got = nearest_value_join(
        spark.createDataFrame(asked, "id int, q double"), "q", spark.createDataFrame([(v,) for v in seen], "v double"), "v", "id"
    ).collect()
    want = {i: min(seen, key=lambda v: (abs(v - q), v)) for i, q in asked}
    assert {r["id"]: r["nearest"] for r in got} == want


def test_auc_with_ties(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), rng.randint(0, 9) / 10) for _ in range(400)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    got = auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()["auc"]
    assert got == pytest.approx(want)


def test_gini_of_perfect_order_is_one(spark):
    df = spark.range(50).select("id", (F.col("id") % 7 + 1).cast("double").alias("y"))
    assert gini_normalized(df, "y", "y", "id").first()["gini"] == pytest.approx(1.0)


def test_gini_keeps_id_order_on_ties(spark):
    rows = [(0, 1.0, 0.5), (1, 3.0, 0.5), (2, 2.0, 0.9)]

    def by_hand(order):
        run, total = 0.0, 0.0
        for i in order:
            run += rows[i][1]
            total += run
        return (total / 6.0 - 2.0) / 3

    want = by_hand([2, 0, 1]) / by_hand([1, 2, 0])
    got = gini_normalized(spark.createDataFrame(rows, "id int, y double, p double"), "y", "p", "id").first()["gini"]
    assert got == pytest.approx(want)


def test_prefix_sum(spark):
    df = spark.range(200).select("id", (F.col("id") % 3).alias("w"))
    got = {r["id"]: r["below"] for r in prefix_sum(df, ["id"], "w", "below").collect()}
    assert got == {i: sum(j % 3 for j in range(i)) for i in range(200)}


def test_lookup_join_beyond_the_broadcast_bound(spark, monkeypatch):
    import pricelab.operators.joins as J

    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 90).cast("string")).alias("k"))
    df = df.withColumn("k", F.when(F.col("id") % 50 != 1, F.col("k")))
    state = spark.range(80).select(F.col("id").cast("string").alias("value"), F.col("id").alias("code")).union(
        spark.createDataFrame([("hot", -5)], "value string, code bigint")
    )
    small = {r["id"]: r["code"] for r in lookup_join(df, state, {"k": "value"}).collect()}
    monkeypatch.setattr(J, "BROADCAST_ROWS", 3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lookup_join(df, state, {"k": "value"})
        large = {r["id"]: r["code"] for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert out.columns == ["id", "k", "code"]
    assert small == large and len(large) == 2000


def test_gini_of_a_grid_is_that_of_each_blend_and_writes_no_rows(spark):
    import os
    import random

    from pricelab.operators.metrics import CANDIDATES_PER_PASS, score_weight_grid
    from pricelab.session import shared_dir

    rng = random.Random(5)
    odd = [None, 0.0, -0.0, -3.5, 1e15, -1e15, float("nan"), float("inf"), 0.01, 0.02, 7.0]
    for values in (odd, [rng.random() for _ in range(20)], [1000 * rng.random() for _ in range(300)]):
        data = [(i, rng.choice([1.0, 2.5, 40.0, rng.random(), None]), rng.choice(values), rng.choice(values[1:])) for i in range(300)]
        df = spark.createDataFrame(data, "building_id long, y double, a double, b double").repartition(3).checkpoint()
        weights = [(1.0, 0.0), (0.0, 1.0), (0.25, 0.75)]
        folder = shared_dir(spark).removeprefix("file:")
        before = set(os.listdir(folder))
        got = {r["weight_id"]: r["gini"] for r in score_weight_grid(df, "y", ["a", "b"], weights, "gini").collect()}
        assert set(os.listdir(folder)) <= before
        # A longer list takes the other form of the same expressions.
        long = score_weight_grid(df, "y", ["a", "b"], weights * CANDIDATES_PER_PASS, "gini").where("weight_id < 3").collect()
        assert len(got) == 3
        for k, (u, v) in enumerate(weights):
            one = df.selectExpr("building_id", "y", f"0e0 + {u}e0 * a + {v}e0 * b AS p")
            want = gini_normalized(one, "y", "p", "building_id").first()["gini"]
            assert got[k] == pytest.approx(want, rel=1e-9, nan_ok=True)
            assert [r["gini"] for r in long if r["weight_id"] == k] == [pytest.approx(want, rel=1e-9, nan_ok=True)]
