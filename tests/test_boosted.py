"""The trees of ``models.boosted`` against Spark's learner."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from pricelab.functions.targets import target_inverse
from pricelab.models import boosted as B
from pricelab.models import jobs as J
from pricelab.models import search as S
from pricelab.session import stored

COLS = ["x", "z", "g"]


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(3000).select(
        F.col("id").alias("building_id"), (F.col("id") * 7919 % 1009 / 100).alias("x"), (F.col("id") * 104729 % 997 % 90 / 7).alias("z"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 31 % 5).alias("g"), (F.col("id") * 17 % 3).cast("int").alias("fold"), F.lit(2.0).alias("building_area"),
    )
    df = df.withColumn("lp", 8 + F.sin("x") * F.col("z") / 9 + F.sin(F.col("building_id") * 1.7) / 3)
    return stored(df.withColumn("total_price", F.expm1("lp") * 2).withColumn("part", (F.col("x") > 4).cast("int")))


def trees(rounds=7, depth=4, step=0.4, **more):
    return J.boosted_trees("lp", max_iter=rounds, depth=depth, step=step, **more)


def gap(a, b, ready):
    one = lambda m, c: m.transform(ready).select("building_id", F.col("y_raw").alias(c))
    return one(a, "a").join(one(b, "b"), "building_id").agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0]


@pytest.mark.parametrize("more", [{}, {"early_stop": False}, {"weighted": True}, {"early_stop": False, "depth": 6, "minInstancesPerNode": 40}, {"tol": 0.05}])
@pytest.mark.parametrize("spread", [False, True])
def test_trees_are_those_of_spark(spark, rows, monkeypatch, more, spread):
    if spread:
        monkeypatch.setattr(B, "ROWS_IN_ONE_TASK", 100)
        monkeypatch.setattr(B, "ROWS_PER_READER", 900)
        monkeypatch.setattr(B, "BLOCK", 256)
    ready = J.assemble(rows, COLS).withColumn(J.IS_VAL, F.col("fold") == 1).withColumn(J.WEIGHT, 1.0 + F.col("part"))
    est = trees(**more)
    want, got = est.fit(ready), B.fit(est, ready)
    assert got.getNumTrees == want.getNumTrees and got.treeWeights == want.treeWeights and got.numFeatures == 3
    assert gap(want, got, ready) < 1e-9
    assert got.evaluateEachIteration(ready, "squared") == pytest.approx(want.evaluateEachIteration(ready, "squared"), rel=1e-9)
    assert list(got.featureImportances.toArray()) == pytest.approx(list(want.featureImportances.toArray()), abs=1e-6)


def test_candidates_of_many_rows_are_those_of_spark(spark):
    """Beyond 10,000 rows Spark draws a sample, whose steps may give one bin more than asked for."""
    df = spark.range(12000).select(
        F.col("id").alias("building_id"), (F.col("id") * 7919 % 10007 / 100).alias("x"), F.sqrt(F.col("id") * 31 % 977).alias("z"), (F.col("id") % 35 - 1.0).alias("g"),
        (8 + F.sin(F.col("id") * 7919 % 10007 / 700) + F.cos(F.col("id") % 35)).alias("lp"), (F.col("id") % 4 == 1).alias(J.IS_VAL),
    )
    ready = stored(J.assemble(df, COLS))
    assert gap(trees(3).fit(ready), B.fit(trees(3), ready), ready) < 1e-9
    x = np.repeat(np.arange(40.0), 3)[:, None]
    cuts = B.thresholds(x, np.ones(120), 33)
    block = next(B._blocks([(False, x.T, np.arange(120.0), None)], [np.arange(32) + 0.5]))
    cells, sums, _ = B._level([], [32], [block])
    assert len(cuts[0]) >= 32 and cells.shape[-1] == 64 and cells[0].sum() == sums[0, 0] == 120


def test_a_search_reads_its_table_once(spark, rows, monkeypatch):
    """All fits of a sweep, segments and grids share one reading, and none is Spark's."""
    made, read = [], B.Rows.__init__
    monkeypatch.setattr(B.Rows, "__init__", lambda self, *a: made.append(1) or read(self, *a))
    inverse = target_inverse("y_raw", "building_area")
    known = S.fold_scores(rows, trees(2), ["x", "g"], "lp", inverse, "total_price", "fold", 1)
    made.clear()
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *a: pytest.fail("a fit of its own"))
    out = S.step_removal(rows, lambda: trees(2), ["z"], COLS, [0, 1], "lp", inverse).collect()
    assert len(made) == 1
    scores = {r["params"]["n_feats_rm"]: r for r in out}
    assert scores["1"]["scores"][1] == pytest.approx(known["score"]) and scores["1"]["mses"][1] == pytest.approx(known["mse"])
    S.param_grid(rows, trees(1, early_stop=False), {"maxDepth": [1, 2]}, COLS, "lp", top=1)
    assert len(made) == 2


def test_segments_keep_their_rows_and_weights(spark, rows):
    """Shared rows give what a fit on the segment's own frame gives."""
    make = lambda: trees(3, weighted=True)
    for duplicate in (False, True):
        out = J.segment_models(rows, "part", [1, 0], make, COLS, duplicate=duplicate)
        mine, held = F.col("part") == 1, F.col("fold") == 2
        ready = J.assemble(rows, COLS).where(mine | (~held if duplicate else mine))
        ready = ready.withColumn(J.WEIGHT, F.when(mine & ~held & F.lit(duplicate), 2.0).otherwise(1.0)).withColumn(J.IS_VAL, held)
        want = make().fit(ready).transform(ready.where(mine & held)).select("building_id", F.col("y_raw").alias("want"))
        both = out.where((F.col("part") == 1) & (F.col("fold") == 2)).join(want, "building_id")
        assert both.count() == want.count() and both.agg(F.max(F.abs(F.col("y_raw") - F.col("want")))).first()[0] < 1e-9


def test_what_spark_refuses_is_refused(spark, rows):
    ready = J.assemble(rows, COLS)
    with pytest.raises(Exception, match="labels must not be null"):
        B.fit(trees(1, early_stop=False), ready.withColumn("lp", F.when(F.col("x") > 1, F.col("lp"))))
    with pytest.raises(Exception, match="no rows to validate"):
        B.fit(trees(1), ready.withColumn(J.IS_VAL, F.lit(False)))
    assert not B.supported(trees(1, subsamplingRate=0.5), ready) and not B.supported(J.random_forest("lp"), ready)
