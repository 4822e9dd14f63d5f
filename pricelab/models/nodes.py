"""The trees of a fitted ensemble as a node table, and their predictions after every round.

A saved model is a table of nodes, which Spark reads like any other: split counts and
gains are a grouping of it. For predictions the nodes become arrays, whose size is
the model's, and tasks walk all rows of an Arrow batch down a tree at once. The running
sum over the trees is the prediction after each round, so one scan of the rows scores
every round of every fold's model by any metric of the price.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from pricelab.functions.errors import HIT_LIMIT
from pricelab.operators.metrics import HIT_DECIMALS, HIT_SCALE
from pricelab.session import scratch_path

# Ship this module's task functions by value: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows walked down all trees at a time.
ROWS = 2048


def node_table(model: Model, df: DataFrame) -> DataFrame:
    """Rows (tree, node, feature, threshold, gain, weight, left, right, prediction); ``feature`` is null at leaves.

    The model is written to the shared folder and read back from there.
    """
    path = scratch_path(df.sparkSession, "model")
    model.write().save(path)
    node, split = F.col("nodeData"), F.col("nodeData.split")
    inner = node["leftChild"] >= 0
    return df.sparkSession.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), node["id"].alias("node"), F.when(inner, split["featureIndex"]).alias("feature"),
        F.when(inner, split["leftCategoriesOrThreshold"][0]).alias("threshold"), F.when(inner, node["gain"]).alias("gain"),
        # Regression trees keep (weight, sum, sum of squares), others the weight of each class.
        (node["impurityStats"][0] if _regression(model) else F.aggregate(node["impurityStats"], F.lit(0.0), lambda a, b: a + b)).alias("weight"),
        F.when(inner, node["leftChild"]).alias("left"), F.when(inner, node["rightChild"]).alias("right"), node["prediction"].alias("prediction"),
        (inner & (split["numCategories"] >= 0)).alias("categorical"),
    )


def _forest(model: Model) -> bool:
    return "RandomForest" in type(model).__name__


def _regression(model: Model) -> bool:
    return not (_forest(model) and "Classification" in type(model).__name__)


def split_importance(model: Model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Rows (feat, gain, splits): share of the gain, and the number of splits, of every feature.

    Gains are weighted by the rows that reach the split; in a forest each tree counts the same.
    """
    inner = node_table(model, df).where("feature IS NOT NULL").withColumn("part", F.col("gain") * F.col("weight"))
    per_tree = inner.groupBy("tree", "feature").agg(F.sum("part").alias("part"), F.count(F.lit(1)).alias("splits"))
    if _forest(model):
        totals = inner.groupBy("tree").agg(F.sum("part").alias("all"))
        per_tree = per_tree.join(totals, "tree").withColumn("part", F.try_divide("part", "all"))
    named = F.array(*[F.lit(c) for c in features])
    found = per_tree.groupBy("feature").agg(F.sum("part").alias("part"), F.sum("splits").alias("splits"))
    every = df.sparkSession.range(len(features)).select(F.col("id").cast("int").alias("feature"), F.get(named, F.col("id").cast("int")).alias("feat"))
    total = found.agg(F.sum("part").alias("all"))
    joined = every.join(found, "feature", "left").join(F.broadcast(total))
    gain, splits = F.coalesce(F.try_divide("part", "all"), F.lit(0.0)), F.coalesce("splits", F.lit(0))
    return joined.select("feat", gain.alias("gain"), splits.alias("splits")).orderBy(F.desc("gain"), "feat")


@dataclass
class Trees:
    """Arrays of each tree, by node id, and the trees' weights."""

    trees: list[tuple[np.ndarray, ...]]
    weights: np.ndarray
    mean: bool

    def rounds(self, x: np.ndarray) -> np.ndarray:
        """Predictions after 1, 2, ... trees, one column each."""
        out = np.empty((len(x), len(self.trees)))
        rows = np.arange(len(x))
        for k, (feature, threshold, left, right, value) in enumerate(self.trees):
            at = np.zeros(len(x), np.int64)
            while True:
                f = feature[at]
                moving = f >= 0
                if not moving.any():
                    break
                goes_left = x[rows, np.maximum(f, 0)] <= threshold[at]
                at = np.where(moving, np.where(goes_left, left[at], right[at]), at)
            out[:, k] = value[at] * self.weights[k]
        total = np.cumsum(out, axis=1)
        return total / np.cumsum(self.weights) if self.mean else total


def trees_of(model: Model, df: DataFrame) -> Trees:
    """The model's trees as arrays; the driver holds one number set per node of the model."""
    rows = node_table(model, df).collect()
    if any(r["categorical"] for r in rows):
        raise ValueError("only splits at a threshold are walked")
    out = []
    for k in range(len(model.treeWeights)):
        mine = sorted((r for r in rows if r["tree"] == k), key=lambda r: r["node"])
        if [r["node"] for r in mine] != list(range(len(mine))):
            raise ValueError("the nodes of a tree are not numbered in turn")
        column = lambda c, empty: np.array([empty if r[c] is None else r[c] for r in mine])  # noqa: B023, E731
        out.append((column("feature", -1), column("threshold", 0.0), column("left", 0), column("right", 0), column("prediction", 0.0)))
    return Trees(out, np.array(model.treeWeights, float), _forest(model))


_SUMS = ("n", "hits", "known", "ape", "logs", "sle", "targets", "sq")


def round_scores(
    ready: DataFrame, models: dict[int, Trees], target: str, price: str, area: str | None, log: bool, fold: str, vector: str
) -> DataFrame:
    """Rows (fold, part, iteration, score, mape, msle, mse): every round of each fold's trees on its train and held-out rows.

    ``score``, ``mape`` and ``msle`` are of the price, ``mse`` of the raw target. One scan of ``ready``, whatever the rounds.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                b = batch.slice(begin, ROWS)
                x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                folds = b.column("fold").to_numpy()
                t, y, a = (b.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("t", "y", "a"))
                for f, trees in models.items():
                    raw = trees.rounds(x)
                    for part in (0, 1):
                        rows = (folds == f) == bool(part)
                        if rows.any():
                            sums = _sums(raw[rows], t[rows], y[rows], a[rows], log)
                            held[f, part] = held.get((f, part), 0.0) + sums
        for (f, part), sums in held.items():
            k = sums.shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * k, pa.int32()), pa.array([part] * k, pa.int32()), pa.array(range(1, k + 1), pa.int32()), *map(pa.array, sums)],
                ["fold", "val", "iteration", *_SUMS],
            )

    factor = F.lit(1.0) if area is None else F.col(area).cast("double")
    narrow = ready.select(
        F.col(fold).cast("int").alias("fold"), vector_to_array(vector).alias("x"), F.col(target).cast("double").alias("t"),
        F.col(price).cast("double").alias("y"), factor.alias("a"),
    )
    schema = "fold int, val int, iteration int, " + ", ".join(f"{c} double" for c in _SUMS)
    sums = narrow.mapInArrow(partial, schema).groupBy("fold", "val", "iteration").agg(*[F.sum(c).alias(c) for c in _SUMS])
    mape = F.try_divide("ape", "known")
    return sums.select(
        "fold", F.when(F.col("val") == 1, "val").otherwise("train").alias("part"), "iteration",
        (F.bround(F.col("hits") / F.col("n"), HIT_DECIMALS) * F.lit(HIT_SCALE) + (F.lit(1.0) - mape)).alias("score"),
        mape.alias("mape"), F.try_divide("sle", "logs").alias("msle"), F.try_divide("sq", "targets").alias("mse"),
    )


def _sums(raw: np.ndarray, target: np.ndarray, y: np.ndarray, area: np.ndarray, log: bool) -> np.ndarray:
    with np.errstate(all="ignore"):
        p = (np.expm1(raw) if log else raw) * area
        gap, sq = np.abs(p - y), (raw - target) ** 2
        ape, sle = gap / np.abs(y), (np.log1p(p) - np.log1p(y)) ** 2
        known = [~np.isnan(v) & ((y != 0) | (v is not ape)) for v in (ape, sle, sq)]
        rows = [np.full(raw.shape[1], float(len(raw))), (gap <= HIT_LIMIT * y).sum(axis=0)]
        for v, ok in zip((ape, sle, sq), known):
            rows += [ok.sum(axis=0), np.where(ok, v, 0.0).sum(axis=0)]
    return np.array(rows, float)
