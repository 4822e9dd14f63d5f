"""Means, weighted sums and subset search over prediction columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from pricelab.blend.candidates import blend_inputs, evaluate
from pricelab.functions.rows import row_dot, row_mean
from pricelab.functions.targets import target_inverse
from pricelab.operators.metrics import blended

# Fixed value: weights further from one than this draw a warning.
WEIGHT_SUM_TOLERANCE = 1e-4


def mean_blend(preds: Sequence[str]) -> Column:
    return row_mean(preds)


def log_mean_blend(preds: Sequence[str], plus_one: bool = True) -> Column:
    """Geometric mean, on log1p or on plain logs."""
    if plus_one:
        return F.expm1(row_mean([F.log1p(F.col(p)) for p in preds]))
    return F.exp(row_mean([F.log(F.col(p)) for p in preds]))


def weighted_blend(preds: Sequence[str], weights: Sequence[float], log: bool = False) -> Column:
    """Weighted sum, on the plain scale or on log1p with a clip at zero."""
    if abs(sum(weights) - 1.0) > WEIGHT_SUM_TOLERANCE:
        print(f"warning: weights sum to {sum(weights):.5f}")
    return blended(preds, weights, log)


def ratio_blend(preds: Sequence[str], ratios: Sequence[float]) -> Column:
    """Ratios from the ratio table on plain logs."""
    return F.exp(row_dot([F.log(F.col(p)) for p in preds], ratios))


def no_zeros(df: DataFrame, preds: Sequence[str]) -> bool:
    """True when every prediction can be logged."""
    zero = reduce(lambda a, b: a | b, [F.col(p) == 0 for p in preds])
    return df.where(zero).limit(1).count() == 0


def kfold_test_mean(
    fold_preds: Sequence[str], area: str | None = None, log: bool = True, per_area: bool = True
) -> Column:
    """Mean over the folds' raw predictions, then back to a price."""
    return target_inverse(row_mean(fold_preds), area, log, per_area)


def subset_mean(preds: Sequence[str], area: str | None = None, log: bool = True) -> Column:
    """Mean of a subset of models, on log1p (optionally per area) or plain."""
    if not log:
        return row_mean(preds)
    if area is None:
        return F.expm1(row_mean([F.log1p(F.col(p)) for p in preds]))
    return F.expm1(row_mean([F.log1p(F.try_divide(F.col(p), F.col(area))) for p in preds])) * F.col(area)


def backward_subset_mean(
    df: DataFrame, y_true: str, preds: Sequence[str], area: str | None = None, log: bool = True
) -> DataFrame:
    """Start with all models, drop the one whose removal scores best, until one is left.

    Every trial is kept: rows (step, models, score). A subset mean is a weight
    vector of equal shares, so the candidates of a step share one scan.
    """
    if not log and area is not None:
        raise ValueError("per-area means are taken on the log scale")
    data = blend_inputs(df, y_true, preds, area, log).persist()

    def score(subsets: list[list[int]]) -> list[float]:
        shares = [np.array([1.0 / len(s) if i in s else 0.0 for i in range(len(preds))]) for s in subsets]
        return [float(e["score"]) for e in evaluate(data, shares, log=log)]

    named = lambda s: ",".join(preds[i] for i in s)
    current = list(range(len(preds)))
    trials = [(0, named(current), score([current])[0])]
    step = 0
    while len(current) > 1:
        step += 1
        subsets = [[p for p in current if p != gone] for gone in current]
        scores = score(subsets)
        trials += [(step, named(s), v) for s, v in zip(subsets, scores)]
        current = subsets[int(np.argmax(scores))]
    data.unpersist()
    return df.sparkSession.createDataFrame(trials, "step int, models string, score double")
