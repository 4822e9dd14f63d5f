"""Score many weight vectors in one pass.

A search tries dozens of vectors over dozens of models per pass. Written as
aggregate expressions that is thousands of terms, beyond what generated code
holds, so each task multiplies its Arrow batches with the candidate matrix and
returns one row of sums per candidate. The sums of all tasks are added by a
grouped aggregate keyed by candidate; no data rows move.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from pricelab.functions.errors import HIT_LIMIT, SMOOTH_SLOPE, SMOOTH_STEEPNESS
from pricelab.operators.metrics import HIT_SCALE

# Ship this module's task functions by value: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOSSES = ("mape", "mse", "mae", "smooth")


def blend_inputs(
    df: DataFrame, y_true: str, preds: Sequence[str], area: str | None = None, log: bool = True, fold: str | None = None
) -> DataFrame:
    """Columns y, a, x0.. and, if named, fold: truth, area factor and the (log) predictions."""
    factor = F.lit(1.0) if area is None else F.col(area).cast("double")
    xs = [F.col(p).cast("double") for p in preds]
    if log:
        xs = [F.log1p(F.try_divide(x, factor)) for x in xs]
    return df.select(
        F.col(y_true).cast("double").alias("y"), factor.alias("a"), *[x.alias(f"x{i}") for i, x in enumerate(xs)],
        *([] if fold is None else [F.col(fold).cast("long").alias("fold")]),
    )


def evaluate(
    data: DataFrame, points: Sequence[np.ndarray], loss: str = "mape", log: bool = True, slopes: bool = False
) -> list[dict]:
    """Loss, packed score, mape and (optionally) slope of every weight vector.

    Vectors one longer than the predictions carry an intercept last.
    """
    sums = candidate_sums(data, points, loss, log, slopes)
    return [summary(w, sums[0, k]) for k, w in enumerate(points)]


def candidate_sums(
    data: DataFrame, points: Sequence[np.ndarray], loss: str = "mape", log: bool = True, slopes: bool = False, by_fold: bool = False
) -> dict[tuple[int, int], np.ndarray]:
    """Sums of every vector over all rows (fold 0), or per value of the column ``fold``, in one scan."""
    if loss not in LOSSES:
        raise ValueError(f"loss must be one of {LOSSES}")
    weights = np.array([np.asarray(p, dtype=float) for p in points])
    n_x = sum(1 for c in data.columns if c.startswith("x"))
    dim = weights.shape[1]
    names = ["n", "known", "hits", "ape", "loss"] + [f"g{j}" for j in range(dim if slopes else 0)]
    schema = "fold long, k int, " + ", ".join(f"{c} double" for c in names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {} if by_fold else {0: np.zeros((len(names), len(weights)))}
        for b in batches:
            cols = {c: b.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(b.schema.names)}
            x = np.column_stack([cols[f"x{i}"] for i in range(n_x)] + [np.ones(b.num_rows)] * (dim - n_x))
            folds = cols["fold"] if by_fold else np.zeros(b.num_rows, np.int64)
            for f in np.unique(folds):
                at = folds == f
                part = _sums(weights, x[at], cols["y"][at, None], cols["a"][at, None], loss, log, slopes)
                held[int(f)] = held.get(int(f), 0.0) + part
        for f, total in held.items():
            arrays = [pa.array([f] * len(weights), pa.int64()), pa.array(np.arange(len(weights)), pa.int32())] + [pa.array(t) for t in total]
            yield pa.RecordBatch.from_arrays(arrays, names=["fold", "k", *names])

    sums = data.mapInArrow(partial, schema).groupBy("fold", "k").agg(*[F.sum(c).alias(c) for c in names])
    return {(r["fold"], r["k"]): np.array([r[c] for c in names], float) for r in sums.collect()}


def summary(w: np.ndarray, sums: np.ndarray) -> dict:
    """Loss, packed score, mape and slope of a vector from its sums."""
    n, known, hits, ape, loss = sums[:5]
    known = known or np.nan
    rate = float(np.round(hits / n, 4)) if n else np.nan
    grad = sums[5:] / known if len(sums) > 5 else None
    return {"w": np.asarray(w, float), "loss": loss / known, "mape": ape / known, "score": rate * HIT_SCALE + (1.0 - ape / known), "grad": grad}


def second_moments(data: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean products of the inputs, and of the inputs with the log truth, in one pass."""
    n, total = fold_products(data, dim).get(0, (0, np.zeros((dim + 1, dim))))
    mean = total / max(n, 1)
    return mean[:dim], mean[dim]


def fold_products(data: DataFrame, dim: int, by_fold: bool = False) -> dict[int, tuple[int, np.ndarray]]:
    """Rows without gaps and their products (inputs and log truth by inputs), over all rows (fold 0) or per fold."""
    n_x = sum(1 for c in data.columns if c.startswith("x"))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            cols = {c: b.column(i).to_numpy(zero_copy_only=False) for i, c in enumerate(b.schema.names)}
            x = np.column_stack([cols[f"x{i}"] for i in range(n_x)] + [np.ones(b.num_rows)] * (dim - n_x))
            with np.errstate(all="ignore"):
                t = np.log1p(cols["y"] / cols["a"])
            ok = np.isfinite(x).all(axis=1) & np.isfinite(t)
            folds = cols["fold"] if by_fold else np.zeros(b.num_rows, np.int64)
            for f in np.unique(folds):
                at = ok & (folds == f)
                mine = held.setdefault(int(f), [0, np.zeros((dim + 1, dim))])
                mine[0] += int(at.sum())
                mine[1] += np.column_stack([x[at], t[at]]).T @ x[at]
        for f, (n, total) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * (dim + 1), pa.int64()), pa.array(np.arange(dim + 1), pa.int32()), pa.array([n] * (dim + 1), pa.int64())]
                + [pa.array(c) for c in total.T],
                names=["fold", "i", "n", *[f"v{j}" for j in range(dim)]],
            )

    schema = "fold long, i int, n bigint, " + ", ".join(f"v{j} double" for j in range(dim))
    sums = data.mapInArrow(partial, schema).groupBy("fold", "i").agg(F.sum("n").alias("n"), *[F.sum(f"v{j}").alias(f"v{j}") for j in range(dim)])
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in sums.collect():
        n, total = out.get(r["fold"], (r["n"], np.zeros((dim + 1, dim))))
        total[r["i"]] = [r[f"v{j}"] for j in range(dim)]
        out[r["fold"]] = (r["n"], total)
    return out


def _sums(weights, x, y, a, loss, log, slopes):
    with np.errstate(all="ignore"):
        z = x @ weights.T
        p = np.maximum(np.expm1(z) * a, 0.0) if log else z
        gap = p - y
        ape = np.abs(gap) / y
        ok = np.isfinite(y) & (y != 0) & ~np.isnan(p)
        side = np.sign(gap)
        if loss == "mape":
            value, slope = ape, side / y
        elif loss == "mse":
            value, slope = gap * gap, 2.0 * gap
        elif loss == "mae":
            value, slope = np.abs(gap), side
        else:
            gate = 1.0 / (1.0 + np.exp(-SMOOTH_STEEPNESS * (ape - HIT_LIMIT)))
            value = 100.0 * (gate + SMOOTH_SLOPE * ape)
            slope = 100.0 * (SMOOTH_STEEPNESS * gate * (1.0 - gate) + SMOOTH_SLOPE) * side / y
        rows = [
            np.full(p.shape[1], float(len(p))),
            ok.sum(axis=0).astype(float),
            (np.abs(gap) <= HIT_LIMIT * y).sum(axis=0).astype(float),
            np.where(ok, ape, 0.0).sum(axis=0),
            np.where(ok, value, 0.0).sum(axis=0),
        ]
        if slopes:
            chain = slope * np.exp(z) * a if log else slope
            rows += list((np.where(ok, chain, 0.0).T @ np.where(np.isnan(x), 0.0, x)).T)
    return np.array(rows)
