"""Lasso paths for all folds from one scan: second moments per fold, leave-one-fold-out by subtraction.

The rows are read twice in all. The first scan returns, per fold, the sums and
products of inputs and target; every training set is the whole less one fold, so its
moments need no scan of their own. The penalties of a path are then solved on a
matrix of the models' number, with warm starts from the largest penalty down. The
second scan scores the lines of all folds and penalties on their held-out rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from pricelab.functions.errors import HIT_LIMIT
from pricelab.operators.metrics import HIT_DECIMALS, HIT_SCALE

# Ship this module's task functions by value: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Coordinate sweeps before the signs found are tried, and how often that is repeated.
SWEEPS, ROUNDS = 500, 40


@dataclass
class Moments:
    """Count, sums and products of (inputs, target), all less ``shift``."""

    n: float
    sums: np.ndarray
    products: np.ndarray
    shift: np.ndarray

    def __sub__(self, other: "Moments") -> "Moments":
        return Moments(self.n - other.n, self.sums - other.sums, self.products - other.products, self.shift)

    def __add__(self, other: "Moments") -> "Moments":
        return Moments(self.n + other.n, self.sums + other.sums, self.products + other.products, self.shift)

    def centred(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Means, covariance of the inputs, and their covariance with the target."""
        mean = self.sums / self.n
        cov = self.products / self.n - np.outer(mean, mean)
        return mean + self.shift, cov[:-1, :-1], cov[:-1, -1]


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names])


def fold_moments(df: DataFrame, inputs: Sequence[str], target: str, fold: str) -> dict[int, Moments]:
    """Moments per fold in one scan. Rows with a gap are an error, as they have no place in a line."""
    names = [*inputs, target]
    first = df.select(*names).first()
    if first is None:
        return {}
    # Any value near the data serves: it keeps the products from cancelling.
    shift = np.array([0.0 if v is None or not np.isfinite(v) else float(v) for v in first])
    d = len(names)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        gaps: dict[int, int] = {}
        for b in batches:
            rows, folds = _columns(b, names) - shift, np.asarray(b.column("fold"))
            known = np.isfinite(rows).all(axis=1)
            for f in np.unique(folds):
                mine = rows[(folds == f) & known]
                wide = np.column_stack([np.ones(len(mine)), mine])
                held[f] = held.get(f, 0.0) + wide.T @ wide
                gaps[f] = gaps.get(f, 0) + int(((folds == f) & ~known).sum())
        for f, total in held.items():
            yield pa.RecordBatch.from_pydict(
                {"fold": [int(f)] * (d + 1), "i": list(range(d + 1)), "gaps": [gaps[f] if i == 0 else 0 for i in range(d + 1)]}
                | {f"v{j}": total[:, j] for j in range(d + 1)},
                pa.schema([("fold", pa.int64()), ("i", pa.int32()), ("gaps", pa.int64()), *((f"v{j}", pa.float64()) for j in range(d + 1))]),
            )

    schema = "fold long, i int, gaps long, " + ", ".join(f"v{j} double" for j in range(d + 1))
    narrow = df.select(F.col(fold).cast("long").alias("fold"), *[F.col(c).cast("double").alias(c) for c in names])
    sums = narrow.mapInArrow(partial, schema).groupBy("fold", "i").agg(F.sum("gaps").alias("gaps"), *[F.sum(f"v{j}").alias(f"v{j}") for j in range(d + 1)])
    found: dict[int, np.ndarray] = {}
    gaps = 0
    for r in sums.collect():
        found.setdefault(r["fold"], np.zeros((d + 1, d + 1)))[r["i"]] = [r[f"v{j}"] for j in range(d + 1)]
        gaps += r["gaps"]
    if gaps:
        raise ValueError(f"{gaps} rows have gaps in {names}")
    return {f: Moments(m[0, 0], m[0, 1:], m[1:, 1:], shift) for f, m in found.items()}


def lasso_path(cov: np.ndarray, cross: np.ndarray, alphas: Sequence[float]) -> dict[float, np.ndarray]:
    """Coefficients that minimise ``b'Cb / 2 - c'b + alpha |b|_1`` for each penalty."""
    scale = np.diag(cov).copy()
    live = scale > 1e-14 * max(scale.max(initial=0.0), 1e-300)
    out, b = {}, np.zeros(len(cross))
    for alpha in sorted(set(map(float, alphas)), reverse=True):
        if alpha == 0:
            b = np.where(live, 0.0, 0.0)
            b[live] = np.linalg.lstsq(cov[np.ix_(live, live)], cross[live], rcond=None)[0]
        else:
            b = _lasso(cov, cross, alpha, b.copy(), np.flatnonzero(live))
        out[alpha] = b
    return out


def _lasso(cov: np.ndarray, cross: np.ndarray, alpha: float, b: np.ndarray, live: np.ndarray) -> np.ndarray:
    for _ in range(ROUNDS):
        for _ in range(SWEEPS):
            most = 0.0
            for j in live:
                free = cross[j] - cov[j] @ b + cov[j, j] * b[j]
                new = np.sign(free) * max(abs(free) - alpha, 0.0) / cov[j, j]
                most, b[j] = max(most, abs(new - b[j])), new
            if most <= 1e-13:
                break
        # With the signs known the active set is a linear system; collinear models need it, sweeps crawl there.
        exact = _with_signs(cov, cross, alpha, b)
        if exact is not None:
            return exact
    return b


def _with_signs(cov: np.ndarray, cross: np.ndarray, alpha: float, b: np.ndarray) -> np.ndarray | None:
    """The stationary point with the signs of ``b``, if it keeps them and meets the other conditions."""
    active, signs = np.flatnonzero(b), np.sign(b[b != 0])
    out = np.zeros(len(b))
    if len(active):
        out[active] = np.linalg.lstsq(cov[np.ix_(active, active)], cross[active] - alpha * signs, rcond=None)[0]
        if np.any(np.sign(out[active]) != signs):
            return None
    slack = np.abs(cross - cov @ out)
    slack[active] = 0.0
    return out if np.all(slack <= alpha * (1 + 1e-9)) else None


@dataclass
class Line:
    coefficients: np.ndarray
    intercept: float


def lines_of(moments: Moments, alphas: Sequence[float]) -> dict[float, Line]:
    """The fitted line of each penalty on the rows of ``moments``."""
    mean, cov, cross = moments.centred()
    path = lasso_path(cov, cross, alphas)
    return {a: Line(b, float(mean[-1] - mean[:-1] @ b)) for a, b in path.items()}


def held_out_scores(
    df: DataFrame, y_true: str, inputs: Sequence[str], area: str | None, fold: str, lines: dict[int, list[Line]]
) -> dict[int, list[float]]:
    """Packed hit score of each fold's lines on that fold's rows, all in one scan."""
    weights = {f: (np.array([l.coefficients for l in ls]).T, np.array([l.intercept for l in ls])) for f, ls in lines.items()}
    schema = "fold long, k int, n double, hits double, known double, ape double"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            x, folds = _columns(b, inputs), np.asarray(b.column("fold"))
            y, a = _columns(b, ["y"]), _columns(b, ["a"])
            for f in np.unique(folds):
                at = folds == f
                w, intercept = weights[int(f)]
                with np.errstate(all="ignore"):
                    price = np.expm1(x[at] @ w + intercept) * a[at]
                    gap = np.abs(price - y[at])
                    ape = gap / np.abs(y[at])
                    known = np.isfinite(ape)
                    sums = [np.full(w.shape[1], float(at.sum())), (gap <= HIT_LIMIT * y[at]).sum(axis=0), known.sum(axis=0), np.where(known, ape, 0.0).sum(axis=0)]
                held[int(f)] = held.get(int(f), 0.0) + np.array(sums, float)
        for f, sums in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([f] * sums.shape[1], pa.int64()), pa.array(range(sums.shape[1]), pa.int32()), *map(pa.array, sums)],
                ["fold", "k", "n", "hits", "known", "ape"],
            )

    factor = F.lit(1.0) if area is None else F.col(area).cast("double")
    narrow = df.select(
        F.col(fold).cast("long").alias("fold"), F.col(y_true).cast("double").alias("y"), factor.alias("a"), *[F.col(c).cast("double").alias(c) for c in inputs]
    )
    sums = narrow.mapInArrow(partial, schema).groupBy("fold", "k").agg(*[F.sum(c).alias(c) for c in ("n", "hits", "known", "ape")])
    out = {f: [float("nan")] * len(ls) for f, ls in lines.items()}
    for r in sums.collect():
        # Half to even, like the aggregate of that name.
        rate = float(np.round(r["hits"] / r["n"], HIT_DECIMALS))
        out[r["fold"]][r["k"]] = rate * HIT_SCALE + (1.0 - r["ape"] / r["known"]) if r["known"] else float("nan")
    return out


def path_conditions(df: DataFrame, inputs: Sequence[str], target: str, lines: dict[float, Line], tol: float = 1e-7) -> DataFrame:
    """Rows (alpha, input, coefficient, optimal): whether each coefficient meets the optimality conditions over all rows of ``df``.

    The slope of the squared error at a coefficient that is not zero equals the penalty
    against its sign; at zero it is no larger than the penalty.
    """
    slopes = []
    for k, line in enumerate(lines.values()):
        fitted = F.lit(line.intercept)
        for c, w in zip(inputs, line.coefficients):
            fitted = fitted + F.lit(float(w)) * F.col(c)
        gap = F.col(target) - fitted
        slopes += [F.avg(gap * F.col(c)).alias(f"s{k}_{j}") for j, c in enumerate(inputs)]
    cells = []
    for k, (alpha, line) in enumerate(lines.items()):
        for j, w in enumerate(line.coefficients):
            slope = F.col(f"s{k}_{j}")
            wanted = F.lit(float(np.sign(w) * alpha))
            ok = F.abs(slope - wanted) <= tol if w else F.abs(slope) <= alpha + tol
            cells.append(F.struct(F.lit(float(alpha)).alias("alpha"), F.lit(inputs[j]).alias("input"), F.lit(float(w)).alias("coefficient"), ok.alias("optimal")))
    return df.agg(*slopes).select(F.inline(F.array(*cells)))
