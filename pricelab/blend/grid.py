"""Weight grids of any size, numbered: vector ``i`` is computed where it is scored.

The vectors of n weights in units of 1/steps that sum to 1 are the compositions of
``steps`` into n parts, in lexicographic order. Their number tells the parts (the
combinatorial number system), so no list of vectors exists anywhere: a task takes a
range of numbers at a time, turns it into a matrix, and multiplies its Arrow batches
with it. It returns one row of sums per vector, which Spark adds by number; the plan
is the same for ten vectors and for a million.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from pricelab.blend.candidates import blend_inputs
from pricelab.functions.errors import HIT_LIMIT, SMOOTH_SLOPE, SMOOTH_STEEPNESS
from pricelab.operators.metrics import HIT_DECIMALS, HIT_SCALE

# Ship this module's task functions by value: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Vectors multiplied with a batch at a time, and rows of a batch: the product holds so many numbers.
VECTORS, ROWS = 256, 4096
# Vectors whose sums a task holds; larger grids are cut into ranges, each read in a scan of its own.
HELD_VECTORS = 1 << 20

GRID_METRICS = ("score", "mape", "mse", "mae", "msle", "smooth")


def grid_size(n: int, steps: int) -> int:
    return comb(n - 1 + steps, steps)


def unrank(numbers: np.ndarray, n: int, steps: int) -> np.ndarray:
    """Weights of the vectors with these numbers, one row each."""
    rest, left = np.array(numbers, np.int64), np.full(len(numbers), steps, np.int64)
    parts = np.zeros((len(rest), n), np.int64)
    for slot in range(n - 1):
        after = n - slot - 1
        for total in np.unique(left):
            mine = np.flatnonzero(left == total)
            # Vectors whose part here is below 0, 1, ..., total.
            before = np.cumsum([0] + [comb(total - v + after - 1, after - 1) for v in range(total + 1)])
            part = np.searchsorted(before, rest[mine], side="right") - 1
            parts[mine, slot], rest[mine] = part, rest[mine] - before[part]
        left = left - parts[:, slot]
    parts[:, n - 1] = left
    return parts / steps


def score_grid(
    df: DataFrame, y_true: str, preds: Sequence[str], steps: int, metric: str = "score", log: bool = False, best: int | None = None
) -> DataFrame:
    """Rows (weight_id, w1.., metric) of every vector, or of the ``best`` ones only."""
    if metric not in GRID_METRICS:
        raise ValueError(f"metric must be one of {GRID_METRICS}")
    n, total = len(preds), grid_size(len(preds), steps)
    data = blend_inputs(df, y_true, preds, log=log)
    out = None
    for begin in range(0, total, HELD_VECTORS):
        part = _scored(data, n, steps, metric, log, begin, min(total, begin + HELD_VECTORS))
        if best is not None:
            # Each task keeps its best vectors only; the last merge sees a few rows a task.
            part = part.orderBy(F.desc(metric) if metric == "score" else F.asc(metric), "weight_id").limit(best)
        out = part if out is None else out.unionAll(part)
    if best is not None and total > HELD_VECTORS:
        out = out.orderBy(F.desc(metric) if metric == "score" else F.asc(metric), "weight_id").limit(best)
    return _with_weights(out, n, steps, metric)


def _scored(data: DataFrame, n: int, steps: int, metric: str, log: bool, begin: int, end: int) -> DataFrame:
    names = ["rows", "hits", "known", "ape", "value"]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), end - begin))
        seen = False
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                b, seen = batch.slice(at, ROWS), True
                x = np.column_stack([b.column(f"x{i}").to_numpy(zero_copy_only=False) for i in range(n)])
                y = b.column("y").to_numpy(zero_copy_only=False)[:, None]
                for first in range(begin, end, VECTORS):
                    ids = np.arange(first, min(end, first + VECTORS))
                    total[:, ids - begin] += _sums(x @ unrank(ids, n, steps).T, y, metric, log)
        if seen:
            for first in range(begin, end, 1 << 16):
                ids = np.arange(first, min(end, first + (1 << 16)))
                yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(t[ids - begin]) for t in total)], ["weight_id", *names])

    schema = "weight_id long, " + ", ".join(f"{c} double" for c in names)
    sums = data.mapInArrow(partial, schema).groupBy("weight_id").agg(*[F.sum(c).alias(c) for c in names])
    return sums.select("weight_id", _metric(metric).alias(metric))


def _metric(metric: str) -> Column:
    if metric == "score":
        rate = F.bround(F.try_divide("hits", "rows"), HIT_DECIMALS)
        return rate * F.lit(HIT_SCALE) + (F.lit(1.0) - F.try_divide("ape", "known"))
    return F.try_divide("ape" if metric == "mape" else "value", "known")


def _sums(z: np.ndarray, y: np.ndarray, metric: str, log: bool) -> np.ndarray:
    """Per vector: rows, hits, known errors, their sum, and the sum of the metric's own terms."""
    with np.errstate(all="ignore"):
        p = np.maximum(np.expm1(z), 0.0) if log else z
        gap = np.abs(p - y)
        ape = gap / np.abs(y)
        if metric in ("mse", "mae"):
            value = gap * gap if metric == "mse" else gap
        elif metric == "msle":
            value = (np.log1p(p) - np.log1p(y)) ** 2
        else:
            value = 100.0 * (1.0 / (1.0 + np.exp(-SMOOTH_STEEPNESS * (ape - HIT_LIMIT))) + SMOOTH_SLOPE * ape) if metric == "smooth" else ape
        # A price of zero has no percentage error but a plain one.
        known = ~np.isnan(value) & ((y != 0) | (metric in ("mse", "mae", "msle")))
        rows = [np.full(p.shape[1], float(len(p))), (gap <= HIT_LIMIT * y).sum(axis=0), known.sum(axis=0)]
        return np.array([*rows, np.where(known, ape, 0.0).sum(axis=0), np.where(known, value, 0.0).sum(axis=0)], float)


def _with_weights(scored: DataFrame, n: int, steps: int, metric: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            w = unrank(b.column("weight_id").to_numpy(), n, steps)
            yield pa.RecordBatch.from_arrays(
                [b.column("weight_id"), *(pa.array(w[:, k]) for k in range(n)), b.column(metric)], ["weight_id", *(f"w{k + 1}" for k in range(n)), metric]
            )

    return scored.mapInArrow(run, "weight_id long, " + ", ".join(f"w{k + 1} double" for k in range(n)) + f", {metric} double")
