"""Co-moments of all pairs of columns, each over the rows where both are known, in one scan."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

# Task functions travel by value, so that workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MOMENTS = "a int, b int, n double, bad double, mean_a double, mean_b double, m2_a double, m2_b double, c double"


def batch_moments(x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, ...]:
    """(n, bad, mean_a, mean_b, m2_a, m2_b, c) as matrices over column pairs (a, b) of one batch.

    ``bad`` counts the rows of a pair in which either value is not finite. Values are
    centred by column first, so products of large numbers don't cancel; a constant
    column is centred to exact zeros.
    """
    finite = np.isfinite(x)
    mask, odd = known.astype(float), (known & ~finite).astype(float)
    start = x[np.argmax(known & finite, axis=0), np.arange(x.shape[1])]
    start = np.where(np.isfinite(start), start, 0.0)
    good = known & finite
    x = np.where(good, x - start, 0.0)
    centre = x.sum(axis=0) / np.maximum(good.sum(axis=0), 1)
    x = np.where(good, x - centre, 0.0)
    n = mask.T @ mask
    bad = odd.T @ mask + mask.T @ odd
    sums, squares, c = x.T @ mask, (x * x).T @ mask, x.T @ x
    mean = sums / np.maximum(n, 1)
    m2 = np.maximum(squares - sums * mean, 0.0)
    base = (start + centre)[:, None]
    return n, bad, base + mean, base.T + mean.T, m2, m2.T, c - mean * mean.T * n


def merged(one: tuple[np.ndarray, ...], two: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """Moments of the rows of both."""
    n = one[0] + two[0]
    share = two[0] / np.maximum(n, 1)
    # An empty side has no mean of its own.
    da = np.where((one[0] > 0) & (two[0] > 0), two[2] - one[2], 0.0)
    db = np.where((one[0] > 0) & (two[0] > 0), two[3] - one[3], 0.0)
    weight = one[0] * share
    start = [np.where(one[0] > 0, one[i], two[i]) for i in (2, 3)]
    return (
        n, one[1] + two[1], start[0] + da * share, start[1] + db * share,
        one[4] + two[4] + da * da * weight, one[5] + two[5] + db * db * weight, one[6] + two[6] + da * db * weight,
    )


def _task_moments(batches):
    total = None
    for batch in batches:
        if batch.num_rows:
            known = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
            x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
            found = batch_moments(x, known)
            total = found if total is None else merged(total, found)
    if total is None:
        return
    for a in range(len(total[0]) - 1):
        b = np.arange(a + 1, len(total[0]), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(b), a, np.int32)), pa.array(b), *[pa.array(m[a, b]) for m in total]],
            [f.split(" ")[0] for f in _MOMENTS.split(", ")],
        )


def pair_moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row (a, b, n, bad, m2_a, m2_b, c) per pair of column numbers a < b, pairs without rows too.

    Each task merges its batches and gives one row per pair; a pair's rows are
    merged around their common mean.
    """
    spark, k = df.sparkSession, len(cols)
    numbers = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)]
    parts = df.select(*numbers).mapInArrow(_task_moments, _MOMENTS)
    # Every pair exists, also without a batch.
    pairs = spark.range(k * k).select(F.expr(f"cast(id div {k} as int)").alias("a"), F.expr(f"cast(id % {k} as int)").alias("b")).where("a < b")
    none = pairs.select("a", "b", *[F.lit(0.0).alias(f.split(" ")[0]) for f in _MOMENTS.split(", ")[2:]])
    w = Window.partitionBy("a", "b")

    def off_mean(name: str):
        """A part's mean less the mean of all, counted from the least, so that equal means differ by exact zeros."""
        least = F.min(F.when(F.col("n") > 0, F.col(name))).over(w)
        ahead = F.when(F.col("n") > 0, F.col(name) - least).otherwise(0.0)
        return ahead - F.sum(F.col("n") * ahead).over(w) / F.greatest(F.sum("n").over(w), F.lit(1.0))

    centred = parts.unionByName(none).select("*", off_mean("mean_a").alias("da"), off_mean("mean_b").alias("db"))
    n = F.col("n")
    return centred.groupBy("a", "b").agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum(F.col("m2_a") + n * F.col("da") * F.col("da")).alias("m2_a"),
        F.sum(F.col("m2_b") + n * F.col("db") * F.col("db")).alias("m2_b"), F.sum(F.col("c") + n * F.col("da") * F.col("db")).alias("c"),
    )
