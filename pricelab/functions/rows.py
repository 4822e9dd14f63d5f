"""Reductions across the columns of one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from pricelab.functions.targets import col


def row_mean(cols: Sequence[Column | str]) -> Column:
    """Mean of the known values; null when none is known."""
    cs = [col(c) for c in cols]
    total = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cs])
    known = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cs])
    return F.try_divide(total, known)


def row_dot(cols: Sequence[Column | str], weights: Sequence[float]) -> Column:
    """Weighted sum; null when any value is null."""
    if len(cols) != len(weights):
        raise ValueError(f"{len(cols)} columns but {len(weights)} weights")
    return reduce(lambda a, b: a + b, [F.lit(float(w)) * col(c) for c, w in zip(cols, weights)])


def row_vote(cols: Sequence[Column | str]) -> Column:
    """Most frequent value of the row, the smallest on ties."""
    cs = [col(c) for c in cols]
    votes = [(reduce(lambda a, b: a + b, [F.coalesce((o == c).cast("int"), F.lit(0)) for o in cs]), c) for c in cs]
    # Larger vote first, then the smaller value: order by (-votes, value).
    ballots = F.array(*[F.when(c.isNotNull(), F.struct((-n).alias("n"), c.alias("v"))) for n, c in votes])
    return F.array_min(F.array_compact(ballots))["v"]
