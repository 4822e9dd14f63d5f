"""Imputation, scaling and log transforms; states are a few numbers per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from pricelab.operators.profile import RIGHT_SKEW, skewness_table
from pricelab.operators.quantiles import exact_median

# Fixed value: |skewness| up to which the mean fills gaps, the median beyond.
SYMMETRIC_SKEW = 1.0

# Fixed value: added before the logarithm of a shifted column.
LOG_SHIFT = 0.1


def _moments(df: DataFrame, cols: Sequence[str]) -> dict[str, dict]:
    if not cols:
        return {}
    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.avg(c).alias(f"mean{i}"), F.stddev_samp(c).alias(f"std{i}"),
            F.min(c).alias(f"min{i}"), F.max(c).alias(f"max{i}"),
            F.skewness(c).alias(f"skew{i}"), F.count_if(F.col(c).isNull()).alias(f"gaps{i}"),
        ]
    row = df.agg(*aggs).first()
    return {c: {k: row[f"{k}{i}"] for k in ("mean", "std", "min", "max", "skew", "gaps")} for i, c in enumerate(cols)}


def smallest_mode(df: DataFrame, column: str):
    """Most frequent known value, the smallest on ties."""
    top = (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.desc("__n"), column)
        .first()
    )
    return None if top is None else top[column]


class Imputer:
    """Fill gaps by a given constant or rule (mean, median, mode), else by skewness.

    Columns whose skewness lies in [-1, 1] take the mean, others the median.
    With ``parity`` a column that has gaps counts as skewed and takes the median.
    """

    def __init__(self, parity: bool = False):
        self.parity = parity

    def fit(self, df: DataFrame, cols: Sequence[str], custom: dict[str, object] | None = None) -> "Imputer":
        rules, auto = dict(custom or {}), [c for c in cols if c not in (custom or {})]
        known = _moments(df, [c for c in cols if rules.get(c, "mean") in ("mean", "median")])
        for c in auto:
            skew = known[c]["skew"]
            even = skew is not None and abs(skew) <= SYMMETRIC_SKEW
            rules[c] = "mean" if even and not (self.parity and known[c]["gaps"]) else "median"
        medians = exact_median(df, [c for c in cols if rules[c] == "median"])
        self.values = {}
        for c in cols:
            rule = rules[c]
            if rule == "mean":
                self.values[c] = known[c]["mean"]
            elif rule == "median":
                self.values[c] = medians[c]
            elif rule == "mode":
                self.values[c] = smallest_mode(df, c)
            else:
                self.values[c] = rule
        self.rules = rules
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in self.values.items()})


class _LinearScaler:
    """``(x - center) / scale``, with renamed outputs and an inverse."""

    def transform(self, df: DataFrame, cols: Sequence[str] | None = None, out: Sequence[str] | None = None) -> DataFrame:
        cols = list(cols or self.cols)
        return df.withColumns(
            {o: F.try_divide(F.col(c) - F.lit(m), F.lit(s)) for c, o, m, s in zip(cols, out or cols, self.center, self.scale)}
        )

    def inverse_transform(self, df: DataFrame, cols: Sequence[str] | None = None, out: Sequence[str] | None = None) -> DataFrame:
        cols = list(cols or self.cols)
        return df.withColumns(
            {o: F.col(c) * F.lit(s) + F.lit(m) for c, o, m, s in zip(cols, out or cols, self.center, self.scale)}
        )


class StandardScaler(_LinearScaler):
    """Center on the mean, scale by the sample deviation."""

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "StandardScaler":
        m = _moments(df, cols)
        self.cols = list(cols)
        self.center = [m[c]["mean"] for c in cols]
        self.scale = [m[c]["std"] for c in cols]
        return self


class MedianScaler(_LinearScaler):
    """Center on the median, scale by the sample deviation."""

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "MedianScaler":
        m, medians = _moments(df, cols), exact_median(df, cols)
        self.cols = list(cols)
        self.center = [medians[c] for c in cols]
        self.scale = [m[c]["std"] for c in cols]
        return self


class MinMaxScaler(_LinearScaler):
    """Map the fitted range onto (lo, hi); a constant column keeps the unit slope of the range."""

    def __init__(self, lo: float = 0.0, hi: float = 1.0):
        if not lo < hi:
            raise ValueError("lo must lie below hi")
        self.lo, self.hi = lo, hi

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "MinMaxScaler":
        m = _moments(df, cols)
        self.cols = list(cols)
        width = self.hi - self.lo
        slopes = [width / (m[c]["max"] - m[c]["min"]) if m[c]["max"] != m[c]["min"] else width for c in cols]
        # x * slope + (lo - min * slope), written as (x - center) / scale.
        self.center = [m[c]["min"] - self.lo / k for c, k in zip(cols, slopes)]
        self.scale = [1.0 / k for k in slopes]
        return self


class SkewLog:
    """log10 of right-skewed columns, shifted so that no value is negative."""

    def __init__(self, limit: float = RIGHT_SKEW):
        self.limit = limit

    def fit(self, df: DataFrame, cols: Sequence[str], skewed: Sequence[str] | None = None) -> "SkewLog":
        if skewed is None:
            table = skewness_table(df, cols, self.limit)
            skewed = [r["column"] for r in table.where("right_skewed").collect()]
        self.cols = [c for c in cols if c in set(skewed)]
        m = _moments(df, self.cols)
        self.mins = {c: min(m[c]["min"], 0) for c in self.cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if not self.cols:
            return df
        return df.withColumns({c: shift_log10(c, self.mins[c]) for c in self.cols})


def shift_log10(column: str, low: float):
    """``log10(0.1 + x - low)``; null where that is not positive."""
    return F.log10(F.lit(LOG_SHIFT) + F.col(column) - F.lit(float(low)))
