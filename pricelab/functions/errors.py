"""Per-row errors and losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.targets import col

# Fixed values of the smooth hit curve: steepness, hit limit, linear slope.
SMOOTH_STEEPNESS = 50.0
HIT_LIMIT = 0.1
SMOOTH_SLOPE = 0.1

# Fixed value: weight of residuals inside the band of the banded loss.
BAND_WEIGHT = 0.1

# Fixed value: factor on residuals below zero in the asymmetric loss.
OVERSHOOT_FACTOR = 10.0


def percent_error(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.try_divide(col(y_pred) - col(y_true), col(y_true))


def abs_percent_error(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.try_divide(F.abs(col(y_pred) - col(y_true)), col(y_true))


def is_hit(y_true: Column | str, y_pred: Column | str) -> Column:
    """Within 10 % of the true value; unknown counts as a miss."""
    t, p = col(y_true), col(y_pred)
    within = F.abs(p - t) <= F.lit(HIT_LIMIT) * t
    # NaN compares as the largest value, so a NaN error is a miss unless the truth is NaN too.
    return F.coalesce(within & ~F.isnan(t), F.lit(False))


def error_columns(
    df: DataFrame, y_true: str, y_pred: str, small: float = 0.5, small_log: float = 0.5
) -> DataFrame:
    """Signed percent error, its size, log error, and small-error flags."""
    pe = percent_error(y_true, y_pred)
    log_error = F.log1p(col(y_pred)) - F.log1p(col(y_true))
    return df.withColumns(
        {
            "pe": pe,
            "ape": F.abs(pe),
            "log_error": log_error,
            "small_error": F.coalesce(F.abs(pe) < small, F.lit(False)),
            "small_log_error": F.coalesce(F.abs(log_error) < small_log, F.lit(False)),
        }
    )


def smooth_hit(x: Column | str) -> Column:
    """Differentiable stand-in for missing the 10 % band."""
    v = col(x)
    gate = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-SMOOTH_STEEPNESS) * (v - F.lit(HIT_LIMIT))))
    return gate + F.lit(SMOOTH_SLOPE) * v


def smooth_hit_slope(x: Column | str) -> Column:
    """Derivative of :func:`smooth_hit`."""
    v = col(x)
    gate = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-SMOOTH_STEEPNESS) * (v - F.lit(HIT_LIMIT))))
    return F.lit(SMOOTH_STEEPNESS) * gate * (F.lit(1.0) - gate) + F.lit(SMOOTH_SLOPE)


def banded_sq_error(residual: Column | str, low: float, high: float) -> Column:
    """Squared residual, damped inside ``(low, high)`` and continuous at its edges."""
    r = col(residual)
    sq = r * r
    keep = 1.0 - BAND_WEIGHT
    return (
        F.when(r <= low, sq - F.lit(keep * low**2))
        .when(r >= high, sq - F.lit(keep * high**2))
        .otherwise(sq * F.lit(BAND_WEIGHT))
    )


def asymmetric_sq_error(residual: Column | str) -> Column:
    """Squared residual, ten times as heavy below zero (true minus predicted)."""
    r = col(residual)
    return F.when(r < 0, F.lit(OVERSHOOT_FACTOR) * r * r).otherwise(r * r)


def score_fraction(score: Column | str) -> Column:
    """Fraction part of a packed hit score, which is ``1 - mape``."""
    return F.pmod(col(score), F.lit(1.0))


def score_mape(score: Column | str) -> Column:
    return F.lit(1.0) - score_fraction(score)
