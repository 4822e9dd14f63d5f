"""Target transforms and their inverses, area and floor ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: log price per area above which a sale counts as expensive.
EXPENSIVE_LOG_PRICE_PER_AREA = 13.45

# Fixed value: mean length of a year in days.
DAYS_PER_YEAR = 365.25


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def target_column(log: bool, per_area: bool) -> str:
    """Name of the target variant produced by :func:`target_transform`."""
    return ("log_" if log else "") + ("per_area_" if per_area else "") + "total_price"


def target_transform(df: DataFrame, price: str = "total_price", area: str = "building_area") -> DataFrame:
    """Add the log, per-area and log-per-area variants of the price."""
    per_area = F.try_divide(F.col(price), F.col(area))
    return df.withColumns(
        {
            "log_total_price": F.log1p(F.col(price)),
            "per_area_total_price": per_area,
            "log_per_area_total_price": F.log1p(per_area),
        }
    )


def target_inverse(
    pred: Column | str, area: Column | str | None = None, log: bool = True, per_area: bool = True
) -> Column:
    """Back to a price: undo the log (clipped at zero), then multiply by area.

    Predictions on the plain scale are not clipped.
    """
    out = col(pred)
    if log:
        out = F.greatest(F.expm1(out), F.lit(0.0))
    if per_area:
        if area is None:
            raise ValueError("per-area predictions need the area column")
        out = out * col(area)
    return out


def area_ratio(building: Column | str, land: Column | str) -> Column:
    return F.try_divide(col(building), col(land))


def height_ratio(floor: Column | str, total: Column | str) -> Column:
    return F.try_divide(col(floor).cast("double"), col(total).cast("double"))


def top_floor(floor: Column | str, total: Column | str) -> Column:
    """True only when both floors are known and equal."""
    return F.coalesce(col(floor) == col(total), F.lit(False))


def building_age_years(day_diff: Column | str) -> Column:
    return F.floor(col(day_diff) / F.lit(DAYS_PER_YEAR))


def threshold_flag(log_price_per_area: Column | str, cut: float = EXPENSIVE_LOG_PRICE_PER_AREA) -> Column:
    """1 above the cut, 0 otherwise (unknown prices count as 0)."""
    return F.coalesce(col(log_price_per_area) > F.lit(cut), F.lit(False)).cast("int")
