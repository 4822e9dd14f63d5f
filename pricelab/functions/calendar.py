"""Calendar fields of integer day counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.targets import DAYS_PER_YEAR, col

# Mean days per month and per quarter of a 365-day year.
DAYS_PER_MONTH = 30.4167
DAYS_PER_QUARTER = 91.25


def calendar_fields(days: Column | str) -> dict[str, Column]:
    d = col(days)
    in_year = F.pmod(d, F.lit(365))
    return {
        "dow": F.pmod(d, F.lit(7)).cast("int"),
        "day_in_year": in_year.cast("int"),
        "month": F.floor(in_year / F.lit(DAYS_PER_MONTH)).cast("int"),
        "quarter": F.floor(in_year / F.lit(DAYS_PER_QUARTER)).cast("int"),
        "year": F.floor(d / F.lit(DAYS_PER_YEAR)).cast("int"),
    }


def calendar_features(df: DataFrame, day_col: str) -> DataFrame:
    """Add ``dow_<c>``, ``day_in_year_<c>``, ``month_<c>``, ``quarter_<c>``, ``year_<c>``."""
    return df.withColumns({f"{k}_{day_col}": v for k, v in calendar_fields(day_col).items()})


def day_diff(later: Column | str, earlier: Column | str) -> Column:
    return col(later) - col(earlier)


def bucket_trunc(days: Column | str, width: int) -> Column:
    """Whole weeks (7) or months (30), truncated toward zero."""
    return (col(days) / F.lit(float(width))).cast("int")


def days_since(ts: Column | str, epoch: str = "1995-01-01") -> Column:
    """Day count of a timestamp, for tables that carry real dates."""
    return F.datediff(col(ts).cast("date"), F.lit(epoch).cast("date"))
