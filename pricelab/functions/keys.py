"""Keys, casts and deterministic hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.targets import col

# Fixed value: text that stands for a missing part of a composed key.
MISSING_TEXT = "nan"


def compose_key(*parts: Column | str) -> Column:
    """``city-town-village`` style key; missing parts become ``nan``."""
    return F.concat_ws("-", *[F.coalesce(col(p).cast("string"), F.lit(MISSING_TEXT)) for p in parts])


def compose_place_keys(df: DataFrame, city: str = "city", town: str = "town", village: str = "village") -> DataFrame:
    """Rewrite town as city-town and village as city-town-village."""
    town_key = compose_key(city, town)
    return df.withColumns({town: town_key, village: compose_key(town_key, village)})


def category_to_int(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def add_intercept(df: DataFrame, name: str = "constant_1") -> DataFrame:
    return df.withColumn(name, F.lit(1.0))


def seeded_text(seed: int | str, *parts: Column | str) -> Column:
    """md5 of ``seed:part:part``: a shuffle key that any engine can reproduce."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(p).cast("string") for p in parts]))


def seeded_bucket(seed: int | str, key: Column | str, k: int) -> Column:
    """Stable bucket 0..k-1 from the first 32 bits of the seeded hash."""
    head = F.conv(F.substring(seeded_text(seed, key), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(k)).cast("int")
