"""Row filters, rare-value nulling and feature-score filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.targets import col
from pricelab.operators.joins import lookup_join
from pricelab.session import materialize


def is_finite(c: Column | str) -> Column:
    v = col(c)
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def finite_only(df: DataFrame, *cols: str) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [is_finite(F.col(c).cast("double")) for c in cols]))


def nan_to_null(df: DataFrame) -> DataFrame:
    """One normalisation for all float columns: NaN becomes null."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("float", "double")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def null_slice(df: DataFrame, column: str, known: bool = False) -> DataFrame:
    return df.where(F.col(column).isNotNull() if known else F.col(column).isNull())


def value_slice(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def segment_filter(df: DataFrame, segment: object, column: str = "price_group_pred") -> DataFrame:
    return df.where(F.col(column) == F.lit(segment))


def fill_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    """Replace nulls (and NaN) of the named columns by constants."""
    return nan_to_null(df).fillna(values)


def rare_values(train: DataFrame, column: str, threshold: int, keep_from: DataFrame | None = None) -> DataFrame:
    """Values seen at most ``threshold`` times in train and never in ``keep_from``.

    Counted in one grouped pass over both frames; a value with many rows is
    pre-aggregated before it moves.
    """
    seen = train.select(F.col(column).alias("value"), F.lit(1).alias("n"))
    if keep_from is not None:
        # A null count marks a value to keep: the marker survives any sum as a flag.
        other = keep_from.select(F.col(column).alias("value"), F.lit(None).cast("int").alias("n"))
        seen = seen.unionByName(other)
    return (
        seen.where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.sum("n").alias("n"), F.count_if(F.col("n").isNull()).alias("kept"))
        .where((F.col("n") <= threshold) & (F.col("kept") == 0))
        .select("value", F.col("n").cast("bigint").alias("n"))
    )


def null_values(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """Set ``column`` to null where its value is listed."""
    marked = lookup_join(df, values.select(F.col("value"), F.lit(True).alias("__rare")), {column: "value"})
    return marked.withColumn(column, F.when(F.col("__rare").isNull(), F.col(column))).drop("__rare")


def null_rare_categories(
    df: DataFrame, column: str, threshold: int = 2, keep_from: DataFrame | None = None
) -> DataFrame:
    return null_values(df, column, materialize(rare_values(df, column, threshold, keep_from)))


def error_within(df: DataFrame, error: str, limits: Sequence[float]) -> DataFrame:
    """Count and share of rows whose absolute error lies below each limit: rows (limit, n, share)."""
    size = F.abs(F.col(error))
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.array(
            *[
                F.struct(F.lit(float(t)).alias("error_limit"), F.count_if(size < F.lit(float(t))).alias("n"))
                for t in limits
            ]
        ).alias("rows"),
    )
    return counts.select("total", F.inline("rows")).select(
        "error_limit", "n", F.try_divide(F.col("n"), F.col("total")).alias("share")
    )


def keep_scored_features(scores: DataFrame, base: str = "none", slack: float = 0.0) -> DataFrame:
    """Features that scored at least ``base - slack`` when shuffled (they may be removed).

    ``scores`` holds one row per feature: feat, avg, folds. Also lists features
    that fall short on average but beat the base in at least one fold.
    """
    b = scores.where(F.col("feat") == base).select(F.col("avg").alias("b_avg"), F.col("folds").alias("b_folds")).first()
    if b is None:
        raise ValueError(f"no score of {base!r} to compare with")
    folds = F.array(*[F.lit(float(v)) for v in b["b_folds"]])
    better = F.exists(F.arrays_zip(F.col("folds").alias("f"), folds.alias("b")), lambda z: z["f"] > z["b"])
    return (
        scores.where(F.col("feat") != base)
        .withColumn("at_base", F.col("avg") >= F.lit(b["b_avg"] - slack))
        .withColumn("one_fold_better", better & ~F.col("at_base"))
        .where(F.col("at_base") | F.col("one_fold_better"))
    )
