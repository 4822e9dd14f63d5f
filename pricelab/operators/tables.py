"""Set operations, top-k, distinct rows and search-result tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.keys import seeded_text
from pricelab.operators.joins import count_compare, lookup_join
from pricelab.session import BROADCAST_ROWS, materialize


def preview(df: DataFrame, order: Sequence[str], n: int = 5, tail: bool = False) -> DataFrame:
    """First or last n rows of an order, as a top-k without a full sort."""
    keys = [F.col(c).desc() if tail else F.col(c).asc() for c in order]
    return df.orderBy(*keys).limit(n)


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows in seeded hash order: a reproducible sample."""
    return df.orderBy(seeded_text(seed, key), key).limit(n)


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def select_features(
    every: Sequence[str], add: Sequence[str] = (), remove: Sequence[str] = ()
) -> list[str]:
    """Column-set algebra that keeps the given order and drops repeats."""
    gone = set(remove)
    return [c for c in dict.fromkeys([*every, *add]) if c not in gone]


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Columns of a naming block, such as ``^XIV_\\d+$``."""
    return [c for c in df.columns if re.search(pattern, c)]


def rename_drop(df: DataFrame, rename: dict[str, str], drop: Sequence[str] = ()) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(rename)


def last_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Latest row per key under the order columns, without a window or a sort per key.

    With few keys the latest first order value per key (a plain hash aggregate)
    is broadcast and filters the rows, so only ties reach the row-valued
    aggregate.
    """
    peaks = materialize(df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order[0]).alias("__peak")))
    n = peaks.count()
    rows = df.where(F.col(key).isNotNull())
    if n <= BROADCAST_ROWS:
        rows = lookup_join(rows, peaks, {key: key}, n).where(F.col(order[0]).eqNullSafe(F.col("__peak"))).drop("__peak")
    rest = [c for c in df.columns if c != key]
    latest = F.max_by(F.struct(*rest), F.struct(*order))
    return rows.groupBy(key).agg(latest.alias("r")).select(key, "r.*")


def first_distinct(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct()


def unique_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def union_rows(*frames: DataFrame) -> DataFrame:
    """Row concatenation that keeps duplicates; absent columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def category_diff(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """Values with their row counts, marked train_only, test_only or shared."""
    t, s = F.col("train"), F.col("test")
    side = F.when(s.isNull(), F.lit("train_only")).when(t.isNull(), F.lit("test_only")).otherwise(F.lit("shared"))
    return count_compare(train, test, column, "full").select(
        "value", side.alias("side"), F.coalesce(t, F.lit(0)).alias("train"), F.coalesce(s, F.lit(0)).alias("test")
    )


def top_results(results: DataFrame, k: int, score: str = "score", tie: Sequence[str] = ()) -> DataFrame:
    return results.orderBy(F.desc(score), *tie).limit(k)


def drop_top_n_features(importance: DataFrame, n: int, base: str = "none", keep_base_slot: bool = False) -> list[str]:
    """Names of the n features whose shuffling hurts least.

    ``keep_base_slot`` takes n+1 rows first and then leaves out the base row.
    """
    if keep_base_slot:
        names = [r["feat"] for r in importance.orderBy(F.desc("diff"), "feat").limit(n + 1).collect()]
        return [x for x in names if x != base]
    kept = importance.where(F.col("feat") != base).orderBy(F.desc("diff"), "feat").limit(n)
    return [r["feat"] for r in kept.collect()]


def best_per_setting(results: DataFrame, param: str, score: str = "score") -> DataFrame:
    """Best score for each value of one searched parameter."""
    return results.groupBy(F.col("params")[param].alias(param)).agg(F.max(score).alias("best"))


def history_at(results: DataFrame, histories: str, metrics: Sequence[str], epochs: str) -> DataFrame:
    """Metrics at the rounded mean best epoch: mean and population deviation over folds.

    ``histories`` is an array (one per fold) of maps metric -> values per epoch.
    """
    epoch = F.bround(F.col(epochs)).cast("int")
    out = {"epoch": epoch}
    for m in metrics:
        at = _at_epoch(histories, m, epoch)
        out[f"mean_{m}"] = array_mean(at)
        out[f"std_{m}"] = F.sqrt(array_mean(_squared_deviations(at)))
    return results.withColumns(out)


def _at_epoch(histories: str, metric: str, epoch: Column) -> Column:
    return F.transform(F.col(histories), lambda h: F.element_at(F.element_at(h, F.lit(metric)), epoch))


def _squared_deviations(values: Column) -> Column:
    mean = array_mean(values)
    return F.transform(values, lambda v: (v - mean) * (v - mean))


def array_mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v, lambda a: a / F.size(values))


def merge_results(*rounds: DataFrame, order: Sequence[str], descending: bool = True) -> DataFrame:
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    return union_rows(*rounds).orderBy(*keys)
