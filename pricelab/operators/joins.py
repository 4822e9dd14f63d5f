"""Joins: state lookups, prediction tables, folds, nearest value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricelab.operators.ranks import layout_partition, ordered_layout, per_partition_literal
from pricelab.session import BROADCAST_ROWS, materialize, shuffle_width

# A key is hot when it holds more than this part of one shuffle partition's fair share.
_HOT_SHARE = 0.25


def lookup_join(df: DataFrame, state: DataFrame, on: dict[str, str], rows: int | None = None) -> DataFrame:
    """Left join of a table with one row per key, safe for hot keys.

    The state is counted (pass ``rows`` when known). Small: broadcast, no
    shuffle. Larger: a shuffle join in which the rows of hot keys take their
    state from a broadcast of those few keys and are dealt evenly to all tasks.
    """
    keys = {left: f"__k{i}" for i, left in enumerate(on)}
    side = state.withColumnsRenamed({right: keys[left] for left, right in on.items()})
    if rows is None:
        rows = side.count()
    cond = [F.col(left) == F.col(k) for left, k in keys.items()]
    if rows <= BROADCAST_ROWS:
        return df.join(F.broadcast(side), cond, "left").drop(*keys.values())
    return _shuffled_lookup(df, side, keys, cond)


def _shuffled_lookup(df: DataFrame, side: DataFrame, keys: dict[str, str], cond: list[Column]) -> DataFrame:
    width = shuffle_width(df.sparkSession)
    counts = materialize(df.groupBy(*[F.col(left).alias(k) for left, k in keys.items()]).agg(F.count(F.lit(1)).alias("__n")))
    total = counts.agg(F.sum("__n")).first()[0] or 0
    # Fewer than width / share keys can exceed the limit, whatever the data.
    hot_keys = counts.where(F.col("__n") > _HOT_SHARE * total / width).drop("__n")
    hot_keys = materialize(hot_keys.dropna())
    fields = [c for c in side.columns if c not in keys.values()]
    names = list(keys.values())
    cold = side.join(F.broadcast(hot_keys), names, "left_anti").withColumn("__deal", F.lit(0))
    hot = hot_keys.join(side, names, "left").select(*names, F.struct(*fields).alias("__hot"))
    flagged = df.join(F.broadcast(hot), cond, "left").drop(*names)
    # Hot and unknown keys meet no cold row, so any task may take them.
    free = F.col("__hot").isNotNull()
    for left in keys:
        free = free | F.col(left).isNull()
    deal = F.when(free, F.pmod(F.xxhash64(*df.columns), F.lit(width)).cast("int") + 1).otherwise(F.lit(0))
    joined = flagged.withColumn("__d", deal).join(cold, [*cond, F.col("__d") == F.col("__deal")], "left")
    picked = {f: F.when(F.col("__hot").isNotNull(), F.col("__hot")[f]).otherwise(F.col(f)) for f in fields}
    return joined.withColumns(picked).drop(*names, "__hot", "__d", "__deal")


def lookup_encode(df: DataFrame, column: str, state: DataFrame, code: str, out: str, default: object) -> DataFrame:
    """Map a column through ``state(value, code)``; unseen values take the default."""
    mapped = lookup_join(
        df, state.select(F.col("value"), F.col(code).alias("__code")), {column: "value"}
    )
    return mapped.withColumn(out, F.coalesce(F.col("__code"), F.lit(default))).drop("__code")


def join_predictions(
    preds: DataFrame, models: Sequence[int], key: str = "building_id", value: str = "y_pred", prefix: str = "pred_"
) -> DataFrame:
    """Inner join of many models' outputs on the id, from the long table.

    One grouped pivot (a single shuffle) in place of a join per model; ids
    missing any model are dropped, as an inner join would. Two rows of one model
    and id are an error.
    """
    twice = F.raise_error(F.concat(F.lit("several predictions of one model and "), F.lit(key)))
    only = F.when(F.count(value) > 1, twice.cast("double")).otherwise(F.max(value))
    wide = (
        preds.where(F.col("model_id").isin(list(models)))
        .groupBy(key)
        .pivot("model_id", list(models))
        .agg(only)
        .withColumnsRenamed({str(m): f"{prefix}{m}" for m in models})
    )
    return wide.dropna(subset=[f"{prefix}{m}" for m in models])


def attach_left(df: DataFrame, other: DataFrame, key: str, require: Sequence[str] = ()) -> DataFrame:
    """Left join on the key; ``require`` names columns that must be known on every row."""
    out = df.join(other, key, "left")
    if require:
        broken = out.where(" or ".join(f"`{c}` is null" for c in require)).limit(1).count()
        if broken:
            raise ValueError(f"join on {key} left nulls in {list(require)}")
    return out


def missing_after_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` that the left join would leave without a partner."""
    return df.join(other, key, "left_anti")


def fold_val(df: DataFrame, fold: int, ids: DataFrame | None = None, key: str = "building_id") -> DataFrame:
    """Validation rows: by the fold column, or by a semi join with the fold's ids."""
    if ids is None:
        return df.where(F.col("fold") == fold)
    return df.join(ids.where(F.col("fold") == fold), key, "left_semi")


def fold_train(df: DataFrame, fold: int, ids: DataFrame | None = None, key: str = "building_id") -> DataFrame:
    if ids is None:
        return df.where(F.col("fold") != fold)
    return df.join(ids.where(F.col("fold") == fold), key, "left_anti")


def whitelist_join(df: DataFrame, kept: DataFrame, key: str = "building_id") -> DataFrame:
    return df.join(kept.select(key), key, "left_semi")


def count_compare(train: DataFrame, test: DataFrame, column: str, how: str = "left") -> DataFrame:
    """Rows (value, train, test): counts side by side, in one grouped pass.

    ``left`` keeps values seen in train, ``full`` keeps all; absent counts are null.
    """
    both = train.select(F.col(column).alias("value"), F.lit(True).alias("t")).unionByName(
        test.select(F.col(column).alias("value"), F.lit(False).alias("t"))
    )
    counted = (
        both.where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count_if("t").alias("train"), F.count_if(~F.col("t")).alias("test"))
    )
    if how == "left":
        counted = counted.where(F.col("train") > 0)
    return counted.select("value", F.nullif("train", F.lit(0)).alias("train"), F.nullif("test", F.lit(0)).alias("test"))


def align_check(a: DataFrame, b: DataFrame, key: str = "building_id") -> DataFrame:
    """One row (only_a, only_b, aligned): do both frames hold the same ids, each as often?"""
    tagged = a.select(F.col(key), F.lit(1).alias("d")).unionByName(b.select(F.col(key), F.lit(-1).alias("d")))
    net = tagged.groupBy(key).agg(F.sum("d").alias("d"))
    return net.agg(
        F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).alias("only_a"),
        F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).alias("only_b"),
    ).withColumn("aligned", (F.col("only_a") == 0) & (F.col("only_b") == 0))


def paste_columns(df: DataFrame, derived: DataFrame, key: str = "building_id") -> DataFrame:
    """Attach derived columns by id (row positions carry no meaning in a DataFrame)."""
    extra = [c for c in derived.columns if c == key or c not in df.columns]
    return df.join(derived.select(*extra), key)


def nearest_value_join(
    queries: DataFrame, value: str, observed: DataFrame, observed_value: str, key: str, out: str = "nearest"
) -> DataFrame:
    """Snap each value to the closest observed one, the lower on ties.

    Observed values and queries share one range layout, with the id as last sort
    key so repeated values spread out. Inside a partition the last observed value
    from each side is carried along; the best value of neighbouring partitions
    comes from one small min/max per partition.
    """
    payload = queries.columns
    points = observed.select(F.col(observed_value).cast("double").alias("__x")).where(
        F.col("__x").isNotNull() & ~F.isnan("__x")
    ).distinct()
    seen = points.withColumn("__obs", F.lit(0))
    asked = queries.withColumns({"__x": F.col(value).cast("double"), "__obs": F.lit(1)})
    both = asked.unionByName(seen, allowMissingColumns=True)
    laid = ordered_layout(both, ["__x", "__obs", key])

    price = F.when(F.col("__obs") == 0, F.col("__x"))
    edges = laid.groupBy(layout_partition().alias("p")).agg(F.min(price).alias("lo"), F.max(price).alias("hi")).collect()
    width = max((r["p"] for r in edges), default=-1) + 1
    lows, highs = [None] * width, [None] * width
    for r in edges:
        lows[r["p"]], highs[r["p"]] = r["lo"], r["hi"]
    before, after = [None] * width, [None] * width
    for p in range(1, width):
        before[p] = highs[p - 1] if highs[p - 1] is not None else before[p - 1]
    for p in reversed(range(width - 1)):
        after[p] = lows[p + 1] if lows[p + 1] is not None else after[p + 1]

    w = Window.partitionBy("__p").rowsBetween(Window.unboundedPreceding, 0)
    carried = laid.withColumn("__p", layout_partition()).withColumns(
        {
            "__lo": F.last(price, ignorenulls=True).over(w.orderBy("__pos")),
            "__hi": F.last(price, ignorenulls=True).over(w.orderBy(F.col("__pos").desc())),
        }
    )
    lo = F.coalesce("__lo", per_partition_literal(before, "double"))
    hi = F.coalesce("__hi", per_partition_literal(after, "double"))
    x = F.col("__x")
    closest = (
        F.when(x.isNull() | F.isnan(x), F.lit(None))
        .when(lo.isNull(), hi)
        .when(hi.isNull(), lo)
        .when(hi - x < x - lo, hi)
        .otherwise(lo)
    )
    return carried.where(F.col("__obs") == 1).withColumn(out, closest).select(*payload, out)
