"""Regression, hit-rate and binary metrics as aggregate expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricelab.functions.errors import abs_percent_error, is_hit, smooth_hit
from pricelab.functions.rows import row_dot
from pricelab.functions.targets import col
from pricelab.operators.ranks import global_rank, layout_counts, layout_partition, layout_position, offsets, ordered_layout, per_partition_literal, range_order

# Fixed values of the packed score: hit rate is rounded to 4 places and scaled.
HIT_DECIMALS = 4
HIT_SCALE = 10_000.0

# Fixed value: probabilities are clipped this far from 0 and 1 in the log loss.
LOG_LOSS_CLIP = 1e-15

# Weight vectors scored per pass over the data.
CANDIDATES_PER_PASS = 40


def mape(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.avg(abs_percent_error(y_true, y_pred))


def hit_rate(y_true: Column | str, y_pred: Column | str) -> Column:
    """Share of rows within 10 %, rounded half to even."""
    return F.bround(F.avg(is_hit(y_true, y_pred).cast("int")), HIT_DECIMALS)


def hit_score(y_true: Column | str, y_pred: Column | str) -> Column:
    """Packed score: hit rate times 10000, plus ``1 - mape`` as the fraction."""
    return hit_rate(y_true, y_pred) * F.lit(HIT_SCALE) + (F.lit(1.0) - mape(y_true, y_pred))


def hit_score_log(log_true: Column | str, log_pred: Column | str) -> Column:
    """:func:`hit_score` of log-scale values."""
    back = lambda c: F.greatest(F.exp(col(c)) - F.lit(1.0), F.lit(0.0))
    return hit_score(back(log_true), back(log_pred))


def smooth_score(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.lit(100.0) * F.avg(smooth_hit(abs_percent_error(y_true, y_pred)))


def mse(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.avg(F.pow(col(y_pred) - col(y_true), F.lit(2.0)))


def mae(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.avg(F.abs(col(y_pred) - col(y_true)))


def msle(y_true: Column | str, y_pred: Column | str) -> Column:
    return F.avg(F.pow(F.log1p(col(y_pred)) - F.log1p(col(y_true)), F.lit(2.0)))


def accuracy(label: Column | str, predicted: Column | str) -> Column:
    return F.avg(F.coalesce(col(label) == col(predicted), F.lit(False)).cast("int"))


def log_loss(label: Column | str, prob: Column | str) -> Column:
    p = F.least(F.greatest(col(prob), F.lit(LOG_LOSS_CLIP)), F.lit(1.0 - LOG_LOSS_CLIP))
    y = col(label)
    return F.avg(-(y * F.log(p) + (F.lit(1) - y) * F.log(F.lit(1.0) - p)))


METRICS = {
    "score": hit_score,
    "mape": mape,
    "mse": mse,
    "mae": mae,
    "msle": msle,
    "smooth": smooth_score,
    "log_loss": log_loss,
}


def score_by_group(
    df: DataFrame, by: Sequence[str], y_true: str, y_pred: str, metrics: Sequence[str] = ("score", "mse", "mae", "mape")
) -> DataFrame:
    return df.groupBy(*by).agg(*[METRICS[m](y_true, y_pred).alias(m) for m in metrics])


def fold_summary(scores: DataFrame, by: Sequence[str], fold: str = "fold", score: str = "score") -> DataFrame:
    """Mean, population deviation and the fold scores in fold order, per setting."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(fold), F.col(score)))), lambda s: s[score])
    return scores.groupBy(*by).agg(
        F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.count(score).alias("n"), listed.alias("scores")
    )


def pooled_error(summary: DataFrame) -> DataFrame:
    """Root mean variance over settings, and the standard error for the fold count."""
    pooled = F.sqrt(F.avg(F.pow("std", F.lit(2.0))))
    return summary.agg(pooled.alias("pooled_std"), (pooled / F.sqrt(F.max("n"))).alias("standard_error"))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counted half: one row ``auc``.

    Labels are first summed per distinct score, so a score shared by many rows
    is one row here; the negatives below each score come from a prefix sum over
    range partitions.
    """
    grouped = (
        df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
        .groupBy(F.col(score).alias("s"))
        .agg(F.sum(F.col(label).cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    below = prefix_sum(grouped, ["s"], "neg", "below")
    won = F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return below.agg(F.try_divide(won, pairs).alias("auc"))


def prefix_sum(df: DataFrame, order: Sequence[str], weight: str, name: str) -> DataFrame:
    """Sum of ``weight`` over all earlier rows of the global order."""
    laid = ordered_layout(df, order)
    start = per_partition_literal(offsets(layout_counts(laid, F.col(weight))), "bigint")
    w = Window.partitionBy("__p").orderBy("__pos").rowsBetween(Window.unboundedPreceding, -1)
    inner = laid.withColumn("__p", layout_partition()).withColumn(name, F.coalesce(F.sum(weight).over(w), F.lit(0)))
    return inner.withColumn(name, F.col(name) + start).drop("__p", "__pos")


def gini_normalized(df: DataFrame, y_true: str, y_pred: str, key: str) -> DataFrame:
    """Gini of the prediction order over the Gini of the perfect order: one row ``gini``.

    The sum of the cumulative sums equals the sum of y times (n - position), so
    a rank replaces the running sum. Ties keep id order.
    """
    narrow = df.select(F.col(key), F.col(y_true).cast("double").alias("y"), F.col(y_pred).cast("double").alias("p"))

    def ordered_gini(by: str) -> DataFrame:
        ranked = global_rank(narrow.select(key, "y", F.col(by).alias("o")), [F.desc("o"), key], "r")
        n, total = F.count(F.lit(1)), F.sum("y")
        cumulative = n * total - F.sum(F.col("y") * F.col("r"))
        return ranked.agg(((cumulative / total - (n + 1) / F.lit(2.0)) / n).alias("g"))

    perfect = ordered_gini("y").first()["g"]
    return ordered_gini("p").select((F.col("g") / F.lit(perfect)).alias("gini"))


# Metrics of the order of all rows; ``gini`` breaks ties by the key.
RANKED_METRICS = ("auc", "gini")


def ranked_grid(
    df: DataFrame, y_true: str, preds: Sequence[str], weights: Sequence[Sequence[float]], metric: str, log: bool = False, key: str = "building_id"
) -> DataFrame:
    """``auc`` or ``gini`` of every weight vector in one range layout: rows (weight_id, w1.., metric).

    Every blend is a value of its own order, so each row stands once per vector, with
    the vector's number as the first key of the layout. A vector's ranks and prefix
    sums are those of the whole layout less the ones at its first row.
    """
    table = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in weights])
    values = [F.log1p(F.col(p)) if log else F.col(p).cast("double") for p in preds]
    inputs = F.array(*values)
    dot = lambda w: F.aggregate(F.zip_with(w, inputs, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    price = (lambda w: clipped(F.expm1(dot(w)))) if log else dot
    if len(weights) <= CANDIDATES_PER_PASS:
        # Few vectors are plain expressions, which are compiled; a list of any length is one expression per value.
        plain = [reduce(add, [F.lit(float(a)) * values[k] for k, a in enumerate(w)], F.lit(0.0)) for w in weights]
        blends = F.array(*[clipped(F.expm1(x)) if log else x for x in plain])
    else:
        blends = F.transform(table, price)
    truth = F.col(y_true).cast("double")
    if metric == "gini":
        # The perfect order is one more vector, number -1, ordered by the truth.
        blends = F.concat(F.array(truth), blends)
    rows = df.select(F.col(key).alias("key"), truth.alias("y"), F.posexplode(blends).alias("c", "o"))
    scored = _keyed_auc(rows) if metric == "auc" else _keyed_gini(rows.withColumn("c", F.col("c") - 1))
    vector = F.get(table, F.col("c"))
    return scored.select(F.col("c").alias("weight_id"), *[F.get(vector, F.lit(k)).alias(f"w{k + 1}") for k in range(len(weights[0]))], metric)


def _keyed_auc(rows: DataFrame) -> DataFrame:
    grouped = (
        rows.where("y IS NOT NULL AND o IS NOT NULL")
        .groupBy("c", "o")
        .agg(F.sum(F.col("y").cast("bigint")).alias("pos"), F.count(F.lit(1)).alias("n"))
        .withColumn("neg", F.col("n") - F.col("pos"))
    )
    below = prefix_sum(grouped, ["c", "o"], "neg", "below")
    won = F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / F.lit(2.0))) - F.min("below") * F.sum("pos")
    return below.groupBy("c").agg(F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc"))


def _keyed_gini(rows: DataFrame) -> DataFrame:
    """One layout, read once: a range part gives per vector its rows, its sum and its sum of y times the place.

    The rank of a row is its place in the part, less the first of its vector there,
    plus the vector's rows in earlier parts. Only these sums leave the sort.
    """
    laid = range_order(rows, [_coarse_place(), "c", F.desc("o"), "key"])
    place = layout_position()
    parts = laid.groupBy("c", layout_partition().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("s"), F.sum(F.col("y") * place).alias("sp"), F.min(place).alias("first")
    )
    earlier = F.sum("n").over(Window.partitionBy("c").orderBy("p").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.withColumn("shift", F.coalesce(earlier, F.lit(0)) - F.col("first"))
    n, total = F.sum("n"), F.sum("s")
    cumulative = n * total - F.sum(F.col("sp") + F.col("s") * F.col("shift"))
    ginis = parts.groupBy("c").agg(((F.try_divide(cumulative, total) - (n + 1) / F.lit(2.0)) / n).alias("g"))
    best = F.max(F.when(F.col("c") == -1, F.col("g"))).over(Window.partitionBy())
    return ginis.withColumn("gini", F.try_divide(F.col("g"), best)).where("c >= 0").select("c", "gini")


def _coarse_place() -> Column:
    """A long that never contradicts the order (c, o descending): a sort compares it without reading the rows.

    The vector stands above 44 bits that hold ``o`` in sixteenths, cut at both ends
    (a NaN at the upper one); unknown values come after the lower end.
    """
    edge = 1 << 42
    cut = F.floor(F.greatest(F.least(F.col("o"), F.lit(edge / 16)), F.lit(-edge / 16)) * 16)
    sixteenths = F.when(F.col("o").isNull(), F.lit(-edge - 1)).otherwise(cut)
    return F.col("c").cast("long") * F.lit(1 << 44) - sixteenths


def score_weight_grid(
    df: DataFrame,
    y_true: str,
    preds: Sequence[str],
    weights: Sequence[Sequence[float]],
    metric: str = "score",
    log: bool = False,
    key: str = "building_id",
) -> DataFrame:
    """Score every weight vector: rows (weight_id, w1.., metric).

    ``auc`` and ``gini`` order the rows by each blend, all in one layout (:func:`ranked_grid`).

    All candidates of a pass are aggregate columns over the same scan, so rows
    are neither copied per candidate nor shuffled.
    """
    scored = []
    if metric in RANKED_METRICS:
        return ranked_grid(df, y_true, preds, weights, metric, log, key)
    for i in range(0, len(weights), CANDIDATES_PER_PASS):
        chunk = weights[i : i + CANDIDATES_PER_PASS]
        structs = []
        for j, w in enumerate(chunk):
            value = METRICS[metric](y_true, blended(preds, w, log))
            named = [F.lit(float(x)).alias(f"w{k + 1}") for k, x in enumerate(w)]
            structs.append(F.struct(F.lit(i + j).alias("weight_id"), *named, value.alias(metric)))
        scored.append(df.agg(F.array(*structs).alias("rows")).select(F.inline("rows")))
    out = scored[0]
    for more in scored[1:]:
        out = out.unionByName(more)
    return out


def blended(preds: Sequence[str], weights: Sequence[float], log: bool) -> Column:
    """Weighted blend of predictions, on the plain or the log1p scale; null when any prediction is."""
    if not log:
        return row_dot(preds, weights)
    return clipped(F.expm1(row_dot([F.log1p(F.col(p)) for p in preds], weights)))


def clipped(price: Column) -> Column:
    """The price, at least zero; ``greatest`` alone would make zero of an unknown one."""
    return F.when(price.isNotNull(), F.greatest(price, F.lit(0.0)))
