"""Column profiles: counts, nulls, kinds, moments, correlation, information value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.operators.comoments import pair_moments
from pricelab.operators.quantiles import exact_median, exact_quantiles

# Aggregate expressions per pass, so that very wide frames stay plannable.
EXPRESSIONS_PER_PASS = 200

# Fixed value: added to both counts of a weight of evidence.
WOE_PRIOR = 0.5

# Fixed value: right-skewed columns get a log when their skew exceeds this.
RIGHT_SKEW = 2.2


def per_column(df: DataFrame, cols: Sequence[str], make, width: int) -> DataFrame:
    """One row per column: ``make(name)`` gives its aggregate columns; a pass covers many columns."""
    out = None
    step = max(1, EXPRESSIONS_PER_PASS // width)
    for i in range(0, len(cols), step):
        structs = [F.struct(F.lit(c).alias("column"), *make(c)) for c in cols[i : i + step]]
        part = df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))
        out = part if out is None else out.unionByName(part)
    return out


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def distinct_counts(train: DataFrame, test: DataFrame | None, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """Distinct known values per column, train beside test.

    Both frames go through one grouped pass per (column, value); ``approx``
    uses fixed-size sketches and no shuffle of values.
    """
    tagged = train.select(*cols, F.lit(True).alias("__t"))
    if test is not None:
        # A column the test frame lacks (the target) is absent there, not an error.
        rest = test.select(*[c for c in cols if c in test.columns], F.lit(False).alias("__t"))
        tagged = tagged.unionByName(rest, allowMissingColumns=True)
    if approx:
        make = lambda c: [
            F.approx_count_distinct(F.when(F.col("__t"), F.col(c))).alias("train"),
            F.approx_count_distinct(F.when(~F.col("__t"), F.col(c))).alias("test"),
        ]
        return per_column(tagged, list(cols), make, 2)
    pairs = tagged.select(
        "__t", F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in cols]))
    )
    seen = (
        pairs.where(F.col("v").isNotNull())
        .groupBy("column", "v")
        .agg(F.max("__t").alias("train"), F.max(~F.col("__t")).alias("test"))
    )
    found = seen.groupBy("column").agg(F.count_if("train").alias("train"), F.count_if("test").alias("test"))
    return _with_every(found, "column", cols).fillna(0, ["train", "test"])


def _with_every(found: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """One row per listed column, those without a known value included."""
    listed = found.sparkSession.createDataFrame([(c,) for c in cols], f"{name} string")
    return listed.join(found, name, "left")


def null_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and share per column."""
    cols = list(cols or df.columns)
    return per_column(
        df,
        cols,
        lambda c: [F.count_if(F.col(c).isNull()).alias("n_null"), F.avg(F.col(c).isNull().cast("int")).alias("share")],
        2,
    )


def null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    return [r["column"] for r in null_profile(df, cols).where(F.col("n_null") > 0).collect()]


def column_kind(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Kind of each column: constant, binary, categorical, int or float."""
    cols = list(cols or df.columns)
    types = {f.name: f.dataType.typeName() for f in df.schema.fields}

    def base(c: str) -> str:
        if types[c] in ("float", "double", "decimal"):
            return "float"
        if types[c] in ("byte", "short", "integer", "long"):
            return "int"
        return "categorical"

    counts = distinct_counts(df, None, cols).select("column", F.col("train").alias("n_distinct"))
    nulls = null_profile(df, cols).select("column", "n_null")
    kinds = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(base(c)))])
    full = F.col("n_null") == 0
    # Both sides hold one row per column.
    return (
        nulls.join(F.broadcast(counts), "column", "left")
        .withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0).cast("bigint")))
        .withColumn(
            "kind",
            F.when((F.col("n_distinct") == 1) & full, F.lit("constant"))
            .when((F.col("n_distinct") == 2) & full, F.lit("binary"))
            .otherwise(kinds[F.col("column")]),
        )
    )


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_column(
        df,
        list(cols),
        lambda c: [
            F.count(c).alias("n"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
        ],
        5,
    )


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, min, max, mean, sample deviation and exact median per column."""
    medians = exact_median(df, cols)
    return with_literals(moments(df, cols), {"median": medians})


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """:func:`summary_stats` with exact quartiles."""
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    names = ("q25", "q50", "q75")
    return with_literals(moments(df, cols), {n: {c: q[c][i] for c in cols} for i, n in enumerate(names)})


def with_literals(per_col: DataFrame, values: dict[str, dict[str, float | None]]) -> DataFrame:
    """Add learned numbers to a one-row-per-column frame."""
    added = {}
    for name, by_column in values.items():
        pairs = [x for c, v in by_column.items() for x in (F.lit(c), F.lit(v).cast("double"))]
        added[name] = F.create_map(*pairs)[F.col("column")]
    return per_col.withColumns(added)


def skew_sample(c: Column | str) -> Column:
    """Bias-corrected skewness."""
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def skewness_table(df: DataFrame, cols: Sequence[str], limit: float = RIGHT_SKEW) -> DataFrame:
    """Population and corrected skewness, and whether the corrected one calls for a log."""
    out = per_column(df, list(cols), lambda c: [F.skewness(c).alias("skew_pop"), skew_sample(c).alias("skew")], 2)
    return out.withColumn("right_skewed", F.coalesce(F.col("skew") > F.lit(limit), F.lit(False)))


def ranked_columns(per_col: DataFrame, order: Column, name: str, keep: Sequence[str]) -> DataFrame:
    """Position in the given order; the input has one row per column of a frame."""
    packed = per_col.agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("column"), *keep))).alias("rows"))
    return packed.select(F.posexplode("rows").alias(name, "r")).select(name, "r.column", *[f"r.{k}" for k in keep])


def corr_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Pearson correlation to the target, its size, and how many columns reach that size."""
    rows = per_column(df, list(cols), lambda c: [F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias("corr")], 1)
    rows = rows.withColumn("abs_corr", F.abs("corr"))
    ranked = ranked_columns(rows, F.col("abs_corr"), "pos", ["corr", "abs_corr"])
    return ranked.withColumn("cum_count", F.lit(len(cols)) - F.col("pos")).drop("pos")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All pairs (a, b, corr), each over the rows where both are known, in one scan for any number of columns.

    Null without two rows or without spread; NaN if a value of the pair is not finite.
    """
    names = F.array(*[F.lit(c) for c in cols])
    spread = F.sqrt(F.col("m2_a")) * F.sqrt(F.col("m2_b"))
    corr = F.when(F.col("bad") > 0, F.lit(float("nan"))).when((F.col("n") > 1) & (spread > 0), F.col("c") / spread)
    return pair_moments(df, cols).select(F.get(names, F.col("a")).alias("a"), F.get(names, F.col("b")).alias("b"), corr.alias("corr"))


def above_median(df: DataFrame, target: str, name: str = "event") -> DataFrame:
    """Binary target: above the exact median."""
    return df.withColumn(name, F.col(target) > F.lit(exact_median(df, [target])[target]))


def woe(df: DataFrame, features: Sequence[str], event: str) -> DataFrame:
    """Weight of evidence (non-events over events) and count-share difference: rows (feature, value, ...).

    One grouped pass covers all features.
    """
    totals = df.agg(F.count_if(event).alias("t"), F.count_if(~F.col(event)).alias("f")).first()
    n_t, n_f = F.lit(float(totals["t"])), F.lit(float(totals["f"]))
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in features])
    counted = (
        df.select(event, F.inline(entries))
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count_if(event).alias("events"), F.count_if(~F.col(event)).alias("nonevents"))
    )
    prior = F.lit(WOE_PRIOR)
    return counted.withColumns(
        {
            "woe": F.log(((F.col("nonevents") + prior) / n_f) / ((F.col("events") + prior) / n_t)),
            "diff": F.col("nonevents") / n_f - F.col("events") / n_t,
        }
    )


def woe_iv(df: DataFrame, features: Sequence[str], event: str) -> DataFrame:
    """Information value per feature."""
    found = woe(df, features, event).groupBy("feature").agg(F.sum(F.col("woe") * F.col("diff")).alias("iv"))
    return _with_every(found, "feature", features).fillna(0.0, ["iv"])


def group_stats(df: DataFrame, by: str, area: str, target: str) -> DataFrame:
    """Per group: rows, area range, mean target, rows per mean area and their logs."""
    n = F.count(F.lit(1))
    return (
        df.groupBy(by)
        .agg(
            n.alias("n_txn"),
            F.min(area).alias("min_area"),
            F.max(area).alias("max_area"),
            F.avg(area).alias("mean_area"),
            F.avg(target).alias("mean_target"),
            F.min(target).alias("min_target"),
            F.max(target).alias("max_target"),
        )
        .withColumn("txn_per_mean_area", F.try_divide(F.col("n_txn"), F.col("mean_area")))
        .withColumns({"log_n_txn": F.log10("n_txn"), "log_txn_per_mean_area": F.log10("txn_per_mean_area")})
    )


def histogram(
    df: DataFrame, column: str, bins: int, by: str | None = None, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """Counts and densities over shared equal-width bins, optionally per group.

    The last bin includes its upper edge; values outside the edges are dropped.
    Edges default to the overall range, so groups compare bin by bin.
    """
    v = F.col(column).cast("double")
    if lo is None or hi is None:
        edge = df.where(~F.isnan(v)).agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
        lo = edge["lo"] if lo is None else lo
        hi = edge["hi"] if hi is None else hi
    width = (hi - lo) / bins
    if width <= 0:
        raise ValueError(f"empty range {lo}..{hi}")
    slot = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)).cast("int")
    groups = [] if by is None else [by]
    counted = (
        df.where((v >= F.lit(lo)) & (v <= F.lit(hi)))
        .groupBy(*groups, slot.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    total = counted.groupBy(*groups).agg(F.sum("n").alias("total"))
    if groups:
        # At most ``bins`` rows per group meet one total each.
        shared = counted.join(total, by)
    else:
        shared = counted.withColumn("total", F.lit(total.first()["total"]))
    return shared.select(
        *groups,
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("left_edge"),
        "n",
        (F.col("n") / (F.col("total") * F.lit(width))).alias("density"),
    )


def residual_sign_share(df: DataFrame, kept: str, errors: Sequence[str]) -> DataFrame:
    """Share of positive errors among the rows that were trimmed away."""
    return df.where(~F.col(kept)).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg((F.col(e) > 0).cast("int")).alias(f"positive_{e}") for e in errors]
    )


def importance_diff(scores: DataFrame, base: str = "none") -> DataFrame:
    """Mean shuffle score less the unshuffled score; a positive value marks a useless feature."""
    b = scores.where(F.col("feat") == base).first()
    if b is None:
        raise ValueError(f"no score of {base!r} to compare with")
    return scores.select("feat", "avg", (F.col("avg") - F.lit(b["avg"])).alias("diff")).orderBy(F.desc("diff"), "feat")


def best_iteration(history: DataFrame, by: Sequence[str], iteration: str, metric: str) -> DataFrame:
    """Iteration with the lowest validation metric (the earliest on ties)."""
    best = F.min(F.struct(F.col(metric).alias("m"), F.col(iteration).alias("i")))
    return history.groupBy(*by).agg(best.alias("b")).select(*by, F.col("b.i").alias("best_iteration"), F.col("b.m").alias("best_metric"))


def best_iteration_array(df: DataFrame, history: str) -> Column:
    """1-based index of the smallest entry of a history array."""
    return F.array_position(F.col(history), F.array_min(history))
