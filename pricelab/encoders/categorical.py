"""Category codes, smoothed target ranks, random label codes, frequencies, rare values.

States are tables with one row per distinct value, written once at fit. They
are looked up through :func:`lookup_join`, which broadcasts only a counted
small state.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.keys import seeded_text
from pricelab.operators.filters import null_values, rare_values
from pricelab.operators.joins import lookup_join
from pricelab.operators.ranks import category_codes, within_group_rank
from pricelab.session import materialize

# Labels of missing, unknown and overall-mean entries.
MISSING = "M!ss!nG"
UNKNOWN = "UnKnoWn"
MEAN_LEVEL = "MeAnlvl"

# Fixed value: share of unseen values above which a transform warns.
UNKNOWN_WARN_SHARE = 0.7

# Fixed value: labels beyond this many do not add permutations.
PERMUTATION_LABELS = 10


def _long(df: DataFrame, cols: Sequence[str], *extra: Column) -> DataFrame:
    """Rows (col, value, extras): one scan covers all columns."""
    entries = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(*extra, F.inline(entries))


class _ColumnTables:
    """State split by column, with row counts known for the broadcast check."""

    def __init__(self, state: DataFrame):
        self.state = materialize(state)
        self.rows = {r["col"]: r["n"] for r in self.state.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}

    def lookup(self, df: DataFrame, column: str, fields: dict[str, str]) -> DataFrame:
        """Add state fields of this column's values under new names."""
        side = self.state.where(F.col("col") == column).select(
            "value", *[F.col(f).alias(out) for f, out in fields.items()]
        )
        keyed = df.withColumn("__v", F.col(column).cast("string"))
        return lookup_join(keyed, side, {"__v": "value"}, self.rows.get(column, 0)).drop("__v")


class CategoryEncoder:
    """Alphabetical integer codes.

    ``lightgbm``: missing and unseen values become null. ``keras``: codes are
    shifted to start at 0; with ``reserve_missing`` code 0 is kept for missing
    and unseen values. Without it, a value that has no code raises, unless
    training itself had missing values.
    """

    def __init__(self, mode: str = "lightgbm", reserve_missing: bool = False):
        if mode not in ("lightgbm", "keras"):
            raise ValueError("mode must be lightgbm or keras")
        self.mode, self.reserve_missing = mode, reserve_missing

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "CategoryEncoder":
        self.cols = list(cols)
        self.tables = _ColumnTables(category_codes(df, cols))
        gaps = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
        self.has_missing_code = {c: self.reserve_missing or gaps[c] > 0 for c in cols}
        shift = {c: 1 if self.has_missing_code[c] else 0 for c in cols}
        self.n_classes = {c: self.tables.rows.get(c, 0) + shift[c] for c in cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        for c in self.cols:
            df = self.tables.lookup(df, c, {"code": "__code"})
            if self.mode == "lightgbm":
                code = F.col("__code").cast("float")
            elif self.has_missing_code[c]:
                code = F.coalesce(F.col("__code") + 1, F.lit(0)).cast("int")
            else:
                unknown = F.raise_error(F.lit(f"{c}: value without a code; fit with reserve_missing"))
                code = F.coalesce(F.col("__code"), unknown.cast("bigint")).cast("int")
            df = df.withColumn(c, code).drop("__code")
        return df.select(*names)


class TargetMeanEncoder:
    """Ordinal rank (from 1) of each value's smoothed target mean.

    The mean is ``(sum + C * overall) / (n + C)`` with ``C = rows / distinct
    values``. Missing values form a value of their own. An extra entry at the
    overall mean serves unseen values. With ``parity`` missing and unseen share
    the higher of the missing rank and the overall-mean rank.
    """

    def __init__(self, parity: bool = False):
        self.parity = parity

    def fit(self, df: DataFrame, cols: Sequence[str], target: str) -> "TargetMeanEncoder":
        self.cols = list(cols)
        y = F.col(target).cast("double").alias("y")
        overall = df.agg(F.avg(y).alias("m"), F.count(F.lit(1)).alias("n"), F.count_if(y.isNull()).alias("gaps")).first()
        if overall["gaps"]:
            raise ValueError(f"{overall['gaps']} rows have no target")
        labelled = _long(df, cols, y).withColumn("value", F.coalesce("value", F.lit(MISSING)))
        sums = materialize(labelled.groupBy("col", "value").agg(F.sum("y").alias("s"), F.count("y").alias("n")))
        per_col = {r["col"]: r["k"] for r in sums.groupBy("col").agg(F.count(F.lit(1)).alias("k")).collect()}
        prior = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(overall["n"] / per_col[c]))])[F.col("col")]
        means = sums.select(
            "col", "value", ((F.col("s") + prior * F.lit(overall["m"])) / (F.col("n") + prior)).alias("mean")
        )
        extra = df.sparkSession.createDataFrame(
            [(c, MEAN_LEVEL, float(overall["m"])) for c in cols], "col string, value string, mean double"
        )
        entries = sum(per_col.values()) + len(self.cols)
        ranked = within_group_rank(means.unionByName(extra), ["col"], ["mean", "value"], "r", entries)
        self.tables = _ColumnTables(ranked.select("col", "value", "mean", (F.col("r") + 1).alias("rank")))
        fixed = self.tables.state.where(F.col("value").isin(MISSING, MEAN_LEVEL)).collect()
        self.unknown_rank = {r["col"]: r["rank"] for r in fixed if r["value"] == MEAN_LEVEL}
        if self.parity:
            self.unknown_rank = {c: max(r["rank"] for r in fixed if r["col"] == c) for c in cols}
        return self

    def transform(self, df: DataFrame, warn: bool = False) -> DataFrame:
        """Add ``encoded_<col>`` for every fitted column."""
        if warn:
            for c, share in self.unknown_share(df).items():
                if share is not None and share > UNKNOWN_WARN_SHARE:
                    print(f"warning: unseen share of {c}: {share:.5f}")
        for c in self.cols:
            labelled = df.withColumn("__label", F.coalesce(F.col(c).cast("string"), F.lit(MISSING)))
            side = self._side(c)
            joined = lookup_join(labelled, side, {"__label": "value"}, self.tables.rows.get(c, 0))
            rank = F.coalesce(F.col("__rank"), F.lit(self.unknown_rank[c]))
            df = joined.withColumn(f"encoded_{c}", rank.cast("int")).drop("__label", "__rank")
        return df

    def _side(self, column: str) -> DataFrame:
        rows = self.tables.state.where((F.col("col") == column) & (F.col("value") != MEAN_LEVEL))
        if self.parity:
            rows = rows.where(F.col("value") != MISSING)
        return rows.select("value", F.col("rank").alias("__rank"))

    def unknown_share(self, df: DataFrame) -> dict[str, float | None]:
        """Share of rows per column whose value was not seen at fit."""
        out = {}
        for c in self.cols:
            labelled = df.select(F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias("__label"))
            joined = lookup_join(labelled, self._side(c), {"__label": "value"}, self.tables.rows.get(c, 0))
            out[c] = joined.agg(F.avg(F.col("__rank").isNull().cast("int"))).first()[0]
        return out


class MultiLabelEncoder:
    """Up to n seeded random label codes per column, with codes for missing and unknown."""

    def __init__(self, n: int = 4, seed: int = 42):
        self.n, self.seed = n, seed

    def fit(self, df: DataFrame, cols: Sequence[str]) -> "MultiLabelEncoder":
        self.cols = list(cols)
        values = _long(df, cols).withColumn("value", F.coalesce("value", F.lit(MISSING))).distinct()
        fixed = df.sparkSession.createDataFrame(
            [(c, v) for c in cols for v in (MISSING, UNKNOWN)], "col string, value string"
        )
        values = materialize(values.unionByName(fixed).distinct())
        labels = {r["col"]: r["n"] for r in values.groupBy("col").agg(F.count(F.lit(1)).alias("n")).collect()}
        self.n_cols = {c: self._encodings(labels[c]) for c in cols}
        ways = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(self.n_cols[c]))])[F.col("col")]
        drawn = values.withColumn("i", F.explode(F.sequence(F.lit(0), ways - 1)))
        order = [seeded_text(self.seed, "i", "value"), "value"]
        drawn_rows = sum(labels[c] * self.n_cols[c] for c in cols)
        coded = within_group_rank(drawn, ["col", "i"], order, "code", drawn_rows)
        # At most n codes per value.
        table = coded.groupBy("col", "value").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("i", "code"))), lambda s: s["code"]).alias("codes")
        )
        self.tables = _ColumnTables(table)
        unknown = self.tables.state.where(F.col("value") == UNKNOWN).collect()
        self.unknown_codes = {r["col"]: r["codes"] for r in unknown}
        return self

    def _encodings(self, labels: int) -> int:
        return max(1, min(math.factorial(min(labels, PERMUTATION_LABELS)) // 2, self.n))

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``lencoded_<i>_<col>`` for every fitted column."""
        for c in self.cols:
            labelled = df.withColumn("__label", F.coalesce(F.col(c).cast("string"), F.lit(MISSING)))
            side = self.tables.state.where(F.col("col") == c).select("value", F.col("codes").alias("__codes"))
            joined = lookup_join(labelled, side, {"__label": "value"}, self.tables.rows[c])
            unknown = F.array(*[F.lit(x) for x in self.unknown_codes[c]])
            codes = F.coalesce(F.col("__codes"), unknown)
            df = joined.withColumns(
                {f"lencoded_{i}_{c}": codes[i].cast("int") for i in range(self.n_cols[c])}
            ).drop("__label", "__codes")
        return df


class FrequencyEncoder:
    """Train row count of each value, left-joined to any frame (null when unseen)."""

    def fit(self, df: DataFrame, column: str, out: str | None = None) -> "FrequencyEncoder":
        self.column, self.out = column, out or f"n_txn_per_{column}"
        counts = _long(df, [column]).where(F.col("value").isNotNull())
        self.tables = _ColumnTables(counts.groupBy("col", "value").agg(F.count(F.lit(1)).alias("n")))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        return self.tables.lookup(df, self.column, {"n": self.out})


class RareNuller:
    """Set values to null that are rare in train and absent from the frame to keep."""

    def __init__(self, threshold: int = 2):
        self.threshold = threshold

    def fit(self, df: DataFrame, cols: Sequence[str], keep_from: DataFrame | None = None) -> "RareNuller":
        self.rare = {c: materialize(rare_values(df, c, self.threshold, keep_from)) for c in cols}
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        names = df.columns
        for c, values in self.rare.items():
            df = null_values(df, c, values)
        return df.select(*names)
