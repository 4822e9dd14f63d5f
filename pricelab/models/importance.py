"""Permutation importance, tree importance, and metric curves over rounds."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.ml import Estimator, Model
from pyspark.sql import Column, DataFrame, functions as F

from pricelab.functions.keys import seeded_text
from pricelab.models.boosted import held_out
from pricelab.models.jobs import FEATURES, assemble, at_a_time, fit_fold, fit_layout, fit_other_folds, fit_rows, fold_values, in_parts, run_all
from pricelab.models.nodes import round_scores, split_importance, trees_of
from pricelab.operators import metrics as M
from pricelab.operators.ranks import global_rank


def with_donors(df: DataFrame, cols: Sequence[str], key: str, seed: int) -> DataFrame:
    """Add ``__d_<col>``: the values of another row, drawn by one seeded permutation.

    All columns share the permutation, so one sort and one join serve every
    feature; each shuffled column keeps its own distribution.
    """
    donors = df.select(F.col(key).alias("__k"), *[F.col(c).alias(f"__d_{c}") for c in cols])
    donors = global_rank(donors, [seeded_text(seed, "__k"), "__k"], "__r").drop("__k")
    return global_rank(df, [key], "__r").join(donors, "__r").drop("__r")


def permutation_importance(
    df: DataFrame,
    make: Callable[[], Estimator],
    features: Sequence[str],
    inverse: Column,
    price: str = "total_price",
    key: str = "building_id",
    fold: str = "fold",
    folds: Sequence[int] | None = None,
    seed: int = 42,
    parallelism: int | None = None,
) -> DataFrame:
    """Rows (feat, fold, score): held-out score after shuffling each feature, and unshuffled (``none``).

    One job per fold scores all variants; on small tables the folds run side by side.
    """
    folds = fold_values(df, fold, folds, whole=False)
    parts, fits = fit_layout(df)
    few = in_parts(assemble(df, features), parts)

    def scores(f: int) -> list[tuple]:
        held = F.col(fold) == f
        model = fit_fold(make(), few, held, rows, features, partial(held_out, f))
        donors = shuffled_variants(with_donors(df.where(held), features, key, seed + f), features)
        scored = model.transform(assemble(donors, features)).groupBy("feat").agg(M.hit_score(price, inverse).alias("score"))
        return [(r["feat"], int(f), float(r["score"])) for r in scored.collect()]

    with fit_rows(df, make(), features, fold=F.col(fold)) as rows:
        found = run_all([partial(scores, f) for f in folds], parallelism or at_a_time(rows, fits))
    return df.sparkSession.createDataFrame([r for part in found for r in part], "feat string, fold int, score double")


def shuffled_variants(donors: DataFrame, features: Sequence[str], name: str = "feat") -> DataFrame:
    """Every row once as it is (``none``) and once per feature with that feature's donor value.

    The variants are made inside the scan; only the model's scores of a batch are
    ever held, and sums per variant leave a task.
    """
    kept = [c for c in donors.columns if c not in features and not c.startswith("__d_")]
    types = {c: donors.schema[c].dataType for c in features}
    variants = [
        F.struct(F.lit(v).alias(name), *[F.col(f"__d_{c}" if c == v else c).cast(types[c]).alias(c) for c in features])
        for v in ["none", *features]
    ]
    return donors.select(*kept, F.inline(F.array(*variants)))


def tree_importance(model: Model, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Gain share and number of splits per feature, from the model's node table."""
    return split_importance(model, features, df)


def iteration_curve(
    df: DataFrame, make: Callable[[], Estimator], features: Sequence[str], fold: str = "fold", folds: Sequence[int] | None = None
) -> DataFrame:
    """Squared error after each round, train and validation, per fold: rows (fold, iteration, train_mse, val_mse)."""
    found, ready = [], assemble(df, features)
    folds = fold_values(df, fold, folds, whole=False)
    with fit_rows(df, make(), features, fold=F.col(fold)) as rows:
        for f in folds:
            train, val = ready.where(F.col(fold) != f), ready.where(F.col(fold) == f)
            model = fit_other_folds(make(), ready, fold, f, rows, features)
            curves = [model.evaluateEachIteration(d, "squared") for d in (train, val)]
            found += [(int(f), i + 1, float(a), float(b)) for i, (a, b) in enumerate(zip(*curves))]
    return df.sparkSession.createDataFrame(found, "fold int, iteration int, train_mse double, val_mse double")


def price_curve(
    df: DataFrame, make: Callable[[], Estimator], features: Sequence[str], target: str, price: str, area: str | None = None, log: bool = True,
    fold: str = "fold", folds: Sequence[int] | None = None, parallelism: int = 4,
) -> DataFrame:
    """Metrics of the inverted price after each round: rows (fold, part, iteration, score, mape, msle, mse).

    ``part`` is ``train`` or ``val``; ``mse`` is of the raw target. The folds' models
    are fitted side by side; one scan scores all their rounds on all rows.
    """
    folds = fold_values(df, fold, folds, whole=False)
    ready = assemble(df, features)
    with fit_rows(df, make(), features, fold=F.col(fold)) as rows:
        models = run_all([partial(fit_other_folds, make(), ready, fold, f, rows, features) for f in folds], at_a_time(rows, parallelism))
    trees = {int(f): trees_of(m, df) for f, m in zip(folds, models)}
    return round_scores(ready, trees, target, price, area, log, fold, FEATURES)


def mean_price_curve(curve: DataFrame) -> DataFrame:
    """Fold means of :func:`price_curve` per part and round; rounds that some fold did not reach say so in ``folds``."""
    return curve.groupBy("part", "iteration").agg(
        F.count(F.lit(1)).alias("folds"), *[F.avg(m).alias(m) for m in ("score", "mape", "msle", "mse")]
    )


def mean_curve(curve: DataFrame) -> DataFrame:
    """Fold mean of an iteration curve."""
    return curve.groupBy("iteration").agg(F.avg("train_mse").alias("train_mse"), F.avg("val_mse").alias("val_mse"))
