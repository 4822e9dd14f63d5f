"""Cross prediction, refits, segment models, classifiers and stacking."""

from __future__ import annotations

import contextlib
import warnings
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricelab.encoders.stages import FeatureSteps
from pricelab.functions.rows import row_dot, row_mean, row_vote
from pricelab.functions.targets import target_inverse
from pricelab.models import boosted
from pricelab.models.lasso import Moments, fold_moments, held_out_scores, lines_of
from pricelab.operators import metrics as M
from pricelab.operators.tables import union_rows
from pricelab.session import stored

FEATURES = "__features"
IS_VAL = "__is_val"
WEIGHT = "__weight"

# Fixed value: probability from which a sale counts as expensive.
CLASS_CUT = 0.5

# Fixed value: growth of the mean best iteration in the refit on all rows.
REFIT_GROWTH = 1.2

# Trees have no missing branch in Spark; gaps take a value outside the usual range.
GAP_VALUE = -1.0

# A tree fit is some hundred short passes: tasks of fewer rows cost more to start than to run.
ROWS_PER_FIT_TASK = 500_000

# Rows for each core of the boosted fits that run at a time: they hold 16 bytes of a row, and one's pauses are the others' time.
BOOSTED_ROWS_PER_CORE = 12_000_000

# Fits that run at a time on small tables. Each holds its binned rows, so large ones run alone.
MOST_FITS = 8

# Penalties tried by the linear stack.
STACK_ALPHAS = (
    0, 0.00001, 0.00002, 0.00005, 0.00008, 0.0001, 0.0002, 0.0005, 0.0008, 0.001, 0.002, 0.005, 0.008, 0.01, 0.02,
)


def assemble(df: DataFrame, features: Sequence[str], gap: float = GAP_VALUE) -> DataFrame:
    """Add the feature vector; missing and NaN entries take the gap value."""
    cols = filled(features, gap)
    maker = VectorAssembler(inputCols=list(cols), outputCol=FEATURES)
    return maker.transform(df.withColumns(cols)).drop(*cols)


def filled(features: Sequence[str], gap: float = GAP_VALUE) -> dict[str, Column]:
    """The features as numbers without gaps, by the names that :func:`assemble` gives them."""
    return {f"__f_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(gap)) for c in features}


def boosted_trees(
    target: str, max_iter: int = 20, depth: int = 5, step: float = 0.1, early_stop: bool = True, tol: float = 0.0,
    weighted: bool = False, seed: int = 555, **params: object,
) -> GBTRegressor:
    """Squared-error boosted trees; with ``early_stop`` rows flagged for validation stop the rounds."""
    est = GBTRegressor(
        featuresCol=FEATURES, labelCol=target, predictionCol="y_raw", maxIter=max_iter, maxDepth=depth, stepSize=step,
        seed=seed, **params,
    )
    if early_stop:
        est = est.setValidationIndicatorCol(IS_VAL)
        est = est.copy({est.validationTol: tol})
    return est.setWeightCol(WEIGHT) if weighted else est


def random_forest(
    target: str, trees: int = 20, depth: int = 8, feature_share: str = "0.5", seed: int = 555, **params: object
) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=FEATURES, labelCol=target, predictionCol="y_raw", numTrees=trees, maxDepth=depth,
        featureSubsetStrategy=feature_share, seed=seed, **params,
    )


def run_all(tasks: Sequence[Callable[[], object]], parallelism: int) -> list:
    """Run independent fits from a few driver threads, so that one job's tail overlaps the next."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    # One wrapper per task: a wrapper's threads share one set of local properties, and would clear each other's.
    in_session = lambda task: inheritable_thread_target(SparkSession.active())(task)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return [f.result() for f in [pool.submit(in_session(t)) for t in tasks]]


def fit_layout(df: DataFrame) -> tuple[int | None, int]:
    """At most how many parts the tree fits on ``df`` need, and how many of its fits to run at a time.

    Few parts and many fits keep the cores busy on a small table; on a large one a
    single fit does, and more at a time would only push each other's rows to disk.
    A table that one task could pass keeps its layout.
    """
    parts = max(1, -(-df.count() // ROWS_PER_FIT_TASK))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return None if parts == 1 else parts, max(1, min(MOST_FITS, -(-2 * cores // parts)))


def in_parts(df: DataFrame, parts: int | None) -> DataFrame:
    """``df`` in at most ``parts`` parts, or as it lies."""
    return df if parts is None else df.coalesce(parts)


def uses_validation(est: Estimator) -> bool:
    return est.hasParam("validationIndicatorCol") and est.isSet("validationIndicatorCol")


def best_iteration(model: Model) -> int:
    return int(model.getNumTrees) if hasattr(model, "getNumTrees") else 0


@dataclass
class CrossResult:
    """Out-of-fold rows, raw test predictions per fold, and the fitted models."""

    oof: DataFrame
    test: DataFrame | None
    models: list[Model] = field(default_factory=list)

    @property
    def best_iterations(self) -> list[int]:
        return [best_iteration(m) for m in self.models]


def fit_on(est: Estimator, train: DataFrame, val: DataFrame | None = None, parts: int | None = None) -> Model:
    """Fit on train rows, in at most ``parts`` parts; the validation rows only stop the rounds."""
    if val is not None and uses_validation(est):
        rows = train.withColumn(IS_VAL, F.lit(False)).unionByName(val.withColumn(IS_VAL, F.lit(True)))
        return boosted.fit(est, in_parts(rows, parts))
    return boosted.fit(_without_validation(est) if uses_validation(est) else est, in_parts(train, parts))


def fit_fold(est: Estimator, ready: DataFrame, held: Column, rows: FitRows | None = None, cols: Sequence[str] = (), role=None) -> Model:
    """:func:`fit_on` for two halves of one frame: a flag tells them apart, so both are one scan.

    With ``rows``, what was read for all fits on the frame serves this one too: its features ``cols``, in the part that ``role`` gives each row.
    """
    frame = ready.withColumn(IS_VAL, held) if uses_validation(est) else ready.where(~held)
    if rows is not None and rows.can_fit(est, ready):
        return rows.fit(est, cols, role, frame)
    return boosted.fit(est, frame)


def fit_other_folds(est: Estimator, ready: DataFrame, fold: str, f: int, rows: FitRows | None, cols: Sequence[str]) -> Model:
    """All rounds on the rows of every fold but ``f``."""
    est = _without_validation(est) if uses_validation(est) else est
    return fit_fold(est, ready, F.col(fold) == f, rows, cols, partial(boosted.held_out, f))


class FitRows:
    """``df`` read once for boosted fits of ``label`` on any of its ``features``, held out (and weighted) by ``keys``."""

    def __init__(self, df: DataFrame, features: Sequence[str], label: str, keys: dict[str, Column], weighted: bool):
        self.features, self.label, self.weighted = list(dict.fromkeys(features)), label, weighted
        self.rows = boosted.Rows(df, F.array(*filled(self.features).values()), label, keys)
        cores = df.sparkSession.sparkContext.defaultParallelism
        self.fits = max(1, min(MOST_FITS, cores * BOOSTED_ROWS_PER_CORE // max(1, self.rows.n)))

    def can_fit(self, est: Estimator, ready: DataFrame) -> bool:
        if not boosted.supported(est, ready) or est.getOrDefault("labelCol") != self.label:
            return False
        return not est.isSet("weightCol") or (self.weighted and est.getOrDefault("weightCol") == WEIGHT)

    def fit(self, est: Estimator, cols: Sequence[str], role: Callable, frame: DataFrame) -> Model:
        role = partial(boosted.trained, uses_validation(est), est.isSet("weightCol"), role)
        return self.rows.fit(est, [self.features.index(c) for c in cols], role, frame)

    def __enter__(self) -> FitRows:
        return self

    def __exit__(self, *_) -> None:
        self.rows.__exit__()


def at_a_time(rows: FitRows | None, fits: int) -> int:
    """How many fits to run at a time: ``fits``, or as many as suit ``rows``."""
    return fits if rows is None else rows.fits


def fit_rows(
    df: DataFrame, est: Estimator, features: Sequence[str], weighted: bool = False, **keys: Column
) -> FitRows | contextlib.nullcontext:
    """``df`` read once for fits like ``est`` if these are boosted trees, else None; for ``with``."""
    if not isinstance(est, GBTRegressor):
        return contextlib.nullcontext()
    return FitRows(df, features, est.getOrDefault("labelCol"), keys, weighted)


def _without_validation(est: Estimator) -> Estimator:
    out = est.copy()
    out.clear(out.getParam("validationIndicatorCol"))
    return out


def fold_values(df: DataFrame, fold: str, folds: Sequence[int] | None = None, whole: bool = True) -> list[int]:
    """The folds listed, or those of the data. A row that no fold predicts is an error.

    With ``whole=False`` a list may leave folds out on purpose, which warns.
    """
    found = [r[0] for r in df.select(fold).distinct().collect()]
    if None in found:
        raise ValueError(f"some rows have no {fold}")
    if folds is None:
        return sorted(found)
    lost = sorted(set(found) - set(folds))
    if lost and whole:
        raise ValueError(f"listed folds leave out {fold} {lost}")
    if lost:
        warnings.warn(f"rows of {fold} {lost} are not validated", stacklevel=3)
    return list(folds)


def check_segments(df: DataFrame, segment: str, segments: Sequence[object]) -> None:
    """Every segment of the data must be listed, or nobody predicts its rows."""
    lost = [r[0] for r in df.select(segment).distinct().collect() if r[0] not in set(segments)]
    if lost:
        raise ValueError(f"no model for {segment} {lost}")


def cross_predict(
    df: DataFrame,
    make: Callable[[], Estimator],
    features: Sequence[str],
    key: str = "building_id",
    fold: str = "fold",
    folds: Sequence[int] | None = None,
    test: DataFrame | None = None,
    steps: Callable[[], FeatureSteps] | None = None,
    parallelism: int | None = None,
) -> CrossResult:
    """Fit on all folds but one, predict that one and the test set.

    Feature steps are fitted per fold on its train rows only; a rare value that
    the test set holds too is kept. Give a frame that
    is cheap to read again (a written table): each fold scans it once. Folds are
    those of the data unless listed. ``parallelism`` follows from the rows unless given.
    """
    folds = fold_values(df, fold, folds)
    parts, fits = fit_layout(df)
    few = in_parts(assemble(df, features), parts) if steps is None else None

    def one_fold(f: int) -> tuple[DataFrame, DataFrame | None, Model]:
        train, val, other = df.where(F.col(fold) != f), df.where(F.col(fold) == f), test
        cols = list(features)
        if steps is not None:
            fitted = steps().fit(train, test)
            # A learner reads its input many times: write the transformed fold once.
            train, val = stored(fitted.transform(train, is_train=True)), stored(fitted.transform(val))
            other = None if test is None else fitted.transform(test)
            cols = fitted.features()
        val = assemble(val, cols)
        if steps is None:
            model = fit_fold(make(), few, F.col(fold) == f, rows, features, partial(boosted.held_out, f))
        else:
            model = fit_on(make(), assemble(train, cols), val, parts)
        raw = None
        if other is not None:
            raw = model.transform(assemble(other, cols)).select(key, F.col("y_raw").alias(f"target_{f}"))
        return model.transform(val).drop(FEATURES), raw, model

    with fit_rows(df, make(), features, fold=F.col(fold)) if steps is None else contextlib.nullcontext() as rows:
        done = run_all([partial(one_fold, f) for f in folds], parallelism or at_a_time(rows, fits))
    out_test = None
    if test is not None:
        # All folds predict the same ids: one grouped pass in place of a join per fold.
        names = [f"target_{f}" for f in folds]
        stacked = union_rows(*[raw for _, raw, _ in done])
        out_test = stacked.groupBy(key).agg(*[F.max(c).alias(c) for c in names])
    return CrossResult(union_rows(*[held for held, _, _ in done]), out_test, [model for _, _, model in done])


def kfold_test(result: CrossResult, folds: Sequence[int], log: bool = True) -> DataFrame:
    """Mean of the folds' raw test predictions, then back to a price (total-price targets)."""
    mean = row_mean([f"target_{f}" for f in folds])
    return result.test.withColumn("total_price", target_inverse(mean, log=log, per_area=False))


def refit_full(
    df: DataFrame, make: Callable[[int], Estimator], features: Sequence[str], best_iterations: Sequence[int],
    growth: float = REFIT_GROWTH, steps: Callable[[], FeatureSteps] | None = None, test: DataFrame | None = None,
) -> Model | tuple[Model, FeatureSteps]:
    """One model on all rows, with the mean best iteration grown by a factor.

    With feature steps, fitted on all rows (rare values of ``test`` are kept), the
    result is the model and the fitted steps that rows to predict must pass first.
    """
    rounds = max(1, int(sum(best_iterations) / len(best_iterations) * growth))
    if steps is None:
        return fit_on(make(rounds), assemble(df, features))
    fitted = steps().fit(df, test)
    ready = stored(fitted.transform(df, is_train=True))
    return fit_on(make(rounds), assemble(ready, fitted.features())), fitted


def segment_models(
    df: DataFrame,
    segment: str,
    segments: Sequence[object],
    make: Callable[[], Estimator],
    features: Sequence[str],
    fold: str = "fold",
    folds: Sequence[int] | None = None,
    duplicate: bool = False,
    parallelism: int | None = None,
    steps: Callable[[], FeatureSteps] | None = None,
    test: DataFrame | None = None,
) -> DataFrame:
    """One model per segment and fold; each predicts its own segment.

    ``duplicate`` trains on all rows and counts the segment twice, through a
    row weight in place of copied rows. Every segment of the data must be listed.
    Feature steps are fitted per fold on its train rows of all segments; a rare
    value that ``test`` holds too is kept.
    """
    folds, segments = fold_values(df, fold, folds, whole=False), list(segments)
    check_segments(df, segment, segments)
    parts, fits = fit_layout(df)
    ready = assemble(df, features) if steps is None else None

    def halves(f: int) -> tuple[DataFrame, DataFrame]:
        train, val = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        fitted = steps().fit(train, test)
        train, val = stored(fitted.transform(train, is_train=True)), stored(fitted.transform(val))
        return assemble(train, fitted.features()), assemble(val, fitted.features())

    split = {}
    if steps is not None:
        split = dict(zip(folds, run_all([partial(halves, f) for f in folds], parallelism or fits)))

    def one(f: int, s: object) -> DataFrame:
        mine, held = F.col(segment) == F.lit(s), F.col(fold) == f
        twice = F.when(mine & ~held, F.lit(2.0)).otherwise(F.lit(1.0)) if duplicate else F.lit(1.0)
        trained = (mine | ~held) if duplicate else mine
        if steps is None:
            target_rows = ready.where(mine & held).withColumn(WEIGHT, F.lit(1.0))
            role = partial(boosted.segment_role, f, segments.index(s), duplicate)
            model = fit_fold(make(), in_parts(ready.where(trained).withColumn(WEIGHT, twice), parts), held, rows, features, role)
        else:
            train, val = split[f]
            target_rows = val.where(mine).withColumn(WEIGHT, F.lit(1.0))
            model = fit_on(make(), train.where(trained).withColumn(WEIGHT, twice), target_rows, parts)
        return model.transform(target_rows).drop(FEATURES, WEIGHT)

    number = F.lit(-1)
    for i, s in enumerate(segments):
        number = F.when(F.col(segment) == F.lit(s), F.lit(i)).otherwise(number)
    shared = contextlib.nullcontext()
    if steps is None:
        shared = fit_rows(df, make(), features, weighted=True, fold=F.col(fold), segment=number)
    with shared as rows:
        return union_rows(*run_all([partial(one, f, s) for f in folds for s in segments], parallelism or at_a_time(rows, fits)))


def group_classifier(
    df: DataFrame,
    label: str,
    features: Sequence[str],
    test: DataFrame | None = None,
    key: str = "building_id",
    fold: str = "fold",
    folds: Sequence[int] | None = None,
    max_iter: int = 10,
    depth: int = 4,
    seed: int = 555,
) -> tuple[DataFrame, DataFrame | None, list[dict]]:
    """Binary classifier per fold: held-out groups, test votes, and fold metrics."""
    folds = fold_values(df, fold, folds)
    held, votes, scores = [], [], []
    ready = assemble(df, features)
    other = None if test is None else assemble(test, features)
    for f in folds:
        est = GBTClassifier(
            featuresCol=FEATURES, labelCol=label, predictionCol="__c", maxIter=max_iter, maxDepth=depth, seed=seed,
            validationIndicatorCol=IS_VAL,
        ).setProbabilityCol("__p").setRawPredictionCol("__r")
        val = ready.where(F.col(fold) == f)
        model = fit_fold(est, ready, F.col(fold) == f)
        prob = vector_to_array(F.col("__p"))[1]
        cut = lambda d: d.withColumn("prob", prob).withColumn("price_group_pred", (F.col("prob") >= CLASS_CUT).cast("int"))
        scored = cut(model.transform(val)).select(key, label, fold, "prob", "price_group_pred")
        row = scored.agg(
            M.accuracy(label, "price_group_pred").alias("acc"), M.log_loss(label, "prob").alias("logloss")
        ).first()
        area = M.auc(scored, label, "prob").first()["auc"]
        scores.append({"fold": f, "acc": row["acc"], "auc": area, "logloss": row["logloss"], "best_iter": best_iteration(model)})
        held.append(scored)
        if other is not None:
            votes.append(cut(model.transform(other)).select(key, F.col("price_group_pred").alias(f"price_group_pred_{f}")))
    out_test = None
    if other is not None:
        names = [f"price_group_pred_{f}" for f in folds]
        out_test = union_rows(*votes).groupBy(key).agg(*[F.max(c).alias(c) for c in names])
        out_test = out_test.withColumn("price_group_pred", row_vote(names))
    return union_rows(*held), out_test, scores


@dataclass
class LinearStack:
    """A fitted linear stack on log predictions."""

    preds: list[str]
    coefficients: list[float]
    intercept: float
    alpha: float
    scores: DataFrame
    area: str | None = None

    def prediction(self):
        return linear_price(self.preds, self.coefficients, self.intercept, self.area)


def _log_inputs(preds: Sequence[str], area: str | None):
    factor = F.lit(1.0) if area is None else F.col(area).cast("double")
    return [F.log1p(F.try_divide(F.col(p), factor)) for p in preds]


def linear_price(preds, coefficients, intercept, area):
    price = F.expm1(row_dot(_log_inputs(preds, area), coefficients) + F.lit(float(intercept)))
    return price if area is None else price * F.col(area)


def stack_linear(
    df: DataFrame,
    y_true: str,
    preds: Sequence[str],
    alphas: Sequence[float] = STACK_ALPHAS,
    area: str | None = None,
    fold: str = "fold",
    folds: Sequence[int] | None = None,
) -> LinearStack:
    """Least squares or Lasso of the log price on log predictions.

    The penalty with the best mean held-out score is refitted on all rows. Two scans
    serve all folds and penalties (see ``models.lasso``): one for the moments of each
    fold, one for the held-out scores. Rows with gaps are an error.
    """
    ready, inputs = stack_inputs(df, y_true, preds, area)
    folds = fold_values(df, fold, folds)
    moments = fold_moments(ready, inputs, "__y", fold)
    whole = reduce(Moments.__add__, moments.values())
    lines = {int(f): lines_of(whole - moments[int(f)], alphas) for f in folds}
    scored = held_out_scores(ready, y_true, inputs, area, fold, {f: [ls[float(a)] for a in alphas] for f, ls in lines.items()})
    rows = [(float(a), int(f), scored[int(f)][i]) for f in folds for i, a in enumerate(alphas)]
    means = {a: sum(s for b, _, s in rows if b == a) / len(list(folds)) for a in alphas}
    best = max(alphas, key=lambda a: means[a])
    final = lines_of(whole, alphas)[float(best)]
    table = df.sparkSession.createDataFrame(rows, "alpha double, fold int, score double")
    return LinearStack(list(preds), [float(c) for c in final.coefficients], final.intercept, float(best), table, area)


def stack_inputs(df: DataFrame, y_true: str, preds: Sequence[str], area: str | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with log predictions ``__x<i>`` and the log price ``__y``, per area if one is named."""
    factor = F.lit(1.0) if area is None else F.col(area).cast("double")
    logs = {f"__x{i}": x for i, x in enumerate(_log_inputs(preds, area))}
    return df.withColumns({**logs, "__y": F.log1p(F.try_divide(F.col(y_true), factor))}), list(logs)


def stack_boosted(
    df: DataFrame, y_true: str, preds: Sequence[str], make: Callable[[str], Estimator], fold: str = "fold",
    folds: Sequence[int] | None = None, extra: Sequence[str] = (),
) -> CrossResult:
    """Boosted trees over the log predictions of many models."""
    logs = {f"log_{p}": F.log1p(F.col(p)) for p in preds}
    ready = df.withColumns({**logs, "log_target": F.log1p(F.col(y_true))})
    result = cross_predict(ready, lambda: make("log_target"), [*logs, *extra], fold=fold, folds=folds)
    result.oof = result.oof.withColumn("y_pred", target_inverse("y_raw", log=True, per_area=False))
    return result
