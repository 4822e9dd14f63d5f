"""Parameter grids, random search and feature-count sweeps with fold scores."""

from __future__ import annotations

import contextlib
import random
from collections.abc import Callable, Sequence
from functools import partial
from itertools import product

from pyspark.ml import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pricelab.models.boosted import held_out
from pricelab.models.jobs import FEATURES, FitRows, assemble, at_a_time, best_iteration, fit_fold, fit_layout, fit_rows, fold_values, in_parts, run_all
from pricelab.operators import metrics as M

# The metrics kept per fold of a search.
FOLD_METRICS = ("score", "mse", "mae", "mape")

RESULT_SCHEMA = (
    "params map<string,string>, score double, mse double, mae double, mape double, "
    "best_iterations array<double>, scores array<double>, mses array<double>, maes array<double>, mapes array<double>"
)


def fold_scores(
    df: DataFrame, est: Estimator, features: Sequence[str], target: str, inverse: Column, price: str, fold: str, f: int,
    parts: int | None = None, rows: FitRows | None = None,
) -> dict:
    """Fit on the other folds and score the held-out one in a single aggregate; the fit takes at most ``parts`` parts, or ``rows``."""
    ready, held = assemble(df, features), F.col(fold) == f
    model = fit_fold(est, in_parts(ready, parts), held, rows, features, partial(held_out, f))
    row = model.transform(ready.where(held)).agg(
        M.hit_score(price, inverse).alias("score"), M.mse(target, "y_raw").alias("mse"),
        M.mae(target, "y_raw").alias("mae"), M.mape(target, "y_raw").alias("mape"),
    ).first()
    return {**row.asDict(), "best_iteration": best_iteration(model)}


def results_table(spark: SparkSession, runs: Sequence[tuple[dict, list[dict]]]) -> DataFrame:
    """One row per parameter set: mean metrics and the fold lists."""
    rows = []
    for params, folds in runs:
        lists = {m: [float(f[m]) for f in folds] for m in FOLD_METRICS}
        means = [sum(lists[m]) / len(lists[m]) for m in FOLD_METRICS]
        rounds = [float(f["best_iteration"]) for f in folds]
        rows.append(({k: str(v) for k, v in params.items()}, *means, rounds, *[lists[m] for m in FOLD_METRICS]))
    return spark.createDataFrame(rows, RESULT_SCHEMA).orderBy(F.desc("score"))


def draw_params(space: dict[str, Sequence], n: int, seed: int, seeds: Sequence[dict] = ()) -> list[dict]:
    """Known-good sets first, then unique seeded draws (fewer when the space is smaller)."""
    out = [dict(s) for s in seeds]
    total = 1
    for values in space.values():
        total *= len(values)
    rng = random.Random(seed)
    inside = sum(1 for s in out if set(s) == set(space) and all(s[k] in space[k] for k in space))
    want = min(n, total - inside + len(out))
    while len(out) < want:
        drawn = {k: rng.choice(list(v)) for k, v in space.items()}
        if drawn not in out:
            out.append(drawn)
    return out


def random_search(
    df: DataFrame,
    make: Callable[[dict], Estimator],
    params: Sequence[dict],
    features_of: Callable[[dict], Sequence[str]],
    target: str,
    inverse: Column,
    price: str = "total_price",
    fold: str = "fold",
    folds: Sequence[int] | None = None,
    floor: float | None = None,
    floor_on: str = "every",
    parallelism: int | None = None,
    keep_pruned: bool = False,
    done: Sequence[tuple[dict, int, dict]] = (),
    rows: FitRows | None = None,
) -> DataFrame:
    """Score parameter sets fold by fold; a set below the floor drops out.

    ``floor_on`` tests the floor after every fold or after the first only. The
    fold that failed is not recorded, unless ``keep_pruned`` asks for a row of every
    set with all folds it reached and ``pruned_at``, the fold at which it dropped out
    (null when it did not). ``done`` names scores that the caller already has from
    :func:`fold_scores`, as (set, fold, scores): those are not fitted again. ``rows``
    is ``df`` as :func:`fit_rows` gives it; it is read here if it is not given.
    """
    folds = fold_values(df, fold, folds, whole=False)
    parts, fits = fit_layout(df)

    def scores(p: dict, f: int) -> dict:
        had = [found for q, g, found in done if q == p and g == f]
        return had[0] if had else fold_scores(df, make(p), features_of(p), target, inverse, price, fold, f, parts, rows)

    with contextlib.nullcontext(rows) if rows is not None or not params else _rows(df, make(params[0]), map(features_of, params), fold) as rows:
        return _searched(df, params, folds, scores, floor, floor_on, parallelism or at_a_time(rows, fits), keep_pruned)


def _rows(df, est, feature_sets, fold):
    """``df`` read once for fits on any of some sets of features."""
    return fit_rows(df, est, [c for cols in feature_sets for c in cols], fold=F.col(fold))


def _searched(df, params, folds, scores, floor, floor_on, fits, keep_pruned) -> DataFrame:
    alive = [dict(p) for p in params]
    runs: dict[int, tuple[dict, list[dict]]] = {}
    pruned: dict[int, int] = {}
    for i, f in enumerate(folds):
        kept = []
        tasks = [partial(scores, p, f) for p in alive]
        for p, scored in zip(alive, run_all(tasks, fits)):
            tested = floor is not None and (floor_on == "every" or i == 0)
            key = params.index(p)
            if tested and scored["score"] < floor:
                if keep_pruned:
                    pruned[key] = int(f)
                    runs.setdefault(key, (p, []))[1].append(scored)
                continue
            kept.append(p)
            runs.setdefault(key, (p, []))[1].append(scored)
        alive = kept
    out = results_table(df.sparkSession, [runs[k] for k in sorted(runs)])
    if not keep_pruned:
        return out
    dropped = [({k: str(v) for k, v in params[i].items()}, f) for i, f in pruned.items()]
    text = lambda c: F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))
    at = df.sparkSession.createDataFrame(dropped, "params map<string,string>, pruned_at int").select(text("params").alias("__set"), "pruned_at")
    marked = out.withColumn("__set", text("params")).join(F.broadcast(at), "__set", "left").drop("__set")
    return marked.orderBy(F.col("pruned_at").isNotNull(), F.desc("score"))


def grid_around(best: Sequence[dict], space: dict[str, Sequence]) -> list[dict]:
    """The best sets and their neighbours: one parameter moved by one grid place."""
    out: list[dict] = []
    for b in best:
        for cand in [b] + [
            {**b, k: values[j]}
            for k, values in space.items()
            for j in (list(values).index(b[k]) - 1, list(values).index(b[k]) + 1)
            if 0 <= j < len(values)
        ]:
            if cand not in out:
                out.append(cand)
    return out


def full_grid(space: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(space, combo)) for combo in product(*space.values())]


def param_grid(
    df: DataFrame, est: Estimator, space: dict[str, Sequence], features: Sequence[str], target: str, folds: int | None = None,
    fold: str = "fold", parallelism: int | None = None, top: int = 3,
) -> DataFrame:
    """Grid over the Cartesian product, then a finer grid around the top sets: rows (search_round, params, rmse).

    The fits of all sets and folds of a round run in one queue; nothing is refitted on all rows.
    """
    found = fold_values(df, fold)
    if folds is not None and found != list(range(folds)):
        raise ValueError(f"{fold} must hold 0 to {folds - 1}, found {found}")
    parts, fits = fit_layout(df)
    ready = assemble(df, features).select(FEATURES, target, fold)
    few = in_parts(ready, parts)
    evaluator = RegressionEvaluator(labelCol=target, predictionCol="y_raw", metricName="rmse")

    def rmse(params: dict, f: int) -> float:
        held = F.col(fold) == f
        model = fit_fold(est.copy({est.getParam(k): v for k, v in params.items()}), few, held, rows, features, partial(held_out, f))
        return evaluator.evaluate(model.transform(ready.where(held)))

    def run(grid: Sequence[dict]) -> list[tuple[dict, float]]:
        scores = run_all([partial(rmse, p, f) for p in grid for f in found], parallelism or at_a_time(rows, fits))
        by_set = [scores[i : i + len(found)] for i in range(0, len(scores), len(found))]
        return [(p, sum(of) / len(of)) for p, of in zip(grid, by_set)]

    first_maps = ParamGridBuilder()
    for k, values in space.items():
        first_maps = first_maps.addGrid(est.getParam(k), list(values))
    with fit_rows(df, est, features, fold=F.col(fold)) as rows:
        first = run([{p.name: v for p, v in m.items()} for m in first_maps.build()])
        best = [p for p, _ in sorted(first, key=lambda r: r[1])[:top]]
        tried = [p for p, _ in first]
        finer = [p for p in grid_around_numeric(best) if p not in tried]
        second = run(finer) if finer else []
    table = [(i, {k: str(v) for k, v in p.items()}, float(s)) for i, part in ((1, first), (2, second)) for p, s in part]
    return df.sparkSession.createDataFrame(table, "search_round int, params map<string,string>, rmse double")


def grid_around_numeric(best: Sequence[dict]) -> list[dict]:
    """Second-round sets: each number of a good set moved down and up by a step."""
    out: list[dict] = []
    for b in best:
        for k, v in b.items():
            for moved in ([v - 1, v + 1] if isinstance(v, int) else [v * 0.8, v * 1.25]):
                if moved > 0 and {**b, k: moved} not in out:
                    out.append({**b, k: moved})
    return out


def step_removal(
    df: DataFrame, make: Callable[[], Estimator], ranked: Sequence[str], features: Sequence[str], counts: Sequence[int],
    target: str, inverse: Column, price: str = "total_price", fold: str = "fold", folds: Sequence[int] | None = None,
    parallelism: int | None = None,
) -> DataFrame:
    """Score after dropping the n least useful features, for each n."""
    folds = fold_values(df, fold, folds, whole=False)
    sets = [({"n_feats_rm": n}, [c for c in features if c not in set(ranked[:n])]) for n in counts]
    return _feature_sets(df, make, sets, target, inverse, price, fold, folds, parallelism)


def _feature_sets(df, make, sets, target, inverse, price, fold, folds, parallelism) -> DataFrame:
    """Results of named feature lists; the fits of all lists and folds run in one queue."""
    parts, fits = fit_layout(df)
    with _rows(df, make(), [cols for _, cols in sets], fold) as rows:
        tasks = [
            partial(fold_scores, df, make(), cols, target, inverse, price, fold, f, parts, rows) for _, cols in sets for f in folds
        ]
        scored = run_all(tasks, parallelism or at_a_time(rows, fits))
    runs = [(name, scored[i * len(folds) : (i + 1) * len(folds)]) for i, (name, _) in enumerate(sets)]
    return results_table(df.sparkSession, runs)


def single_addition(
    df: DataFrame, make: Callable[[], Estimator], base: Sequence[str], extra: Sequence[str], target: str, inverse: Column,
    price: str = "total_price", fold: str = "fold", folds: Sequence[int] | None = None, parallelism: int | None = None,
) -> DataFrame:
    """Score of the base features plus one more at a time (``none`` is the base itself)."""
    folds = fold_values(df, fold, folds, whole=False)
    sets = [({"added": "none"}, list(base)), *[({"added": name}, [*base, name]) for name in extra]]
    return _feature_sets(df, make, sets, target, inverse, price, fold, folds, parallelism)
