"""Weight search: every look at the data is one aggregate that serves many candidates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from pricelab.blend.candidates import blend_inputs, candidate_sums, evaluate, fold_products, second_moments, summary
from pricelab.blend.grid import GRID_METRICS, score_grid
from pricelab.functions.rows import row_dot, row_mean
from pricelab.models.jobs import fold_values
from pricelab.operators.metrics import score_weight_grid
from pricelab.operators.tables import top_results

# Fixed value: grid steps per unit of weight.
GRID_STEPS = 5

# Random moves scored together.
MOVES_PER_PASS = 40

# Step lengths tried along a search direction, all in one pass.
STEP_LENGTHS = (4.0, 2.0, 1.0, 0.5, 0.2, 0.05, 0.01, 0.001)

# Root mean square change of the log prediction in the first step of a start.
FIRST_MOVE = 0.05

# Points drawn as starts, starts followed, and the change of the log prediction below which two are one.
DRAWN_STARTS, LIVE_STARTS, SAME_POINT = 4, 4, 1e-4

# Polishing: changes of the log prediction tried along each axis, and most passes.
POLISH_STEPS, POLISH_PASSES = (1e-2, 2.5e-3, 6e-4, 1.5e-4, 4e-5, 1e-5, 2e-6), 60


def simplex_grid(n: int, steps: int = GRID_STEPS) -> list[tuple[float, ...]]:
    """All weight vectors of n models that sum to 1 in units of 1/steps."""

    def parts(slots: int, left: int) -> Iterator[tuple[int, ...]]:
        if slots == 1:
            yield (left,)
            return
        for first in range(left + 1):
            for rest in parts(slots - 1, left - first):
                yield (first, *rest)

    return [tuple(p / steps for p in combo) for combo in parts(n, steps)]


def simplex_grid_blend(
    df: DataFrame, y_true: str, preds: Sequence[str], steps: int = GRID_STEPS, metric: str = "score", log: bool = False, best: int | None = None
) -> DataFrame:
    """Score of every grid vector, or of the ``best``: rows (weight_id, w1.., metric), the same way at any grid size."""
    if metric in GRID_METRICS:
        return score_grid(df, y_true, preds, steps, metric, log, best)
    scored = score_weight_grid(df, y_true, preds, simplex_grid(len(preds), steps), metric, log)
    worst_first = metric == "log_loss"
    return scored if best is None else scored.orderBy(F.asc(metric) if worst_first else F.desc(metric), "weight_id").limit(best)


def random_refine_blend(
    df: DataFrame,
    y_true: str,
    preds: Sequence[str],
    start: Sequence[float] | str | None = None,
    sigma: float = 0.5 / GRID_STEPS,
    moves: int = 1000,
    batch: int = MOVES_PER_PASS,
    metric: str = "score",
    log: bool = False,
    seed: int = 42,
) -> DataFrame:
    """Random moves on the simplex from the best vector so far; every improvement is kept.

    Each move adds positive Gaussian steps to all weights but one, which takes
    the rest. A batch of moves is drawn around one vector and scored in one
    pass, so an improvement is followed from the next batch on. The start is the
    mean, the vector given, or a random point of the simplex for ``"random"``.
    """
    rng = np.random.default_rng(seed)
    n = len(preds)
    lower_better = metric != "score"
    loss = metric if lower_better else "mape"
    data = blend_inputs(df, y_true, preds, log=log).persist()
    look = lambda vectors: [e["loss"] if lower_better else e["score"] for e in evaluate(data, vectors, loss, log)]
    if isinstance(start, str) and start != "random":
        raise ValueError("start must be a vector, None or 'random'")
    if isinstance(start, str):
        start = rng.dirichlet(np.ones(n))
    best = np.array(start if start is not None else np.full(n, 1.0 / n), dtype=float)
    best_score = look([best])[0]
    found = [(0, [float(x) for x in best], float(best_score))]
    done = 0
    while done < moves:
        size = min(batch, moves - done)
        vectors = [_simplex_move(best, sigma, rng) for _ in range(size)]
        scores = look(vectors)
        order = np.argsort(scores) if lower_better else np.argsort(scores)[::-1]
        top = int(order[0])
        done += size
        if scores[top] < best_score if lower_better else scores[top] > best_score:
            best, best_score = vectors[top], scores[top]
            found.append((done, [float(x) for x in best], float(best_score)))
    data.unpersist()
    return df.sparkSession.createDataFrame(found, f"move int, weights array<double>, {metric} double")


def _simplex_move(weights: np.ndarray, sigma: float, rng: np.random.Generator) -> np.ndarray:
    while True:
        pick = rng.integers(len(weights))
        moved = weights + np.maximum(sigma * rng.standard_normal(len(weights)), 0.0)
        moved[pick] = 0.0
        if moved.sum() <= 1.0:
            moved[pick] = 1.0 - moved.sum()
            return moved


class WeightSearch:
    """Multi-start minimisation of a loss over log-scale blend weights.

    The prediction is ``expm1(w . x)`` times the optional area, with x the log
    predictions and a constant. One pass returns loss, slope and packed score of all
    trial points of all starts. Weights that stand at a bound and are pushed against
    it are frozen, and the quasi-Newton step is taken in the subspace of the others.
    Model outputs are nearly collinear, so steps are measured by the mean products of
    the inputs, taken once. Starts that meet are merged. Since some losses have kinks,
    the best point is then polished along the principal axes of the free weights and
    the weights themselves, all directions and steps in one pass, until none helps.
    The driver holds weight vectors and one matrix of their size.

    ``select="score"`` returns the weights with the best packed score seen in
    any evaluation, ``select="loss"`` those with the lowest loss seen.
    """

    def __init__(
        self,
        preds: Sequence[str],
        y_true: str,
        area: str | None = None,
        loss: str = "smooth",
        intercept: bool = True,
        bounds: Sequence[tuple[float | None, float | None]] | None = None,
        select: str = "score",
        max_iter: int = 15,
        tol: float = 1e-4,
        seed: int = 42,
    ):
        self.preds, self.y_true, self.area, self.loss = list(preds), y_true, area, loss
        self.intercept, self.select, self.max_iter, self.tol, self.seed = intercept, select, max_iter, tol, seed
        self.dim = len(self.preds) + (1 if intercept else 0)
        self.low = np.array([-np.inf if b is None or b[0] is None else b[0] for b in (bounds or [None] * self.dim)])
        self.high = np.array([np.inf if b is None or b[1] is None else b[1] for b in (bounds or [None] * self.dim)])

    def starts(self) -> list[np.ndarray]:
        """Every model alone, and points drawn evenly from the simplex of the models."""
        rng = np.random.default_rng(self.seed)
        alone = np.eye(len(self.preds), self.dim)
        drawn = np.zeros((DRAWN_STARTS, self.dim))
        drawn[:, : len(self.preds)] = rng.dirichlet(np.ones(len(self.preds)), DRAWN_STARTS)
        return [self._clip(w) for w in (*alone, *drawn)]

    def _clip(self, w: np.ndarray) -> np.ndarray:
        return np.clip(w, self.low, self.high)

    def fit(self, df: DataFrame) -> "WeightSearch":
        """Search on the rows of ``df``; its narrow inputs are kept for the passes."""
        data = blend_inputs(df, self.y_true, self.preds, self.area).persist()
        steps = self.passes(*second_moments(data, self.dim))
        asked = next(steps, None)
        while asked is not None:
            points, slopes = asked
            asked = _answer(steps, evaluate(data, points, self.loss, log=True, slopes=slopes))
        data.unpersist()
        return self

    def passes(self, metric: np.ndarray, target: np.ndarray) -> Iterator[tuple[list[np.ndarray], bool]]:
        """The search as a generator: yields (points, slopes wanted), takes their evaluations."""
        self.seen_best: dict | None = None
        self.least: dict | None = None
        self.metric = metric + np.eye(self.dim) * (1e-10 * np.trace(metric) / self.dim)
        self.inverse_metric = np.linalg.inv(self.metric)
        first = self._remember((yield [self._clip(self.inverse_metric @ target), *self.starts()], True))
        live = [{**p, "h": self.inverse_metric, "new": True} for p in first if self._usable(p)]
        # The least-squares point and the best of the others.
        live = live[:1] + sorted(live[1:], key=lambda p: p["loss"])[: LIVE_STARTS - 1]
        for _ in range(self.max_iter):
            trials, owner = [], []
            for k, p in enumerate(live):
                direction = self._direction(p)
                for step in STEP_LENGTHS:
                    trials.append(self._clip(p["w"] + step * direction))
                    owner.append(k)
            if not trials:
                break
            tried = self._remember((yield trials, True))
            after = []
            for k, p in enumerate(live):
                mine = [t for t, o in zip(tried, owner) if o == k and self._usable(t)]
                best = min(mine, key=lambda t: t["loss"], default=None)
                if best is not None and best["loss"] < p["loss"] - self.tol * abs(p["loss"]) * 1e-2:
                    after.append(self._curved(p, best))
                elif not p["new"]:
                    # The curvature estimate led nowhere: start it afresh from here.
                    after.append({**p, "h": self.inverse_metric, "new": True})
            live = self._apart(after)
        if self.least is not None:
            yield from self._polish(self.least)
        chosen = self.seen_best if self.select == "score" else self.least
        if chosen is None:
            raise ValueError("no start has a finite loss")
        self.weights = [float(x) for x in chosen["w"]]
        self.score, self.mape = float(chosen["score"]), float(chosen["mape"])

    def _frozen(self, w: np.ndarray, grad: np.ndarray) -> np.ndarray:
        """Weights at a bound that a step downhill would take beyond it."""
        return ((w <= self.low) & (grad > 0)) | ((w >= self.high) & (grad < 0))

    def _direction(self, p: dict) -> np.ndarray:
        """Quasi-Newton step in the subspace of the weights that are free to move."""
        free = ~self._frozen(p["w"], p["grad"])
        out = np.zeros(self.dim)
        if not free.any():
            return out
        for h, new in ((p["h"], p["new"]), (self.inverse_metric, True)):
            out[free] = -np.linalg.solve(np.linalg.inv(h)[np.ix_(free, free)], p["grad"][free])
            if out @ p["grad"] < 0:
                break
        if new:
            # First step of a start: move the log prediction by a few percent.
            p["h"], p["new"] = self.inverse_metric, True
            out *= FIRST_MOVE / np.sqrt(max(out @ self.metric @ out, 1e-300))
        return out

    def _apart(self, live: list[dict]) -> list[dict]:
        """The points without those that stand where a better one does."""
        out: list[dict] = []
        for p in sorted(live, key=lambda p: p["loss"]):
            gaps = [p["w"] - q["w"] for q in out]
            if all(np.sqrt(max(g @ self.metric @ g, 0.0)) > SAME_POINT for g in gaps):
                out.append(p)
        return out

    def _polish(self, best: dict) -> Iterator[tuple[list[np.ndarray], bool]]:
        """Pattern search from ``best``, all axes and steps in a pass, until none helps."""
        last = None
        for _ in range(POLISH_PASSES):
            w = best["w"]
            inside = np.flatnonzero((w > self.low) & (w < self.high))
            axes = [np.eye(self.dim)[j] / np.sqrt(self.metric[j, j]) for j in range(self.dim)]
            if len(inside):
                values, vectors = np.linalg.eigh(self.metric[np.ix_(inside, inside)])
                for value, vector in zip(values, vectors.T):
                    axis = np.zeros(self.dim)
                    axis[inside] = vector / np.sqrt(max(value, 1e-300))
                    axes.append(axis)
            points = [self._clip(w + sign * step * axis) for axis in axes for step in POLISH_STEPS for sign in (1.0, -1.0)]
            if last is not None:
                points += [self._clip(w + far * (w - last)) for far in (1.0, 3.0)]
            found = [p for p in self._remember((yield points, False)) if p["loss"] is not None and np.isfinite(p["loss"])]
            top = min(found, key=lambda p: p["loss"], default=best)
            if top["loss"] >= best["loss"] - 1e-9 * abs(best["loss"]):
                return
            last, best = w, top

    @staticmethod
    def _usable(p: dict) -> bool:
        return p["loss"] is not None and np.isfinite(p["loss"]) and bool(np.all(np.isfinite(p["grad"])))

    def _curved(self, old: dict, new: dict) -> dict:
        """Update the inverse-curvature estimate from one step."""
        s, d = new["w"] - old["w"], new["grad"] - old["grad"]
        h, sd = old["h"], s @ d
        if sd > 1e-12 * np.linalg.norm(s) * max(np.linalg.norm(d), 1e-300) and sd > 0:
            if old["new"]:
                h = self.inverse_metric * (sd / (d @ self.inverse_metric @ d))
            left = np.eye(self.dim) - np.outer(s, d) / sd
            h = left @ h @ left.T + np.outer(s, s) / sd
            return {**new, "h": h, "new": False}
        return {**new, "h": self.inverse_metric, "new": True}

    def _remember(self, points: list[dict]) -> list[dict]:
        for p in points:
            if p["score"] is None or p["mape"] is None or not np.isfinite(p["mape"]) or not np.isfinite(p["loss"]):
                continue
            if self.seen_best is None or p["score"] > self.seen_best["score"]:
                self.seen_best = p
            if self.least is None or p["loss"] < self.least["loss"]:
                self.least = p
        return points

    def log_prediction(self) -> Column:
        """``w . x`` for a frame with the original columns."""
        area = F.lit(1.0) if self.area is None else F.col(self.area).cast("double")
        xs = [F.log1p(F.try_divide(F.col(p), area)) for p in self.preds] + ([F.lit(1.0)] if self.intercept else [])
        return row_dot(xs, self.weights)

    def prediction(self) -> Column:
        """Blended price, clipped at zero."""
        price = F.greatest(F.expm1(self.log_prediction()), F.lit(0.0))
        return price if self.area is None else price * F.col(self.area)


def optimize_weights(df: DataFrame, y_true: str, preds: Sequence[str], **options: object) -> WeightSearch:
    return WeightSearch(preds, y_true, **options).fit(df)


def _answer(steps: Iterator, found: list[dict]):
    """The search's next question after these evaluations; None when it is done."""
    try:
        return steps.send(found)
    except StopIteration:
        return None


def fold_weight_ensemble(
    df: DataFrame, y_true: str, preds: Sequence[str], fold: str = "fold", folds: Sequence[int] | None = None, **options: object
) -> tuple[list[WeightSearch], list[float], list[float], Column]:
    """Weights per fold, their held-out scores, the mean vector and the mean-of-folds prediction.

    Each fold's weights come from the other folds' rows and are scored on its own. The
    searches of all folds go in step: one pass returns the sums of all their points per
    fold, and a search's loss is that of all folds less its own.
    """
    folds = [int(f) for f in fold_values(df, fold, folds)]
    searches = {f: WeightSearch(preds, y_true, **options) for f in folds}
    one = searches[folds[0]]
    data = blend_inputs(df, y_true, preds, one.area, fold=fold).persist()
    products = fold_products(data, one.dim, by_fold=True)
    steps = {}
    for f, search in searches.items():
        others = [p for g, p in products.items() if g != f]
        n, total = sum(p[0] for p in others), sum((p[1] for p in others), np.zeros((one.dim + 1, one.dim)))
        steps[f] = search.passes(total[: one.dim] / max(n, 1), total[one.dim] / max(n, 1))
    asked = {f: next(s) for f, s in steps.items()}
    while asked:
        points = [w for ps, _ in asked.values() for w in ps]
        sums = candidate_sums(data, points, one.loss, True, any(slopes for _, slopes in asked.values()), by_fold=True)
        begin, after = 0, {}
        for f, (ps, _) in asked.items():
            train = [sum(s for g in products if g != f and (s := sums.get((g, begin + k))) is not None) for k in range(len(ps))]
            question = _answer(steps[f], [summary(w, t) for w, t in zip(ps, train)])
            begin += len(ps)
            if question is not None:
                after[f] = question
        asked = after
    fits = [searches[f] for f in folds]
    held = candidate_sums(data, [np.array(s.weights) for s in fits], one.loss, True, by_fold=True)
    data.unpersist()
    scores = [float(summary(np.array(s.weights), held[f, k])["score"]) for k, (f, s) in enumerate(zip(folds, fits))]
    mean = np.mean([s.weights for s in fits], axis=0)
    log_mean = row_mean([s.log_prediction() for s in fits])
    price = F.greatest(F.expm1(log_mean), F.lit(0.0))
    area = options.get("area")
    return fits, scores, [float(x) for x in mean], price if area is None else price * F.col(area)


def best_weights(scored: DataFrame, k: int, metric: str = "score") -> DataFrame:
    return top_results(scored, k, metric, ["weight_id"])
