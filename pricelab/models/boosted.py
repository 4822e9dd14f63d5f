"""Squared-error boosted trees of ``GBTRegressor``, grown from histograms of binned rows.

Spark's learner walks every row through JVM objects for each level of each tree, some
0.6 microseconds of a core each. Here a row is its bins, two features to a 16-bit code,
and its residual. Rows lie in blocks of arrays, and a level is one pass that sums weight
and residual per node and bin; the driver picks the splits of the level from these sums.
Trees, weights, stopping and node statistics are those of ``GBTRegressor`` with the same
parameters, and the result is its model class. Split candidates are the same too on up to
``ROWS_PER_READER`` rows: Spark looks at all of 10,000 rows, and its own code draws the sample
of more. On larger tables both look at a seeded sample, twice as large here.

On up to ``ROWS_IN_ONE_TASK`` rows one task grows all trees of a fit, with some 16 bytes of
a row in memory, and fits run side by side. A larger table lies in partitions that are kept
in memory or on disk; a task streams its blocks and holds one of them and the sums of one
level. Each round writes the residuals once.

Parameters that this does not cover (other losses, subsampling, feature subsets, more bins,
categorical features) are left to Spark's learner.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, functions as F

# Ship this module's task functions by value: workers need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows up to which one task grows all trees of a fit: passes of its own cost less than jobs.
ROWS_IN_ONE_TASK = 10_000_000

# A smaller table is read by one task too.
ROWS_PER_READER = 500_000

# Rows of a partition of a larger table, at most; each is streamed in blocks.
ROWS_PER_PART = 4_000_000

# Rows of a block: its codes and residuals stay in a core's cache.
BLOCK = 1 << 15

# Rows that split candidates are taken from on large tables.
SPLIT_ROWS = 20_000

# Rows that Spark looks at for them; of fewer it takes all.
SPARK_SPLIT_ROWS = 10_000

# A code holds the bins of two features, five bits each (six if rounding gives one bin more than asked for).
BITS = 5

# Child nodes of less impurity are leaves, as in Spark.
EPSILON = 2.220446049250313e-16

Block = tuple[bool, np.ndarray, np.ndarray, "np.ndarray | None", "tuple | None"]


@dataclass(frozen=True)
class Params:
    """What the growth of the trees depends on."""

    rounds: int
    depth: int
    step: float
    bins: int
    min_rows: int
    min_gain: float
    seed: int
    tol: float
    validated: bool


def supported(est: Estimator, df: DataFrame) -> bool:
    """Whether :func:`fit` grows the trees itself."""
    if type(est) is not GBTRegressor:
        return False
    value = lambda name: est.getOrDefault(name)
    weighted = est.isSet("weightCol")
    attrs = str(df.schema[value("featuresCol")].metadata.get("ml_attr", {}).get("attrs", {}))
    return (
        value("lossType") == "squared" and value("subsamplingRate") == 1.0 and value("featureSubsetStrategy") in ("all", "auto")
        and value("maxBins") <= 1 << BITS and value("minWeightFractionPerNode") == 0.0 and value("maxDepth") <= 10
        and (value("minInstancesPerNode") == 1 or not weighted) and "nominal" not in attrs and "binary" not in attrs
    )


def params_of(est: GBTRegressor) -> Params:
    value = lambda name: est.getOrDefault(name)
    return Params(
        value("maxIter"), value("maxDepth"), value("stepSize"), value("maxBins"), value("minInstancesPerNode"),
        value("minInfoGain"), value("seed"), value("validationTol"), est.isSet("validationIndicatorCol"),
    )


def fit(est: Estimator, df: DataFrame) -> Model:
    """``est.fit(df)``."""
    if not supported(est, df):
        return est.fit(df)
    value = lambda name: est.getOrDefault(name)
    keys = {}
    if est.isSet("validationIndicatorCol"):
        keys["val"] = F.col(value("validationIndicatorCol")).cast("double")
    if est.isSet("weightCol"):
        keys["w"] = F.col(value("weightCol")).cast("double")
    with Rows(df, vector_to_array(value("featuresCol")), value("labelCol"), keys) as rows:
        return rows.fit(est, None, _flagged, df)


def spark_cuts(est: GBTRegressor, df: DataFrame) -> list[np.ndarray]:
    """The split candidates that ``est.fit(df)`` draws."""
    jvm = df.sparkSession.sparkContext._jvm
    one = lambda package, name: getattr(getattr(package, f"{name}$"), "MODULE$")
    tree = jvm.org.apache.spark.ml.tree.impl
    if est.isSet("validationIndicatorCol"):
        df = df.where(~F.col(est.getOrDefault("validationIndicatorCol")))
    java = est._to_java()
    none, regression = one(jvm.scala.collection.immutable, "Map").empty(), one(jvm.org.apache.spark.mllib.tree.configuration, "Algo").Regression()
    strategy, reader = java.getOldBoostingStrategy(none, regression).treeStrategy(), one(jvm.org.apache.spark.ml.util, "DatasetUtils")
    instances = reader.extractInstances(java, df._jdf, getattr(reader, "extractInstances$default$3")())
    known = one(tree, "DecisionTreeMetadata").buildMetadata(instances, strategy, 1, est.getOrDefault("featureSubsetStrategy"))
    found = one(tree, "RandomForest").findSplits(instances, known, est.getOrDefault("seed"))
    return [np.array([s.threshold() for s in splits], float) for splits in found]


def _flagged(keys: dict[str, np.ndarray]) -> tuple:
    """All rows, held out and weighted by columns of theirs."""
    val, w = keys.get("val"), keys.get("w")
    if val is not None and np.isnan(val).any():
        raise ValueError("the validation flag must not be null")
    if w is not None and not (np.isfinite(w) & (w >= 0)).all():
        raise ValueError("weights must not be null, NaN, infinite or negative")
    return None, None if val is None else val != 0, w


def held_out(f: int, keys: dict[str, np.ndarray]) -> tuple:
    """Rows of fold ``f`` stop the rounds, the others are trained on."""
    return None, keys["fold"] == f, None


def trained(validated: bool, weighted: bool, role: Callable, keys: dict) -> tuple:
    """``role``, where rows held out only take part if they stop the rounds, and weights if the learner has them."""
    mine, val, w = role(keys)
    w = w if weighted else None
    if validated or val is None:
        return mine, val, w
    return ~val if mine is None else mine & ~val, None, w


def segment_role(f: int, number: int, duplicate: bool, keys: dict) -> tuple:
    """What a row is to the model of a segment and fold ; with ``duplicate`` its own rows count twice among all."""
    mine, held = keys["segment"] == number, keys["fold"] == f
    if not duplicate:
        return mine, held, None
    return mine | ~held, held, 1.0 + (mine & ~held)


class Rows:
    """The features, label and keys of ``df`` as arrays, read once and kept for any number of fits.

    ``keys`` are numeric columns by which a fit's ``role`` tells what a row is to it: it
    gets arrays by name and returns (rows in use or None for all, rows held out, weights or None).
    """

    def __init__(self, df: DataFrame, features: Column, label: str, keys: dict[str, Column]):
        self.df = df
        n = df.count()
        cores = df.sparkSession.sparkContext.defaultParallelism
        self.alone, self.n = n <= ROWS_IN_ONE_TASK, n
        self.parts = min(cores, -(-n // ROWS_PER_READER)) or 1
        if n > cores * ROWS_PER_PART:
            self.parts = -(-n // (cores * ROWS_PER_PART)) * cores
        cols = [c.cast("double").alias(f"k_{name}") for name, c in keys.items()]
        rows = df.select(features.alias("x"), F.col(label).cast("double").alias("y"), *cols).coalesce(self.parts)
        names = list(keys)

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, y, held in _gathered(batches, names):
                yield pa.RecordBatch.from_pydict({c: pa.array([v.tobytes()], pa.binary()) for c, v in (("x", x), ("y", y), ("keys", held))})

        def unpacked(row) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
            y = np.frombuffer(bytes(row["y"]))
            held = np.frombuffer(bytes(row["keys"])).reshape(len(names), len(y))
            return np.frombuffer(bytes(row["x"])).reshape(-1, len(y)), y, dict(zip(names, held))

        made = rows.mapInArrow(packed, "x binary, y binary, keys binary")
        self.kept = made.rdd.map(unpacked).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    def __enter__(self) -> Rows:
        return self

    def __exit__(self, *_) -> None:
        self.kept.unpersist()

    def fit(self, est: GBTRegressor, columns: list[int] | None, role: Callable, frame: DataFrame) -> Model:
        """The model of ``est`` on the features at ``columns`` (all, if None), that is ``est.fit(frame)``."""
        p = params_of(est)
        if self.parts == 1:
            cuts = spark_cuts(est, frame) if self.n > SPARK_SPLIT_ROWS else None
            made = self.kept.mapPartitions(partial(_whole, p, columns, role, cuts)).collect()
            if not made:
                raise ValueError("no rows to train on")
            width, trees = made[0]
        else:
            width, trees = _spread(self, p, columns, role)
        return _model(est, self.df, width, trees)


# Rows and blocks.


def _gathered(batches: Iterable[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """(features by column, labels, keys) of about ``BLOCK`` rows at a time; what Spark's learner refuses is an error."""
    held: list[pa.RecordBatch] = []

    def arrays() -> tuple[np.ndarray, ...]:
        t = pa.Table.from_batches(held).combine_chunks()
        y = t.column("y").to_numpy()
        x = t.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
        if not np.isfinite(y).all():
            raise ValueError("labels must not be null, NaN or infinite")
        if not np.isfinite(x).all():
            raise ValueError("features must not be null, NaN or infinite")
        keys = [t.column(f"k_{name}").to_numpy() for name in names]
        return np.ascontiguousarray(x.T), y, np.array(keys, float).reshape(len(names), len(y))

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            held.append(batch.slice(at, BLOCK))
            if sum(b.num_rows for b in held) >= BLOCK:
                yield arrays()
                held = []
    if sum(b.num_rows for b in held):
        yield arrays()


def _used(rows: Iterable[tuple], columns: list[int] | None, role: Callable) -> Iterator[tuple]:
    """(held out, features by column, labels, weights or None) of one fit, rows to train on apart from others."""
    for x, y, keys in rows:
        mine, val, w = role(keys)
        x = x if columns is None else x[columns]
        for part in (False, True):
            take = np.full(len(y), not part) if val is None else val == part
            take = take if mine is None else take & mine
            if take.any():
                weights = None if w is None or (w[take] == 1.0).all() else w[take]
                yield part, x[:, take], y[take], weights


def _drawn(used: Iterable[tuple], seed: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """The rows to train on with the least of as many seeded draws (x, w, draw), at most ``SPLIT_ROWS``; their number and that of others."""
    rng, kept, counts = np.random.default_rng(seed), None, [0, 0]
    for val, x, y, w in used:
        counts[val] += len(y)
        if not val:
            part = _least((x.T, np.ones(len(y)) if w is None else w, rng.random(len(y))))
            kept = part if kept is None else _least(tuple(map(np.concatenate, zip(kept, part))))
    return (*(kept or (np.zeros((0, 0)), np.zeros(0), np.zeros(0))), counts)


def _least(kept: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    if len(kept[2]) <= SPLIT_ROWS:
        return kept
    at = np.argpartition(kept[2], SPLIT_ROWS)[:SPLIT_ROWS]
    return tuple(a[at] for a in kept)


def thresholds(x: np.ndarray, w: np.ndarray, bins: int) -> list[np.ndarray]:
    """Split candidates of each column: midpoints of neighbouring values, all or at equal steps of weight."""
    splits = min(bins, len(x)) - 1
    out = []
    for column in x.T:
        values, place = np.unique(column, return_inverse=True)
        middle = (values[:-1] + values[1:]) / 2
        if len(middle) > splits:
            weight = np.bincount(place.ravel(), w)
            stride = weight.sum() / (splits + 1)
            taken, target, before = [], stride, weight[0]
            for i in range(1, len(values)):
                after = before + weight[i]
                if abs(before - target) < abs(after - target):
                    taken.append(i - 1)
                    target += stride
                before = after
            middle = middle[taken]
        out.append(middle)
    return out


def _blocks(used: Iterable[tuple], cuts: list[np.ndarray]) -> Iterator[Block]:
    """Blocks (held out, codes, residuals, weights or None for ones, None); a code is the bins of a pair of columns."""
    bits = bits_of([len(c) for c in cuts])
    for val, x, y, w in used:
        codes = np.zeros(((len(cuts) + 1) // 2, len(y)), np.uint16)
        for f, cut in enumerate(cuts):
            codes[f // 2] |= np.searchsorted(cut, x[f]).astype(np.uint16) << np.uint16(bits * (f % 2))
        yield val, codes, y.copy(), w, None


def bits_of(splits: Iterable[int]) -> int:
    """Bits of a bin where features have so many splits."""
    return max(BITS, *(int(n).bit_length() for n in splits)) if splits else BITS


# Passes over blocks.


def _walked(codes: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]], bits: int) -> np.ndarray:
    """The place of each row in the level below ``levels``, (feature, bin) of each node; below a leaf rows stay left."""
    pairs, n = codes.shape
    node, flat, line = np.zeros(n, np.int64), codes.ravel(), np.arange(n)
    for feature, cut in levels:
        begin, shift = (feature >> 1) * n, (feature & 1) * bits
        if len(feature) == 1:
            code = codes[feature[0] >> 1]
            node = (((code >> np.uint16(shift[0])) & np.uint16((1 << bits) - 1)) > cut[0]).astype(np.int64)
            continue
        code = flat.take(begin.take(node) + line)
        bin_of = (code >> shift.astype(np.uint16).take(node)) & np.uint16((1 << bits) - 1)
        node = 2 * node + (bin_of > cut.astype(np.uint16).take(node))
    return node


def _node_sums(node: np.ndarray, r: np.ndarray, w: np.ndarray | None, nodes: int) -> np.ndarray:
    """Rows, weight, sum and sum of squares of the residuals per node."""
    rows = np.bincount(node, minlength=nodes).astype(float)
    wr = r if w is None else w * r
    weight = rows if w is None else np.bincount(node, w, nodes)
    return np.stack([rows, weight, np.bincount(node, wr, nodes), np.bincount(node, wr * r, nodes)])


def _level(levels: list, splits: list[int], blocks: Iterable[Block]) -> tuple[np.ndarray, np.ndarray, tuple | None]:
    """Sums per node and bin of the level below ``levels``, sums per node, and those that the blocks carry."""
    nodes, pairs = 1 << len(levels), (len(splits) + 1) // 2
    bits = bits_of(splits)
    size = 1 << 2 * bits
    cells = np.zeros((2, pairs, nodes * size))
    sums, carried = np.zeros((4, nodes)), None
    for val, codes, r, w, more in blocks:
        if more is not None:
            carried = more if carried is None else tuple(a + b for a, b in zip(carried, more))
        if val:
            continue
        node = _walked(codes, levels, bits)
        sums += _node_sums(node, r, w, nodes)
        wr, base = r if w is None else w * r, node * size
        for i in range(pairs):
            cell = base + codes[i]
            cells[0, i] += np.bincount(cell, w, nodes * size)
            cells[1, i] += np.bincount(cell, wr, nodes * size)
    grid = cells.reshape(2, pairs, nodes, 1 << bits, 1 << bits)
    # The lower bits are the first feature of a pair.
    both = np.stack([grid.sum(axis=3), grid.sum(axis=4)], axis=2)
    return both.reshape(2, 2 * pairs, nodes, 1 << bits)[:, : len(splits)], sums, carried


def _updated(levels: list, values: np.ndarray, bits: int, block: Block) -> Block:
    """The block after a tree; it carries the sums per leaf before it, and the held-out error and weight after it."""
    val, codes, r, w, _ = block
    node = _walked(codes, levels, bits)
    leaves = np.zeros((4, len(values))) if val else _node_sums(node, r, w, len(values))
    r = r - values.take(node)
    error = np.zeros(2)
    if val:
        error[:] = [(r * r if w is None else w * r * r).sum(), len(r) if w is None else w.sum()]
    return val, codes, r, w, (leaves, error)


# Growth.


@dataclass
class Node:
    """A node of a grown tree; leaves have no ``feature``."""

    rows: float
    weight: float
    total: float
    squares: float
    gain: float = -1.0
    feature: int = -1
    threshold: float = 0.0
    left: Node | None = None
    right: Node | None = None

    @property
    def prediction(self) -> float:
        return self.total / self.weight if self.weight else 0.0

    @property
    def impurity(self) -> float:
        return (self.squares - self.total * self.total / self.weight) / self.weight if self.weight else 0.0


def _best_splits(cells: np.ndarray, sums: np.ndarray, splits: list[int], p: Params) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of the best split of each node; the first of equal ones. Gain is -1 where there is none."""
    left_w, left_s = np.cumsum(cells, axis=3)
    w, s = sums[1][None, :, None], sums[2][None, :, None]
    right_w, right_s = w - left_w, s - left_s
    least = max(p.min_rows, 1e-9)  # weights of rows that count are above this
    may = (left_w >= least) & (right_w >= least) & (np.arange(cells.shape[3]) < np.array(splits)[:, None, None])
    with np.errstate(all="ignore"):
        gain = (left_s * left_s / left_w + right_s * right_s / right_w - s * s / w) / w
    gain = np.where(may & (gain >= p.min_gain), gain, -1.0).transpose(1, 0, 2).reshape(len(sums[0]), -1)
    at = gain.argmax(axis=1)
    return gain[np.arange(len(at)), at], at // cells.shape[3], at % cells.shape[3]


def _grown(p: Params, cuts: list[np.ndarray], level: Callable, update: Callable) -> list[tuple[Node, float]]:
    """The trees and their weights. ``level(levels)`` sums a level, ``update(levels, values)`` takes a tree off the residuals."""
    splits = [len(c) for c in cuts]
    trees: list[tuple[Node, float]] = []
    best_error, best, pending = None, 0, None
    for m in range(p.rounds + 1):
        cells, sums, carried = level([])
        if pending is not None:
            leaves, error = carried
            trees.append(pending(leaves))
            if p.validated:
                if not error[1]:
                    raise ValueError("no rows to validate on")
                now = error[0] / error[1]
                if best_error is None:
                    best_error, best = now, 1
                elif best_error - now < p.tol * max(now, 0.01):
                    break
                elif now < best_error:
                    best_error, best = now, m
        if m == p.rounds:
            break
        # Later trees fit the slope of the squared error, twice the residual.
        scale, weight = (1.0, 1.0) if m == 0 else (2.0, p.step)
        levels, stats, gains = [], [], []
        live = np.ones(1, bool)
        for depth in range(p.depth):
            if depth:
                cells, sums, _ = level(levels)
            stats.append(sums * np.array([1, 1, scale, scale * scale])[:, None])
            gain, feature, cut = _best_splits(cells * np.array([1, scale]).reshape(2, 1, 1, 1), stats[-1], splits, p) if splits else (
                np.full(len(live), -1.0), np.zeros(len(live), np.int64), np.zeros(len(live), np.int64))
            with np.errstate(all="ignore"):
                _, w, s, ss = stats[-1]
                pure = np.abs((ss - s * s / w) / w) < EPSILON
            live = live & (gain > 0) & ~(pure & (depth > 0))
            gains.append(np.where(live, gain, -1.0))
            # Rows of a leaf stay left: no bin is above the last.
            levels.append((np.where(live, feature, 0), np.where(live, cut, 1 << bits_of(splits))))
            if not live.any():
                break
            live = np.repeat(live, 2)
        # The values of the leaves: each at the leftmost place below it.
        bottom = _bottom(stats, gains, cells * np.array([1, scale]).reshape(2, 1, 1, 1), levels)
        update(levels, bottom * weight)
        pending = partial(_tree, levels, stats, gains, cuts, scale, weight)
    return trees[:best] if p.validated else trees


def _bottom(stats: list, gains: list, cells: np.ndarray, levels: list) -> np.ndarray:
    """Predictions at the places below the last level."""
    out = np.zeros(1 << len(levels))
    for depth, (sums, gain) in enumerate(zip(stats, gains)):
        reached = np.ones(1, bool) if depth == 0 else np.repeat(gains[depth - 1] > 0, 2)
        for k in np.flatnonzero(reached & (gain <= 0)):
            out[k << (len(levels) - depth)] = sums[2, k] / sums[1, k] if sums[1, k] else 0.0
    feature, cut = levels[-1]
    for k in np.flatnonzero(gains[-1] > 0):
        w, s = cells[:, feature[k], k, : cut[k] + 1].sum(axis=1)
        out[2 * k], out[2 * k + 1] = s / w, (stats[-1][2, k] - s) / (stats[-1][1, k] - w)
    return out


def _tree(levels: list, stats: list, gains: list, cuts: list, scale: float, weight: float, leaves: np.ndarray) -> tuple[Node, float]:
    """The tree as nodes; two leaves of equal prediction become one, as in Spark."""
    leaves = leaves * np.array([1, 1, scale, scale * scale])[:, None]

    def node(depth: int, k: int) -> Node:
        here = Node(*map(float, (stats[depth] if depth < len(stats) else leaves)[:, k]))
        if depth == len(levels) or gains[depth][k] <= 0:
            return here
        left, right = node(depth + 1, 2 * k), node(depth + 1, 2 * k + 1)
        if left.left is None and right.left is None and left.prediction == right.prediction:
            return here
        f = int(levels[depth][0][k])
        here.gain, here.feature, here.threshold = float(gains[depth][k]), f, float(cuts[f][int(levels[depth][1][k])])
        here.left, here.right = left, right
        return here

    return node(0, 0), weight


def _whole(p: Params, columns: list[int] | None, role: Callable, cuts: list[np.ndarray] | None, rows: Iterable[tuple]) -> list[tuple]:
    """Number of features and all trees of one task's rows."""
    used = list(_used(rows, columns, role))
    if not used:
        return []
    if cuts is not None:
        return _rest(p, None, None, cuts, used)
    x, w, _, counts = _drawn(used, [p.seed % (1 << 63), 0])
    return _rest(p, None, None, _checked(x, w, counts, p), used)


def _rest(p: Params, columns: list[int] | None, role: Callable | None, cuts: list[np.ndarray], rows: Iterable[tuple]) -> list[tuple]:
    """:func:`_whole` with known cuts, over rows or (without ``role``) over what a fit uses of them."""
    splits = [len(c) for c in cuts]
    held = list(_blocks(rows if role is None else _used(rows, columns, role), cuts))

    def update(levels: list, values: np.ndarray) -> None:
        held[:] = [_updated(levels, values, bits_of(splits), b) for b in held]

    return [(len(cuts), _grown(p, cuts, lambda levels: _level(levels, splits, held), update))]


def _checked(x: np.ndarray, w: np.ndarray, counts: list, p: Params) -> list[np.ndarray]:
    if not counts[0]:
        raise ValueError("no rows to train on")
    if p.validated and not counts[1]:
        raise ValueError("no rows to validate on")
    return thresholds(x, w, p.bins)


def _spread(rows: Rows, p: Params, columns: list[int] | None, role: Callable) -> tuple[int, list[tuple[Node, float]]]:
    """Number of features and all trees of rows in many partitions; the trees grow there or, if they are few enough, in one task."""
    seed, parts = p.seed % (1 << 63), rows.parts
    sample = lambda i, part: [_drawn(_used(part, columns, role), [seed, i])]
    samples = rows.kept.mapPartitionsWithIndex(sample).collect()
    counts = [sum(s[3][i] for s in samples) for i in (0, 1)]
    found = [s[:3] for s in samples if len(s[1])]
    x, w, _ = _least(tuple(np.concatenate(a) for a in zip(*found))) if found else (None,) * 3
    cuts = _checked(x, w, counts, p)
    if rows.alone:
        return rows.kept.coalesce(1).mapPartitions(partial(_rest, p, columns, role, cuts)).collect()[0]
    splits = [len(c) for c in cuts]
    stored = rows.kept.mapPartitions(lambda part: _blocks(_used(part, columns, role), cuts)).persist(StorageLevel.MEMORY_AND_DISK_DESER)
    state = {"now": stored, "before": None}

    def level(levels: list):
        found = state["now"].mapPartitions(lambda blocks: [_level(levels, splits, blocks)])
        found = found.collect() if parts <= 64 else [found.treeReduce(_added)]
        if state["before"] is not None:
            state["before"].unpersist()
            state["before"] = None
        out = found[0]
        for more in found[1:]:
            out = _added(out, more)
        return out

    def update(levels: list, values: np.ndarray) -> None:
        state["before"] = state["now"]
        state["now"] = state["now"].map(partial(_updated, levels, values, bits_of(splits))).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    try:
        return len(cuts), _grown(p, cuts, level, update)
    finally:
        for kept in state.values():
            if kept is not None:
                kept.unpersist()


def _added(a: tuple, b: tuple) -> tuple:
    carried = a[2] if b[2] is None else b[2] if a[2] is None else tuple(x + y for x, y in zip(a[2], b[2]))
    return a[0] + b[0], a[1] + b[1], carried


# Spark's model.


def _below(n: Node) -> list[Node]:
    return [n] if n.left is None else [n, *_below(n.left), *_below(n.right)]


def _model(est: GBTRegressor, df: DataFrame, width: int, trees: list[tuple[Node, float]]) -> GBTRegressionModel:
    """The trees as Spark's own model, with the parameters of ``est``."""
    sc = df.sparkSession.sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    # Each name is looked up once, and all statistics cross over at once: a call costs far more than what it does.
    ml, part = jvm.org.apache.spark.ml, jvm.java.util.Arrays.copyOfRange
    leaf, inner, cut, tree = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.regression.DecisionTreeRegressionModel
    calculator = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    nodes = [n for root, _ in trees for n in _below(root)]
    stats = gateway.new_array(gateway.jvm.double, 3 * len(nodes))
    raw = np.array([(n.weight, n.total, n.squares) for n in nodes], ">f8").tobytes()
    jvm.java.nio.ByteBuffer.wrap(bytearray(raw)).asDoubleBuffer().get(stats)
    place = {id(n): i for i, n in enumerate(nodes)}

    def node(n: Node):
        at = 3 * place[id(n)]
        sums = calculator(part(stats, at, at + 3), int(n.rows))
        if n.left is None:
            return leaf(n.prediction, n.impurity, sums)
        return inner(n.prediction, n.impurity, n.gain, node(n.left), node(n.right), cut(n.feature, n.threshold), sums)

    roots = gateway.new_array(tree, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (root, weight) in enumerate(trees):
        roots[i], weights[i] = tree(node(root), width), weight
    model = est._copyValues(GBTRegressionModel(ml.regression.GBTRegressionModel(est.uid, roots, weights, width)))
    model._transfer_params_to_java()
    return model
