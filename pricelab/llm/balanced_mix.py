"""Mixing sources to target weights by balanced sampling with the cube method.

Each source gets a target number of words: shares by weight, none above
``cap`` times the source's own words, the excess shared again by weight. Within
a source every document has the expected number of repeats
``target / source words``: its whole part is taken for sure, its fractional part
is an inclusion probability.

The flight phase moves those probabilities along null-space directions of the
balancing constraints (one unit per document, its words, so that the expected
document and word totals stay exact) until each document but a few is at 0 or 1.
It runs in cells of bounded size: documents are dealt by a hash of identifier and
content, each cell leaves at most two undecided documents, and the undecided ones
of all cells fly again, until one cell holds all of a source. There the document
constraint is dropped for the shortest documents, which even out the words; the
landing rounds the one document that may be left and flips a few of the shortest
where that brings the words nearer the target. Coins come from a hash of seed, source and cell, so reruns agree.

Null texts have size 0 and a null source is a source of its own, weighed last.
Documents without words take nothing. A source without words has target 0. Ties
and repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import ship, whole_text, written

ship(__name__)

#: Documents that a cell of the flight holds on average.
CELL_ROWS = 4_096
#: Sources are few named collections; their totals are planned on the driver.
MAX_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def fill_targets(sizes: Sequence[float], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Shares of ``total`` by weight; what exceeds ``cap`` times a size is shared again among the rest."""
    target, fixed = [0.0] * len(sizes), [False] * len(sizes)
    while True:
        left = total - sum(t for t, f in zip(target, fixed) if f)
        weight = sum(w for w, f in zip(weights, fixed) if not f)
        if not weight:
            return target
        over = False
        for i, f in enumerate(fixed):
            if not f:
                target[i] = left * weights[i] / weight
        for i, f in enumerate(fixed):
            if not f and target[i] > cap * sizes[i]:
                target[i], fixed[i], over = cap * float(sizes[i]), True, True
        if not over:
            return target


def _coin(*parts) -> np.random.Generator:
    digest = hashlib.sha256(repr(parts).encode()).digest()
    return np.random.default_rng(int.from_bytes(digest[:8], "little"))


EPS = 1e-9


def flight(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: all 0 or 1 but two at most; sums of p and p * size are kept."""
    p = np.where((p <= EPS) | (p >= 1 - EPS), np.round(p), p)
    open_ = [i for i in range(len(p)) if 0 < p[i] < 1]
    held: list[int] = []
    while open_ or len(held) == 3:
        if len(held) < 3:
            held.append(open_.pop())
            continue
        a, b, c = held
        u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])  # no document, no word more or less
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = min(((1 - p[i]) / x if x > 0 else p[i] / -x) for i, x in zip(held, u) if x)
        down = min((p[i] / x if x > 0 else (1 - p[i]) / -x) for i, x in zip(held, u) if x)
        step = up if rng.random() * (up + down) < down else -down
        for i, x in zip(held, u):
            p[i] = min(1.0, max(0.0, p[i] + step * x))
            if p[i] < EPS or p[i] > 1 - EPS:
                p[i] = round(p[i])
        held = [i for i in held if 0 < p[i] < 1]
    return p


def settle(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """The flight with the document constraint dropped: two units at a time, only the words are kept; one is left open."""
    p = p.copy()
    for i in np.flatnonzero((size == 0) & (p > 0) & (p < 1)):
        p[i] = float(rng.random() < p[i])
    open_ = [i for i in range(len(p)) if 0 < p[i] < 1]
    a = open_.pop() if open_ else None
    while open_:
        b = open_.pop()
        up = min((1 - p[a]) * size[a], p[b] * size[b])
        down = min(p[a] * size[a], (1 - p[b]) * size[b])
        words = up if rng.random() * (up + down) < down else -down
        for i, x in ((a, words), (b, -words)):
            p[i] = min(1.0, max(0.0, p[i] + x / size[i]))
            if p[i] < EPS or p[i] > 1 - EPS:
                p[i] = round(p[i])
        left = [i for i in (a, b) if 0 < p[i] < 1]
        a = left[0] if left else (open_.pop() if open_ else None)
        open_ += left[1:]
    return p


def landing(p: np.ndarray, size: np.ndarray, short: float, free: int) -> np.ndarray:
    """Rounds what is open; then each of the first ``free`` documents, long ones first, is
    taken or left instead where that brings the words nearer ``short``, the words still missing."""
    p = p.copy()
    for i in np.flatnonzero((p > 0) & (p < 1))[::-1]:
        p[i] = float(abs(short - size[i]) < abs(short))
        short -= size[i] * p[i]
    for i in range(free - 1, -1, -1):
        change = size[i] * (1 - 2 * p[i])
        if abs(short - change) < abs(short):
            p[i], short = 1 - p[i], short - change
    return p


def _flyer(seed: int, level: int, last: bool):
    def fly(pdf: pd.DataFrame) -> pd.DataFrame:
        # Long documents fly first, so that short ones are left for the landing.
        pdf = pdf.sort_values(["size", "deal", "id"], kind="stable", na_position="last").reset_index(drop=True)
        size = pdf["size"].to_numpy(float)
        source = None if pd.isna(pdf["source"].iloc[0]) else pdf["source"].iloc[0]
        before = pdf["p"].to_numpy(float)
        rng = _coin(seed, level, source, int(pdf["cell"].iloc[0]))
        # In the last cell the shortest quarter waits, to even out the words of what the others leave.
        wait = len(pdf) // 4 if last else 0
        p = np.concatenate([before[:wait], flight(before[wait:], size[wait:], rng)])
        if last:
            p = settle(p, size, rng)
            p = landing(p, size, float(before @ size - size[p == 1].sum()), wait if before[:1].any() else 0)
        pdf["p"] = p
        return pdf

    return fly


def with_targets(sized: DataFrame, weights: Sequence[float], share: float, cap: float, source_col: str) -> DataFrame:
    """Per source: source_size, target. Sources are ordered by code point, null last, and weigh in turn."""
    spark = sized.sparkSession
    rows = sized.groupBy(source_col).agg(F.sum("size").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    # UTF-8 keeps the order of code points.
    rows.sort(key=lambda r: (r[source_col] is None, (r[source_col] or "").encode()))
    sizes = [int(r["n"]) for r in rows]
    target = fill_targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), cap)
    schema = f"`{source_col}` string, source_size long, target double"
    return spark.createDataFrame([(r[source_col], n, t) for r, n, t in zip(rows, sizes, target)], schema)


def mix(docs: DataFrame, weights: Sequence[float], share: float, cap: float = 2.0, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", cell_rows: int = CELL_ROWS) -> DataFrame:
    """One row per document: id, source, size, source_size, target, times, taken (``times * size``) and the row's hash ``deal``."""
    text = whole_text(text_col)
    sized = written(
        docs.select(
            F.col(id_col).cast("long").alias("id"), F.col(source_col).cast("string").alias("source"),
            word_count(text).alias("size"), _deal(seed, id_col, text_col).alias("deal"),
        ),
        "sizes",
    )
    targets = with_targets(sized, weights, share, cap, "source")
    planned = sized.join(F.broadcast(targets), sized["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    # At cap 2 and beyond the whole part can be 2 or more; p is what is left of it.
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    state = planned.withColumn("rate", rate).withColumns(
        {"base": F.floor(F.col("rate") + EPS).cast("long"), "p": F.greatest(F.lit(0.0), F.col("rate") - F.floor(F.col("rate") + EPS))}
    ).drop("rate")
    done = []
    level = 0
    while True:
        # Cells follow the largest source, so every source is down to two documents a cell after a round.
        most = state.groupBy("source").count().agg(F.max("count")).first()[0] or 0
        cells = max(1, math.ceil(most / cell_rows))
        last = cells == 1
        dealt = state.withColumn("cell", F.pmod(F.xxhash64("deal", F.lit(level)), F.lit(cells)))
        cols = "id long, source string, size long, deal long, source_size long, target double, base long, p double, cell long"
        flown = written(dealt.groupBy("source", "cell").applyInPandas(_flyer(seed, level, last), cols), "flight").drop("cell")
        done.append(flown if last else flown.where("p IN (0, 1)"))
        if last:
            break
        state, level = flown.where("p NOT IN (0, 1)"), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    times = F.col("base") + F.col("p").cast("long")
    return out.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        times.alias("times"), (times * F.col("size")).alias("taken"), "deal",
    )


def _deal(seed: int, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(id_col).cast("long"), whole_text(text_col))


def mixture(docs: DataFrame, weights: Sequence[float], share: float, cap: float = 2.0, seed: int = 17,
            id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows that the mix takes, each as often as it is taken, with the columns of ``docs``.

    Rows of one identifier, text and source are interchangeable: one of them is repeated for all.
    """
    taken = mix(docs, weights, share, cap, seed, id_col, text_col, source_col)
    # One key for row and source: the texts move once, for the join and for what repeats.
    row = lambda deal: F.xxhash64(deal, F.col(source_col).isNull(), F.col(source_col).cast("string"))
    times = taken.groupBy(row(F.col("deal")).alias("__row")).agg(F.sum("times").cast("int").alias("__times")).where("__times > 0")
    rows = docs.withColumn("__row", row(_deal(seed, id_col, text_col))).join(times, "__row").dropDuplicates(["__row"])
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__times"))).select(*docs.columns)
