"""Exact quantiles of many columns at once, by sketch, count and refine."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricelab.functions.targets import col
from pricelab.operators.ranks import layout_partition, offsets, ordered_layout

_ACCURACY = 10_000
_SMALL_INPUT = 20_000
_PAIRS_PER_PASS = 100


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles (0..1) of the known values of each column."""
    out: dict[str, list[float | None]] = {}
    step = max(1, _PAIRS_PER_PASS // max(1, len(probs)))
    for i in range(0, len(cols), step):
        out.update(_quantiles(df, list(cols[i : i + step]), list(probs)))
    return out


def exact_median(df: DataFrame, cols: Sequence[str]) -> dict[str, float | None]:
    return {c: q[0] for c, q in exact_quantiles(df, cols, [0.5]).items()}


def values_at_positions(df: DataFrame, column: str, positions: Sequence[int]) -> dict[int, float]:
    """Known values at 0-based sorted positions; rows that share a value count as one entry."""
    wanted = sorted({int(p) for p in positions})
    plain = df.select(F.nanvl(F.col(column).cast("double"), F.lit(None)).alias("c0"))
    n = plain.agg(F.count("c0")).first()[0]
    if not wanted or wanted[0] < 0 or wanted[-1] >= n:
        raise ValueError(f"positions {wanted} outside 0..{n - 1}")
    margin = 2.0 / _ACCURACY
    marks = [m for p in wanted for m in (max(0.0, p / n - margin), min(1.0, (p + 1) / n + margin))]
    at = plain.agg(F.percentile_approx("c0", marks, _ACCURACY)).first()[0]
    spans = _merged(list(zip(at[0::2], at[1::2])))
    found = _values_at(plain, {0: wanted}, {0: spans}) or _values_at(plain, {0: wanted}, {0: [(-math.inf, math.inf)]})
    return found[0]


def rank_split(df: DataFrame, value: str, positions: Sequence[int], name: str = "grp") -> DataFrame:
    """Group 0, 1, 2, ... by the values found at the given sorted positions (strictly below = lower group)."""
    cuts = values_at_positions(df, value, positions)
    thresholds = [cuts[int(p)] for p in sorted(positions)]
    return df.withColumn(name, split_by(value, thresholds))


def split_by(value: Column | str, thresholds: Sequence[float]) -> Column:
    """Number of thresholds at or below the value (unknown values land in the top group)."""
    v = col(value)
    group = F.lit(len(thresholds))
    for i in reversed(range(len(thresholds))):
        group = F.when(v < F.lit(thresholds[i]), F.lit(i)).otherwise(group)
    return group


def _quantiles(df, cols, probs):
    plain = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(cols)])
    margin = 3.0 / _ACCURACY
    marks = sorted({m for p in probs for m in (max(0.0, p - margin), min(1.0, p + margin))})
    aggs = []
    for i in range(len(cols)):
        aggs += [F.count(f"c{i}").alias(f"n{i}"), F.percentile_approx(f"c{i}", marks, _ACCURACY).alias(f"m{i}")]
    sketch = plain.agg(*aggs).first()
    if max(sketch[f"n{i}"] for i in range(len(cols))) <= _SMALL_INPUT:
        # Counted small: the exact aggregate's value map stays small too.
        exact = plain.agg(*[F.percentile(f"c{i}", probs).alias(f"q{i}") for i in range(len(cols))]).first()
        return {c: list(exact[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(cols)}

    # Positions wanted per column, and the value span that must hold them.
    wanted, spans = {}, {}
    for i in range(len(cols)):
        n = sketch[f"n{i}"]
        if n == 0:
            continue
        places = [(n - 1) * p for p in probs]
        wanted[i] = sorted({math.floor(h) for h in places} | {math.ceil(h) for h in places})
        at = dict(zip(marks, sketch[f"m{i}"]))
        spans[i] = _merged([(at[max(0.0, p - margin)], at[min(1.0, p + margin)]) for p in probs])
    values = _values_at(plain, wanted, spans)
    if values is None:
        values = _values_at(plain, wanted, {i: [(-math.inf, math.inf)] for i in wanted})
    result = {}
    for i, c in enumerate(cols):
        n = sketch[f"n{i}"]
        if n == 0:
            result[c] = [None] * len(probs)
            continue
        row = []
        for p in probs:
            h = (n - 1) * p
            lo, hi = values[i][math.floor(h)], values[i][math.ceil(h)]
            row.append(lo + (hi - lo) * (h - math.floor(h)))
        result[c] = row
    return result


def _merged(spans):
    out: list[list[float]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [tuple(s) for s in out]


def _values_at(plain, wanted, spans):
    """Value at each wanted position per column, or None when a span missed one."""
    aggs = []
    for i, col_spans in spans.items():
        for j, (lo, hi) in enumerate(col_spans):
            c = F.col(f"c{i}")
            aggs += [
                F.count_if(c < F.lit(lo)).alias(f"b{i}_{j}"),
                F.count_if(c.between(F.lit(lo), F.lit(hi))).alias(f"i{i}_{j}"),
            ]
    if not aggs:
        return {}
    counted = plain.agg(*aggs).first()
    targets: dict[int, dict[int, int]] = {}
    for i, col_spans in spans.items():
        targets[i], seen = {}, 0
        for j in range(len(col_spans)):
            below, within = counted[f"b{i}_{j}"], counted[f"i{i}_{j}"]
            targets[i].update({p: p - below + seen for p in wanted[i] if below <= p < below + within})
            seen += within
        if len(targets[i]) < len(wanted[i]):
            return None

    # One row per distinct value inside the spans, with its count.
    entries = []
    for i, col_spans in spans.items():
        c = F.col(f"c{i}")
        held = F.lit(False)
        for lo, hi in col_spans:
            held = held | c.between(F.lit(lo), F.lit(hi))
        entries.append(F.when(held, F.struct(F.lit(i).alias("i"), c.alias("v"))))
    pairs = plain.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    laid = ordered_layout(pairs.groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")), ["i", "v"])

    sizes = laid.groupBy(layout_partition().alias("p"), "i").agg(F.sum("n").alias("n")).collect()
    by_col: dict[int, dict[int, int]] = {}
    for r in sizes:
        by_col.setdefault(r["i"], {})[r["p"]] = r["n"]
    # Only the partitions that hold a target are read again.
    picks = []
    for i, places in targets.items():
        counts = by_col[i]
        base = offsets(counts)
        for place in sorted(set(places.values())):
            part = next(p for p in sorted(counts) if base[p] <= place < base[p] + counts[p])
            picks.append((i, part, place - base[part], place))
    cond = F.lit(False)
    for i, part, _, _ in picks:
        cond = cond | ((F.col("i") == i) & (layout_partition() == part))
    w = Window.partitionBy("p", "i").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = laid.where(cond).withColumn("p", layout_partition()).withColumn("cum", F.sum("n").over(w))
    hit = F.lit(False)
    for i, part, place, _ in picks:
        hit = hit | (
            (F.col("i") == i) & (F.col("p") == part) & (F.col("cum") > place) & (F.col("cum") - F.col("n") <= place)
        )
    rows = running.where(hit).collect()
    found = {}
    for i, part, place, absolute in picks:
        for r in rows:
            if r["i"] == i and r["p"] == part and r["cum"] - r["n"] <= place < r["cum"]:
                found[(i, absolute)] = r["v"]
    return {i: {p: found[(i, local)] for p, local in places.items()} for i, places in targets.items()}
