"""Exact global order without a single-partition window.

A range partitioning by a total order puts consecutive rows in consecutive
partitions. The rows are tagged with (partition, position) and written once to
the shared folder, because a second evaluation of the sampled bounds could place
them differently. One small count per partition then turns positions into
global ranks, with no second shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricelab.functions.keys import seeded_text
from pricelab.functions.targets import col
from pricelab.session import materialize, shuffle_width

# monotonically_increasing_id keeps the partition above bit 33.
_POSITION_BITS = 33
_POS = "__pos"

# Share of ranks left on each side of a sketched quantile.
_SKETCH_ACCURACY = 10_000
_SMALL_INPUT = 20_000


def ordered_layout(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by ``order``, tag each row's place, write once."""
    return materialize(range_order(df, order, partitions))


def range_order(df: DataFrame, order: Sequence[Column | str], partitions: int | None = None) -> DataFrame:
    """The unwritten layout, for a single aggregation: places hold within one evaluation only."""
    keys = [col(c) for c in order]
    n = partitions or shuffle_width(df.sparkSession)
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn(_POS, F.monotonically_increasing_id())


def layout_partition() -> Column:
    return F.shiftright(F.col(_POS), _POSITION_BITS).cast("int")


def layout_position() -> Column:
    return F.col(_POS).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))


def per_partition_literal(values: Sequence[object], sql_type: str) -> Column:
    """Look up a driver-side value (one per range partition) by partition number."""
    text = ",".join("" if v is None else repr(v) for v in values)
    # One string literal: the optimizer folds the split and cast to an array constant.
    table = F.split(F.lit(text), ",").try_cast(f"array<{sql_type}>")
    return F.get(table, layout_partition())


def layout_counts(laid: DataFrame, weight: Column | None = None) -> dict[int, int]:
    """Rows (or summed weight) per range partition: at most one entry per partition."""
    agg = F.count(F.lit(1)) if weight is None else F.sum(weight)
    rows = laid.groupBy(layout_partition().alias("p")).agg(agg.alias("n")).collect()
    return {r["p"]: int(r["n"] or 0) for r in rows}


def offsets(counts: dict[int, int]) -> list[int]:
    width = max(counts, default=-1) + 1
    return list(accumulate((counts.get(i, 0) for i in range(width)), initial=0))


def global_rank(
    df: DataFrame, order: Sequence[Column | str], name: str = "rank", partitions: int | None = None
) -> DataFrame:
    """Add the exact 0-based position of each row under ``order``.

    Give a total order (end it with the row id): it fixes ties and lets a value
    shared by many rows spread over several partitions.
    """
    laid = ordered_layout(df, order, partitions)
    start = per_partition_literal(offsets(layout_counts(laid)), "bigint")
    return laid.withColumn(name, start + layout_position()).drop(_POS)


def order_stats(
    df: DataFrame, value: str, positions: Sequence[int], tie: Sequence[Column | str], total: int | None = None
) -> dict[int, dict]:
    """Rows at the given 0-based positions of ``df`` sorted by value, then ``tie``.

    A quantile sketch brackets each position; only rows inside the brackets are
    ranked, so the table itself is scanned but not shuffled. Counts taken below
    each bracket make the answer exact, and a bracket that misses widens to all.
    The tie must make the order total (end it with the id); for values alone use
    ``values_at_positions``.
    """
    wanted = sorted(set(int(p) for p in positions))
    if not wanted:
        return {}
    known = df.where(F.col(value).isNotNull())
    n = known.count() if total is None else total
    if wanted[0] < 0 or wanted[-1] >= n:
        raise ValueError(f"positions {wanted} outside 0..{n - 1}")
    spans = [(None, None)]
    if n > _SMALL_INPUT:
        spans = _sketched_spans(known, value, wanted, n)
    try:
        return _pick(known, value, wanted, tie, spans)
    except LookupError:
        return _pick(known, value, wanted, tie, [(None, None)])


def _sketched_spans(df: DataFrame, value: str, wanted: Sequence[int], n: int) -> list[tuple]:
    margin = 2.0 / _SKETCH_ACCURACY
    probs = []
    for p in wanted:
        probs += [max(0.0, p / n - margin), min(1.0, (p + 1) / n + margin)]
    marks = df.agg(F.percentile_approx(value, probs, _SKETCH_ACCURACY)).first()[0]
    spans: list[list] = []
    for lo, hi in sorted(zip(marks[0::2], marks[1::2])):
        if spans and lo <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], hi)
        else:
            spans.append([lo, hi])
    return [tuple(s) for s in spans]


def _inside(value: str, span: tuple) -> Column:
    lo, hi = span
    return F.lit(True) if lo is None else F.col(value).between(F.lit(lo), F.lit(hi))


def _pick(df, value, wanted, tie, spans) -> dict[int, dict]:
    aggs = []
    for i, span in enumerate(spans):
        below = F.lit(False) if span[0] is None else F.col(value) < F.lit(span[0])
        aggs += [F.count_if(below).alias(f"b{i}"), F.count_if(_inside(value, span)).alias(f"i{i}")]
    counted = df.agg(*aggs).first()
    local, seen = {}, 0
    for i in range(len(spans)):
        below, within = counted[f"b{i}"], counted[f"i{i}"]
        local.update({p: p - below + seen for p in wanted if below <= p < below + within})
        seen += within
    if len(local) < len(wanted):
        raise LookupError("a bracket missed its position")
    cond = _inside(value, spans[0])
    for span in spans[1:]:
        cond = cond | _inside(value, span)
    ranked = global_rank(df.where(cond), [value, *tie], "__rank")
    hits = ranked.where(F.col("__rank").isin(list(local.values()))).collect()
    by_rank = {r["__rank"]: r.asDict() for r in hits}
    out = {}
    for p, r in local.items():
        row = by_rank[r]
        row.pop("__rank")
        out[p] = row
    return out


def _at_or_after(value: str, tie: str, row: dict) -> Column:
    v, t = F.lit(row[value]), F.lit(row[tie])
    return (F.col(value) > v) | ((F.col(value) == v) & (F.col(tie) >= t))


def rank_level(df: DataFrame, value: str, tie: str, k: int, name: str = "level") -> DataFrame:
    """Level = position // (n // k) in value order.

    There are more than k levels when n is not a multiple of k. The level edges
    are exact order statistics, so the rows themselves are never sorted.
    """
    n = df.where(F.col(value).isNotNull()).count()
    step = n // k
    if step == 0:
        raise ValueError(f"{n} rows cannot be cut into {k} levels")
    edges = order_stats(df.select(value, tie), value, range(step, n, step), tie=[tie], total=n)
    level = F.lit(0)
    for i, position in enumerate(sorted(edges), start=1):
        level = F.when(_at_or_after(value, tie, edges[position]), F.lit(i)).otherwise(level)
    return df.withColumn(name, F.when(F.col(value).isNotNull(), level))


def trim_tails(df: DataFrame, value: str, tie: str, pct: float) -> DataFrame:
    """Drop ``int(n * pct / 100 / 2)`` rows at each end of the value order."""
    narrow = df.select(value, tie).where(F.col(value).isNotNull())
    n = narrow.count()
    cut = int(n * (pct / 100.0) / 2)
    if cut == 0:
        return df.where(F.col(value).isNotNull())
    ends = order_stats(narrow, value, [cut, n - cut - 1], tie=[tie], total=n)
    low, high = ends[cut], ends[n - cut - 1]
    v, t = F.col(value), F.col(tie)
    not_after = (v < F.lit(high[value])) | ((v == F.lit(high[value])) & (t <= F.lit(high[tie])))
    return df.where(_at_or_after(value, tie, low) & not_after)


def stratified_folds(df: DataFrame, level: str, key: str, k: int, seed: int = 42, name: str = "fold") -> DataFrame:
    """Shuffle inside each level by a seeded hash and deal rows to k folds.

    The order is global (level, hash, id), so a level holding most rows still
    spreads over all partitions; the place inside a level is the global rank
    less the rows of the lower levels.
    """
    sizes = {r[level]: r["n"] for r in df.groupBy(level).agg(F.count(F.lit(1)).alias("n")).collect()}
    hashed = df.withColumn("__h", seeded_text(seed, key))
    ranked = global_rank(hashed, [level, "__h", key], "__r")
    start = F.lit(0)
    seen = 0
    for lv in sorted((v for v in sizes if v is not None)):
        start = F.when(F.col(level) == F.lit(lv), F.lit(seen + sizes.get(None, 0))).otherwise(start)
        seen += sizes[lv]
    return ranked.withColumn(name, F.pmod(F.col("__r") - start, F.lit(k)).cast("int")).drop("__h", "__r")


def shuffle_column(df: DataFrame, key: str, column: str, seed: int = 42) -> DataFrame:
    """Permute one column across all rows.

    Row i in key order receives the value of row i in seeded hash order.
    """
    donors = df.select(F.col(key).alias("__k"), F.col(column).alias("__v"))
    donors = global_rank(donors, [seeded_text(seed, "__k"), "__k"], "__r").select("__r", "__v")
    rows = global_rank(df, [key], "__r")
    return rows.join(donors, "__r").withColumn(column, F.col("__v")).select(*df.columns)


def within_group_rank(
    table: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str, rows: int | None = None
) -> DataFrame:
    """0-based rank inside each group of a written table of distinct values.

    Up to a counted small size one sorted task per group ranks it. A larger
    table takes its global rank less the group's first rank, so a group may
    hold most of it. Groups are columns of a frame, so there are few.
    """
    if rows is None:
        rows = table.count()
    if rows <= _SMALL_INPUT:
        w = Window.partitionBy(*group).orderBy(*[col(c) for c in order])
        return table.withColumn(name, (F.row_number().over(w) - 1).cast("bigint"))
    ranked = global_rank(table, [*group, *order], "__r")
    firsts = ranked.groupBy(*group).agg(F.min("__r").alias("__first"))
    return ranked.join(F.broadcast(firsts), list(group)).withColumn(
        name, F.col("__r") - F.col("__first")
    ).drop("__r", "__first")


def category_codes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Alphabetical code of every known value: rows ``(col, value, code)``."""
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("value")) for c in cols])
        ).alias("p")
    ).select("p.*")
    values = materialize(pairs.where("value is not null").distinct())
    return within_group_rank(values, ["col"], ["value"], "code")
