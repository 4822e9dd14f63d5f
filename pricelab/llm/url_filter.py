"""URL rules and an exact block list held in a cascade of Bloom filters.

Level 1 encodes the listed keys. Level 2 encodes those keys of the corpus that
level 1 takes for listed though they are not, level 3 the listed keys that level
2 takes for such, and so on until no key of the corpus is wrong. A key leaves at
the first level that lacks it, and the parity of that level is the answer. Since
every key of the corpus took part, membership is exact there and needs no join.

Filters are built by Spark (bits of a word are or-ed per word) and broadcast only
after their size was computed from the counted keys and found below
``max_bytes``. A larger list is looked up by an equi-join instead.

Null URLs and those without ``://`` have an empty host and path, fit no rule and
are allowed unless the empty host is listed. Ties between rules of one length go
to ``block``. Repeated pages are judged alike, an empty table gives no rows, and
columns named like the results are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import ship, written

ship(__name__)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Broadcast bound of all levels together.
MAX_BYTES = 64 << 20


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def with_url_parts(pages: DataFrame, url_col: str = "url") -> DataFrame:
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    return pages.withColumns(
        {
            "host": F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER),
            "path": F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1),
        }
    )


def fitting_rule(rules: Sequence[UrlRule]) -> Column:
    """Struct of text and verdict of the longest rule that fits ``host`` and ``path``; else null."""
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text)):
        host, path = F.col("host"), F.col("path")
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        value = F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out if out is not None else F.lit(None).cast("struct<text:string,verdict:string>")


def domains(host: Column) -> Column:
    """The host and every parent domain of it."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))


def _mix(h: np.ndarray, seed: int) -> np.ndarray:
    h = h ^ np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Level:
    seed: int
    probes: int
    words: np.ndarray

    def places(self, h: np.ndarray) -> list[np.ndarray]:
        size = np.uint64(len(self.words) * 64)
        return [_mix(h, self.seed * 64 + i) % size for i in range(self.probes)]

    def has(self, h: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h), bool)
        for place in self.places(h):
            ok &= (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
        return ok


def listed_in(levels: Sequence[Level], h: np.ndarray) -> np.ndarray:
    """Whether each hashed key is listed, by the parity of the first level that lacks it."""
    answer = np.full(len(h), len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        answer = np.where(levels[i].has(h), answer, i % 2 == 1)
    return answer


def _shape(keys: int, rate: float) -> tuple[int, int]:
    """64-bit words and probes for ``keys`` at a false-positive rate."""
    bits = max(64, math.ceil(keys * 1.4427 * math.log2(1 / rate)))
    return -(-bits // 64), max(1, round(math.log2(1 / rate)))


def _passes(df: DataFrame, level: Level) -> DataFrame:
    @F.pandas_udf("boolean")
    def has(h: pd.Series) -> pd.Series:
        return pd.Series(level.has(h.to_numpy().view(np.uint64)))

    return df.where(has("h"))


def _build(keys: DataFrame, seed: int, words: int, probes: int) -> Level:
    """The filter of a column ``h``: places per key, then one or-ed word per place."""
    shape = Level(seed, probes, np.zeros(words, np.uint64))

    @F.pandas_udf("array<long>")
    def places(h: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(shape.places(h.to_numpy().view(np.uint64)), 1).view(np.int64)))

    bits = keys.select(F.explode(places("h")).alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("bits")
    )
    for row in bits.toLocalIterator():
        shape.words[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return shape


def cascade(listed: DataFrame, universe: DataFrame, max_bytes: int = MAX_BYTES) -> list[Level] | None:
    """Levels over a ``key`` column; None if the list needs more than ``max_bytes``.

    Both frames may repeat keys. Two keys of one 64-bit hash would be one key; the
    hashes of all keys are compared with the keys first, and a clash is an error.
    """
    known = listed.where("key IS NOT NULL").select("key").distinct().withColumn("own", F.lit(1))
    seen = universe.where("key IS NOT NULL").select("key").distinct().withColumn("own", F.lit(0))
    keys = written(
        known.unionAll(seen).groupBy("key").agg(F.max("own").alias("own")).withColumn("h", F.xxhash64("key")), "url-keys"
    )
    n = keys.agg(F.count_if(F.col("own") == 1).alias("own"), F.count_if(F.col("own") == 0).alias("rest"), F.count_distinct("h").alias("h")).first()
    if n["h"] != n["own"] + n["rest"]:
        raise ValueError("two keys share one hash")
    if n["own"] == 0:
        return []
    rate = min(0.5, max(2.0**-30, n["own"] / (1.4142 * max(1, n["rest"]))))
    # Later levels hold a falling share of both sides, together at most as much again.
    if 8 * (_shape(n["own"], rate)[0] + 2 * _shape(n["own"], 0.5)[0]) > max_bytes:
        return None
    levels: list[Level] = []
    inside, outside, count = keys.where("own = 1"), keys.where("own = 0"), n["own"]
    while count:
        words, probes = _shape(count, rate if not levels else 0.5)
        level = _build(inside, len(levels) + 1, words, probes)
        levels.append(level)
        wrong = written(_passes(outside, level).select("key", "own", "h"), "url-level")
        inside, outside, count = wrong, inside, wrong.count()
    return levels


def with_listed(pages: DataFrame, listed: DataFrame, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` (with ``host``) and ``listed``: the host or one of its parent domains is on the list."""
    keyed = pages.withColumn("__keys", domains(F.col("host")))
    universe = keyed.select("__keys").distinct().select(F.explode("__keys").alias("key"))
    levels = cascade(listed, universe, max_bytes)
    if levels is None:
        found = keyed.select("host", "__keys").distinct().select("host", F.explode("__keys").alias("key"))
        hosts = found.join(listed.select("key").distinct(), "key", "left_semi").select("host").distinct()
        return keyed.join(hosts.withColumn("__on", F.lit(True)), "host", "left").withColumn(
            "listed", F.coalesce("__on", F.lit(False))
        ).drop("__on", "__keys")
    shared = pages.sparkSession.sparkContext.broadcast([(x.seed, x.probes, x.words) for x in levels])

    @F.pandas_udf("boolean")
    def any_listed(hashes: pd.Series) -> pd.Series:
        if not len(hashes):
            return pd.Series([], dtype=bool)
        sizes = hashes.map(len).to_numpy()
        flat = np.concatenate(hashes.to_list()).astype(np.int64).view(np.uint64)
        starts = np.cumsum(sizes) - sizes
        return pd.Series(np.logical_or.reduceat(listed_in([Level(*x) for x in shared.value], flat), starts))

    return keyed.withColumn("listed", any_listed(F.transform("__keys", lambda k: F.xxhash64(k)))).drop("__keys")


def judge(pages: DataFrame, rules: Sequence[UrlRule], listed: DataFrame, url_col: str = "url",
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the longest fitting rule's, else the list's."""
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "listed")]
    source = pages.select(*dict.fromkeys([*keep, url_col]))
    parts = with_listed(with_url_parts(source, url_col), listed, max_bytes).withColumn("__rule", fitting_rule(rules))
    return parts.select(
        *keep, "host", "path", F.col("__rule.text").alias("rule"),
        F.coalesce(F.col("__rule.verdict"), F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )
