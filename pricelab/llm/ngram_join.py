"""Jaccard self-join on word shingles by parity sketches.

A text is the set of its distinct ``k``-word shingles. Its sketch is a bit string
in which every shingle flips one bit, so the Hamming distance of two sketches is
at most the size of the sets' symmetric difference. Sizes are cut into bands; the
texts of a band and those just above it that may still link with it share one
sketch width. A pair of similarity ``num / den`` or more differs in at most D
places there, so of D + 1 blocks of the sketch one is equal: texts meet in
buckets keyed by band, block and block content. Empty blocks are no keys as long
as D + 1 others are left. With ``rarest`` there are a quarter more blocks, and each
text keeps the D + 1 of its keys that fewest texts hold (empty blocks last): of the
keys that two texts have in common the rarest is kept by both, so a passage that
many texts share brings them together only if it fills most of their blocks. That
pays at low similarities, where a block holds few shingles; it also scatters the
members of a large group of near copies over more pivots.

Every text also keeps one whole sketch, whose width follows its size; the wider of
two folds onto the narrower. A pair whose sizes or whose sketches' Hamming distance
rule out the similarity is dropped before any text is read.

Buckets are not expanded into pairs. The smallest text of a bucket is its pivot, and
the texts that meet a pivot are its family; two texts that meet alone are dropped if
their sizes rule out a link. Pairs of a text and a pivot that their sizes and sketches
let by are verified. In what is left of a family of up to ``FAMILY`` texts, those of
different components are paired, filtered by sketches and verified.

A larger family whose pivot is in a still larger one becomes part of it. Its texts are
held against one pivot, as sets of differences, and these against the family's centre:
the pivot changed by what most of a few members differ in. With dx = x ^ c for the
centre c, ``|x ^ y| = |dx ^ dy|``, so x and y are linked if and only if ``|dx & dy|`` is at
least ``(sx + sy) / (2 (den + num))``, where the slack sx is
``(den + num) |dx| - (den - num) |x|``. Texts whose slacks add up to 0 or less are linked
at once, and all of these with the text q of least slack. A text outside q's
component (a stray) has ``sx + sq > 0``, so it shares an element of its differences with
every text it links with. With the elements of a family in one order, the first
one in common is among the first ``|dx| - m + 1`` of dx and ``|dy| - m + 1`` of dy, m being
the bound above. The order is from the rarest to the most common; elements of one text
alone are counted and never looked up. A stray is first verified with the text of least
slack among those that share an element, which joins tight groups of strays; then
joins on the early elements find all other texts of another component that it may link
with, and these are verified in turn. So no link between different texts is lost at
any bucket size.

Equal sets (told by size and 128 bits of hash) are linked to one representative
and verified once. Bucket keys travel as packed arrays: a task sends each distinct
key of a chunk once, whatever number of texts holds it, and gets back the pivots of
those keys that more than one text holds.

Null and empty texts and texts without words have an empty set and link with
nothing. Repeated rows and rows of one identifier are texts of their own. A null
identifier keeps a null component unless it reaches a known one. An empty table
gives no rows. Only the identifier and the text are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelab.llm.components import components
from pricelab.llm.frames import chunks, discard, ship, small_batches, whole_text, written
from pricelab.llm.words import BASE, mix, shingle_sets, words_of
from pricelab.session import shuffle_width

ship(__name__)

#: Largest over smallest size of a band.
BAND = 1.5
#: Pairs of whole texts, or differences, that a task takes at a time.
PAIRS_PER_BATCH = 64
#: Bits of a block of the sketch.
BLOCK_BITS = 1 << 12
#: With ``rarest``, one block more for so many of D + 1; the most common keys of a text make up for them.
SPARE = 4
#: Families of up to this many texts are paired by their sketches, larger ones by their differences to the pivot.
FAMILY = 64
#: Bits of the filter that keeps texts off a list from moving; the broadcast has a 64th as many rows at most, however long the list.
FILTER_BITS = 26


def band_edges(top: int) -> list[int]:
    """First sizes of the bands up to one above ``top``."""
    edges = [1]
    while edges[-1] <= top:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
    return edges


def join_bands(n: int, edges: list[int], num: int, den: int, spare: int = 0) -> list[tuple[int, int, int]]:
    """(band, D + 1, blocks) in which a set of size ``n`` takes part.

    There are a few more blocks than D + 1, one in ``spare`` more if that is more, and as
    many as the smallest sets of the band are likely to leave empty.
    """
    own = int(np.searchsorted(edges, n, side="right")) - 1
    out = []
    for band in range(own, -1, -1):
        most = edges[band + 1] - 1  # sizes of the smaller text of a pair of this band
        if n * num > most * den:
            break
        # |x ^ y| <= (|x| + |y|) (den - num) / (den + num), with |x| <= most and |y| <= most den / num.
        need = most * (den - num) // num + 1
        out.append((band, need, need + max(3, need // spare if spare else 0) + int(1.8 * need * math.exp(-edges[band] / need))))
    return out


def block_keys(grams: np.ndarray, band: int, blocks: int, filled: bool = False) -> np.ndarray:
    """One 64-bit key per block of the sketch of the sorted hashes ``grams``; per block with a bit set if ``filled``."""
    keys, some = _blocks(grams, band, blocks)
    return keys[some] if filled else keys


def _blocks(grams: np.ndarray, band: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of each block, and whether it has a bit set."""
    width = blocks * BLOCK_BITS
    # The upper 32 bits pick the place; their order is that of the sorted hashes.
    place = ((grams >> np.uint64(32)) * np.uint64(width)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    odd = place[first][np.diff(np.append(first, len(place))) % 2 == 1]
    sums = np.zeros(len(odd) + 1, np.uint64)
    np.cumsum(mix((odd + np.uint64(1)) * np.uint64(BASE)), out=sums[1:])
    cut = np.searchsorted(odd, np.arange(blocks + 1, dtype=np.uint64) * np.uint64(BLOCK_BITS))
    content = sums[cut[1:]] - sums[cut[:-1]]
    tag = np.arange(blocks, dtype=np.uint64) + np.uint64(band << 40)
    keys = mix(mix(content + np.uint64(BASE)) + tag * np.uint64(0xD6E8FEB86659FD93))
    return keys, cut[1:] > cut[:-1]


def _slots(num: int, den: int) -> int:
    """Most bands in which a set takes part."""
    return 2 + int(math.log(den / num) / math.log(BAND))


_SKETCHED = (
    "uid long, id long, row1 long, row2 long, n int, set1 long, set2 long, sketch binary, "
    "chunk long, shard int, keys binary, firsts binary, more binary"
)


def _sketcher(k: int, num: int, den: int, shards: int, spare: int):
    slots = _slots(num, den)
    # A holder of a key is a text of the chunk, its band in turn, and whether the block is empty, in 16 bits.
    most = (1 << 16) // (2 * slots)

    def run(batches):
        from pyspark import TaskContext

        edges = band_edges(1 << 20)
        part_of = TaskContext.get().partitionId()
        for ordinal, part in enumerate(chunks((b.slice(i, most) for b in batches for i in range(0, b.num_rows, most)), "text")):
            chunk = (part_of << 24) | ordinal
            sets = shingle_sets(words_of(part.column("text")), k)
            uid = (np.int64(chunk) << np.int64(16)) + np.arange(len(sets), dtype=np.int64)
            sizes = np.array([len(s) for s in sets], np.int32)
            both = np.array([(mix(s).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(s + np.uint64(BASE)), initial=np.uint64(0))) for s in sets], np.uint64)
            none = [None] * len(sets)
            yield pa.RecordBatch.from_pydict(
                {
                    "uid": uid, "id": part.column("id"), "row1": part.column("row1"), "row2": part.column("row2"),
                    "n": sizes, "set1": both[:, 0].view(np.int64) if len(sets) else [], "set2": np.ascontiguousarray(both[:, 1]).view(np.int64),
                    "sketch": [whole_sketch(s) for s in sets], "chunk": none, "shard": none, "keys": none, "firsts": none, "more": none,
                },
                _schema(),
            )
            keys, docs, needs = [], [], np.zeros(len(sets) * slots, np.int32)
            for i, grams in enumerate(sets):
                if len(grams):
                    if len(grams) >= edges[-2]:
                        edges = band_edges(2 * len(grams))
                    for slot, (band, need, blocks) in enumerate(join_bands(len(grams), edges, num, den, spare)):
                        # Of D + 1 blocks with a bit set one is equal; else the empty ones count too.
                        made, some = _blocks(grams, band, blocks)
                        if some.sum() >= need:
                            made, some = made[some], some[some]
                        needs[i * slots + slot] = need
                        keys.append(made)
                        docs.append(((i * slots + slot) * 2 + ~some).astype(np.uint16))
            if not keys:
                continue
            key, doc = np.concatenate(keys), np.concatenate(docs)
            shard = ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
            short = (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            order = np.lexsort((doc, short, shard))
            shard, short, doc = shard[order], short[order], doc[order]
            cut = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            totals = np.bincount(doc, minlength=len(sets) * slots * 2).astype(np.int32)
            rows = {"chunk": [chunk], "shard": [-1], "keys": [needs.tobytes()], "firsts": [totals.tobytes()], "more": [b""]}
            for s in range(shards):
                a, b = cut[s], cut[s + 1]
                if a == b:
                    continue
                own, who = short[a:b], doc[a:b]
                new = np.concatenate([[True], own[1:] != own[:-1]])
                place = np.cumsum(new) - 1
                rows["chunk"].append(chunk), rows["shard"].append(s)
                rows["keys"].append(own[new].tobytes()), rows["firsts"].append(who[new].tobytes())
                rows["more"].append(place[~new].astype(np.uint32).tobytes() + who[~new].tobytes())
            blank = [None] * len(rows["chunk"])
            yield pa.RecordBatch.from_pydict(
                {**{c: blank for c in ("uid", "id", "row1", "row2", "n", "set1", "set2", "sketch")}, **rows}, _schema()
            )

    return run


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in _SKETCHED.split(", "))])


def _pivots(slots: int):
    """For one shard: per chunk the holders of keys that more than one text holds, with key, pivot and number of holders."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        keys = [np.frombuffer(x, np.uint32) for x in pdf["keys"]]
        sizes = np.array([len(x) for x in keys])
        key = np.concatenate(keys)
        uid = np.concatenate([_uids(c, np.frombuffer(f, np.uint16), slots) for c, f in zip(pdf["chunk"], pdf["firsts"])])
        held = np.concatenate([1 + np.bincount(_more(m)[0], minlength=n) for m, n in zip(pdf["more"], sizes)])
        order = np.lexsort((uid, key))
        sorted_keys = key[order]
        start = np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))
        group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
        pivot, holders = np.empty(len(key), np.int64), np.empty(len(key), np.int64)
        pivot[order], holders[order] = uid[order][start][group], np.add.reduceat(held[order], start)[group]
        out = {"chunk": [], "shard": [], "who": [], "keys": [], "pivots": [], "holders": []}
        begins = np.cumsum(sizes) - sizes
        for c, s, own, a, firsts, more in zip(pdf["chunk"], pdf["shard"], keys, begins, pdf["firsts"], pdf["more"]):
            shared = holders[a:a + len(own)] > 1
            place, further = _more(more)
            first, again = np.flatnonzero(shared), shared[place]
            if len(first):
                at = np.concatenate([first, place[again]])
                who = np.concatenate([np.frombuffer(firsts, np.uint16)[first], further[again]])
                out["chunk"].append(c), out["shard"].append(s), out["who"].append(who.tobytes()), out["keys"].append(own[at].tobytes())
                out["pivots"].append(pivot[a + at].tobytes()), out["holders"].append(holders[a + at].astype(np.uint32).tobytes())
        return pd.DataFrame(out)

    return run


def _uids(chunk: int, holders: np.ndarray, slots: int) -> np.ndarray:
    return (np.int64(chunk) << np.int64(16)) + (holders // (2 * slots)).astype(np.int64)


def _more(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Places of the keys that a chunk holds more than once, and their further holders."""
    n = len(raw) // 6
    return np.frombuffer(raw, np.uint32, n), np.frombuffer(raw, np.uint16, n, 4 * n)


def _paired(slots: int, rarest: bool):
    """(pivot, text) pairs of one chunk over the keys that each text keeps: all, or the rarest; ``alone`` if no third text holds one."""

    def run(own: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(answers):
            return pd.DataFrame({"p": np.zeros(0, np.int64), "x": np.zeros(0, np.int64), "alone": np.zeros(0, bool)})
        needs, totals = np.frombuffer(own["keys"].iloc[0], np.int32), np.frombuffer(own["firsts"].iloc[0], np.int32)
        who = np.concatenate([np.frombuffer(w, np.uint16) for w in answers["who"]])
        pivot = np.concatenate([np.frombuffer(p, np.int64) for p in answers["pivots"]])
        count = np.concatenate([np.frombuffer(n, np.uint32) for n in answers["holders"]])
        key = np.concatenate(
            [(np.uint64(s) << np.uint64(32)) + np.frombuffer(k, np.uint32).astype(np.uint64) for s, k in zip(answers["shard"], answers["keys"])]
        )
        if rarest:
            # The rarest keys of each text and band first, empty blocks last; equal counts by key, alike in every task.
            order = np.lexsort((key, count, who))
            who, pivot, count = who[order], pivot[order], count[order]
            line = np.arange(len(who))
            rank = line - np.maximum.accumulate(np.where(np.concatenate([[True], who[1:] != who[:-1]]), line, 0))
            # Keys that no other text holds come before those of this kind, and blocks with a bit before empty ones.
            front = totals - np.bincount(who, minlength=len(totals))
            front[1::2] += totals[::2]
            kept = front[who] + rank < needs[who >> 1]
            who, pivot, count = who[kept], pivot[kept], count[kept]
        x = _uids(own["chunk"].iloc[0], who, slots)
        other = pivot != x
        pair, at = np.unique(np.stack([pivot, x], 1)[other], axis=0, return_inverse=True)
        crowd = np.bincount(at.ravel(), count[other] > 2, len(pair)) > 0
        return pd.DataFrame({"p": pair[:, 0], "x": pair[:, 1], "alone": ~crowd})

    return run


def whole_sketch(grams: np.ndarray) -> bytes:
    """The parity sketch of a whole set: a power of two of bits, two to four per shingle and 512 at least."""
    bits = 1 << max(9, (2 * len(grams) - 1).bit_length())
    place = (mix(grams) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=bits) & 1).astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, the wider folded onto the narrower; never above the symmetric difference."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sketch_filter(num: int, den: int):
    def run(batches):
        for batch in batches:
            sizes = zip(batch.column("np").to_pylist(), batch.column("nx").to_pylist())
            sketches = zip(batch.column("sp"), batch.column("sx"))
            fits = [
                sketch_distance(a.as_buffer(), b.as_buffer()) * (den + num) <= (den - num) * (n + m) for (n, m), (a, b) in zip(sizes, sketches)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("x")], ["p", "x"]).filter(pa.array(fits, pa.bool_()))

    return run


def by_sketch(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (p, x, np, nx) whose sizes and sketches let them link."""
    sized = pairs.where(f"least(np, nx) * {den} >= greatest(np, nx) * {num}").select("p", "x", "np", "nx")
    left = reps.select(F.col("uid").alias("p"), F.col("sketch").alias("sp"))
    right = reps.select(F.col("uid").alias("x"), F.col("sketch").alias("sx"))
    both = sized.join(right, "x").join(left, "p")
    return both.select("p", "x", "np", "nx", "sp", "sx").mapInArrow(_sketch_filter(num, den), "p long, x long")


def parity_words(grams: np.ndarray, words: int) -> np.ndarray:
    """A sketch of ``words`` 64-bit words: each hash flips one bit."""
    place = ((mix(grams) >> np.uint64(32)) * np.uint64(64 * words) >> np.uint64(32)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=64 * words) & 1).astype(np.uint8)).view(np.int64)


def _verifier(k: int, num: int, den: int, deltas: bool):
    def run(batches):
        for batch in batches:
            for part in chunks([batch], "tx", 1 << 20):
                p, x = part.column("p").to_numpy(), part.column("x").to_numpy()
                kinds, first, back = np.unique(p, return_index=True, return_inverse=True)
                sets_x = shingle_sets(words_of(part.column("tx")), k)
                sets_p = []
                for at in range(0, len(first), 64):  # pivots may be long and many
                    sets_p += shingle_sets(words_of(part.column("tp").take(pa.array(first[at:at + 64]))), k)
                rows = {"p": p, "x": x, "np": [], "nx": [], "linked": [], "delta": []}
                for a, b in zip((sets_p[i] for i in back), sets_x):
                    only_b, only_a = np.setdiff1d(b, a, assume_unique=True), np.setdiff1d(a, b, assume_unique=True)
                    rows["np"].append(len(a)), rows["nx"].append(len(b))
                    rows["linked"].append((len(only_a) + len(only_b)) * (den + num) <= (den - num) * (len(a) + len(b)))
                    rows["delta"].append(np.concatenate([only_b, only_a]).view(np.int64) if deltas else None)
                yield pa.RecordBatch.from_pydict(
                    rows,
                    pa.schema([("p", pa.int64()), ("x", pa.int64()), ("np", pa.int32()), ("nx", pa.int32()),
                               ("linked", pa.bool_()), ("delta", pa.list_(pa.int64()))]),
                )

    return run


def verify(pairs: DataFrame, texts: DataFrame, k: int, num: int, den: int, deltas: bool) -> DataFrame:
    """The pairs (p, x) with sizes, link and, if asked for, the difference of x to p."""
    left = texts.select(F.col("uid").alias("p"), F.col("text").alias("tp"))
    right = texts.select(F.col("uid").alias("x"), F.col("text").alias("tx"))
    both = pairs.join(right, "x").join(left, "p").select("p", "x", "tp", "tx")
    return both.mapInArrow(_verifier(k, num, den, deltas), "p long, x long, np int, nx int, linked boolean, delta array<long>")


def _told_apart(num: int, den: int):
    """The pairs of one family's texts of different components whose sizes and sketches let them link; rows come sorted by family."""

    def family(rows: pa.Table) -> list[tuple[np.ndarray, ...]]:
        x, n, c = (rows.column(name).to_numpy() for name in ("x", "nx", "cx"))
        i, j = np.triu_indices(len(x), 1)
        a, b = np.minimum(n[i], n[j]).astype(np.int64), np.maximum(n[i], n[j]).astype(np.int64)
        may = (c[i] != c[j]) & (x[i] != x[j]) & (a * den >= b * num)
        i, j = i[may], j[may]
        sketches = [np.frombuffer(v.as_buffer(), np.uint64) for v in rows.column("sketch")] if len(i) else []
        width = np.array([len(v) for v in sketches], np.int64)
        out = []
        for w in np.unique(np.minimum(width[i], width[j])) if len(i) else ():
            # The wider of two folds onto the narrower.
            wide = np.flatnonzero(width >= w)
            place = np.zeros(len(x), np.int64)
            place[wide] = np.arange(len(wide))
            folded = np.stack([np.bitwise_xor.reduce(sketches[k].reshape(-1, w), axis=0) for k in wide])
            here = np.flatnonzero(np.minimum(width[i], width[j]) == w)
            step = max(1, (1 << 20) // int(w))
            for at in range(0, len(here), step):
                k = here[at:at + step]
                apart = np.bitwise_count(folded[place[i[k]]] ^ folded[place[j[k]]]).sum(axis=1, dtype=np.int64)
                k = k[apart * (den + num) <= (den - num) * (n[i[k]].astype(np.int64) + n[j[k]])]
                first = x[i[k]] < x[j[k]]
                p, q = np.where(first, i[k], j[k]), np.where(first, j[k], i[k])
                out.append((x[p], x[q]))
        return out

    def run(batches):
        schema = pa.schema([("p", pa.int64()), ("x", pa.int64())])
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            p = held.column("p").to_numpy()
            if not len(p):
                continue
            cut = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
            for a, b in zip(cut[:-1], cut[1:]):
                for found in family(held.slice(a, b - a)):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], schema=schema)
            held = held.slice(cut[-1])  # the last family may go on
        if held is not None and held.num_rows:
            for found in family(held):
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], schema=schema)

    return run


def _small_family_pairs(pairs: DataFrame, labels: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (p, x) of texts of one small family that the links so far (``labels``) do not join and that may link.

    A family's texts come together with their sketches, one row for each text, and only
    pairs that sizes and sketches let by leave the task.
    """
    known = pairs.join(labels.select(F.col("node").alias("x"), F.col("label").alias("cx")), "x", "left").withColumn("cx", F.coalesce("cx", "x"))
    split = known.groupBy("p").agg(F.min("cx").alias("a"), F.max("cx").alias("b")).where("a <> b").select("p")
    known = known.join(split, "p", "left_semi").join(reps.select(F.col("uid").alias("x"), "sketch"), "x")
    rows = known.select("p", "x", "nx", "cx", "sketch").repartition("p").sortWithinPartitions("p")
    return rows.mapInArrow(_told_apart(num, den), "p long, x long")


def _rare_first(members: DataFrame) -> DataFrame:
    """``delta`` in an order that each family shares, and ``new``, its shingles that the pivot lacks, in that order.

    The text nearest to the pivot stands for what the family has in common: shingles on
    which it and the pivot agree, and x does not, are x's own and come first.
    """
    new = "cast((dn + nx - np) DIV 2 AS int)"
    parts = members.withColumn("fresh", F.expr(f"slice(delta, 1, {new})")).withColumn("lacks", F.expr(f"slice(delta, 1 + {new}, dn)"))
    nearest = parts.groupBy("p").agg(F.min_by(F.struct("fresh", "lacks"), F.struct("dn", "x")).alias("q"))
    parts = parts.join(nearest, "p")
    own = [F.array_except("fresh", "q.fresh"), F.array_except("lacks", "q.lacks")]
    rest = [F.array_intersect("fresh", "q.fresh"), F.array_intersect("lacks", "q.lacks")]
    return parts.withColumn("delta", F.concat(*own, *rest)).withColumn("new", F.concat(own[0], rest[0])).drop("fresh", "lacks", "q")


def _large_families(pairs: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Pivots of more than ``FAMILY`` texts, and the members (p, x) of their families.

    Of two pivots that meet, the one of the smaller family takes it to the other's: texts of
    one group are held against one text, whatever number of pivots brought them together.
    """
    hubs = written(pairs.groupBy("p").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > FAMILY), "hubs")
    own = hubs.select(F.col("p").alias("x"), F.col("members").alias("own"))
    both = pairs.where(f"least(np, nx) * {den} >= greatest(np, nx) * {num}").join(own, "x").join(hubs, "p")
    # The larger family first, then the smaller pivot: no two pivots are each above the other.
    ends = both.selectExpr("struct(members AS size, -p AS at) AS a", "struct(own AS size, -x AS at) AS b")
    up = ends.groupBy(F.least("a", "b").alias("low")).agg(F.max(F.greatest("a", "b")).alias("high"))
    roots = components(up.selectExpr("-low.at AS u", "-high.at AS v")).withColumnRenamed("node", "p")
    met = pairs.join(hubs, "p", "left_semi").select("p", "x").unionAll(hubs.select("p", F.col("p").alias("x")))
    moved = met.join(roots, "p", "left").select(F.coalesce("label", "p").alias("p"), "x")
    return hubs, moved.where("p <> x").distinct()


def _centre(pdf: pd.DataFrame) -> pd.DataFrame:
    """The differences that most of some members of a family share."""
    gram, held = np.unique(np.concatenate(pdf["delta"].to_list()), return_counts=True)
    return pd.DataFrame({"p": pdf["p"].iloc[:1], "centre": [gram[2 * held > len(pdf)]]})


def _centred(checked: DataFrame) -> DataFrame:
    """``checked`` with differences to the family's centre in place of its pivot.

    The centre is the pivot with what some ``FAMILY`` of the members, dealt by hash, mostly
    differ in. Which they are decides how short differences are, and no link.
    """
    every = checked.groupBy("p").agg(F.expr(f"count(1) DIV {FAMILY} + 1").alias("every"))
    some = checked.join(every, "p").where("pmod(xxhash64(x), every) = 0").select("p", "delta")
    centres = some.groupBy("p").applyInPandas(_centre, "p long, centre array<long>")
    both = checked.join(centres, "p", "left").withColumn("centre", F.coalesce("centre", F.expr("cast(array() AS array<bigint>)")))
    return both.withColumn("delta", F.concat(F.array_except("delta", "centre"), F.array_except("centre", "delta"))).drop("centre")


def _slack(num: int, den: int) -> F.Column:
    """Texts of a family whose slacks add up to 0 or less are linked, however their differences meet."""
    return F.expr(f"{den + num}L * size(delta) - {den - num}L * nx")


def _nearest(members: DataFrame) -> DataFrame:
    """The text of least slack of each family."""
    return members.groupBy("p").agg(F.min_by("x", F.struct("slack", "x")).alias("q"), F.min("slack").alias("least"))


def _surely_linked(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links (p, x) of each family's nearest text that the slacks alone tell."""
    members = members.select("p", "x", _slack(num, den).alias("slack"))
    return members.join(_nearest(members), "p").where("slack + least <= 0 AND x <> q").select(F.col("q").alias("p"), "x")


def _split(members: DataFrame, labels: DataFrame, num: int, den: int) -> DataFrame:
    """The families with more than one component: each text with its component ``cx``, and whether it is a
    stray, that is, outside the component of the family's nearest text."""
    members = members.select("p", "x", "nx", _slack(num, den).alias("slack"), F.size("delta").alias("dx"), "delta")
    to_x = labels.select(F.col("node").alias("x"), F.col("label").alias("cx"))
    to_q = labels.select(F.col("node").alias("q"), F.col("label").alias("cq"))
    nearest = _nearest(members).join(to_q, "q", "left").select("p", "least", F.coalesce("cq", "q").alias("cq"))
    known = members.join(to_x, "x", "left").withColumn("cx", F.coalesce("cx", "x")).join(nearest, "p")
    known = known.withColumn("stray", F.expr("cx <> cq"))
    return known.join(known.where("stray").groupBy("p").agg(F.min("slack").alias("least_stray")), "p")


#: What a lookup knows of its text.
_SIDE = ["x", "cx", "nx", "slack", "dx", "at", "stray"]


def _lookups(split: DataFrame, num: int, den: int) -> DataFrame:
    """One row for each element of a difference by which a stray and another text of its family can meet.

    Elements that no other member has are only counted; the place ``at`` of the others is
    that in the order from the rarest of the family to the most common.
    """
    # Elements in common with any text that counts: a stray with the nearest text at least, the others with a stray.
    common = F.expr(f"greatest(1, ceil((slack + if(stray, least, least_stray)) / {2 * (den + num)}))").alias("common")
    each = split.select("p", "x", "cx", "nx", "slack", "dx", "stray", common, "delta").where("dx >= common")
    rows = written(each.withColumn("gram", F.explode("delta")).drop("delta"), "elements")
    held = rows.groupBy("p", "gram").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    own = Window.partitionBy("p", "x")
    place = F.row_number().over(own.orderBy("held", "gram")) - F.count(F.lit(1)).over(own) + F.col("dx")
    placed = rows.join(held, ["p", "gram"]).withColumn("at", place)
    return written(placed.where("at <= dx - common + 1").select("p", "gram", *_SIDE), "lookups")


def _met(strays: DataFrame, others: DataFrame, on: list[str], where: str, num: int, den: int) -> DataFrame:
    """Pairs (p, x, np, nx) of a stray and another text of different components whose sizes let them link."""
    other = others.withColumnsRenamed({c: f"{c}_y" for c in _SIDE})
    sized = f"least(nx, nx_y) * {den} >= greatest(nx, nx_y) * {num}"
    met = strays.join(other, on).where(f"cx <> cx_y AND {sized} AND {where}")
    return met.selectExpr("least(x, x_y) AS p", "greatest(x, x_y) AS x", "if(x < x_y, nx, nx_y) AS np", "if(x < x_y, nx_y, nx) AS nx")


def _early(num: int, den: int) -> str:
    """Of two texts, the first element in common is early enough in both."""
    common = f"ceil((slack + slack_y) / {2 * (den + num)})"
    return f"at <= dx - {common} + 1 AND at_y <= dx_y - {common} + 1"


def _head_pairs(lookups: DataFrame, num: int, den: int) -> DataFrame:
    """Each stray with the text of least slack that shares one of its elements."""
    heads = lookups.groupBy("p", "gram").agg(F.min_by(F.struct(*_SIDE), F.struct("slack", "x")).alias("head")).select("p", "gram", "head.*")
    return _met(lookups.where("stray"), heads, ["p", "gram"], _early(num, den), num, den)


def _family_pairs(members: DataFrame, labels: DataFrame, num: int, den: int, lookups: DataFrame | None = None) -> DataFrame:
    """Pairs of a stray and another text of its family that agree on enough of their
    differences and that the links so far (``labels``) do not join already. ``lookups``
    may be those of earlier labels, which join less."""
    split = _split(members, labels, num, den)
    lookups = _lookups(split, num, den) if lookups is None else lookups
    now = labels.select(F.col("node").alias("x"), F.col("label").alias("now"))
    lookups = lookups.join(now, "x", "left").withColumn("cx", F.coalesce("now", "x")).drop("now")
    # Two strays meet once.
    once = "(NOT stray_y OR x < x_y)"
    by_gram = _met(lookups.where("stray"), lookups, ["p", "gram"], f"{once} AND {_early(num, den)}", num, den)
    # Nothing is left here once the labels hold the links of ``_surely_linked``.
    sure = split.where("slack + least <= 0").withColumn("at", F.lit(0)).select("p", *_SIDE)
    return by_gram.unionByName(_met(sure.where("stray"), sure, ["p"], f"{once} AND slack + slack_y <= 0", num, den))


def maybe_listed(rows: DataFrame, listed: DataFrame) -> DataFrame:
    """``rows`` with ``maybe``: false only for rows whose ``row1`` no row of ``listed`` has.

    One bit per hash stands for a row of the list, so ``rows`` do not move. A list too long
    for its bits lets more rows by and never loses one.
    """
    place = F.shiftrightunsigned("row1", 64 - FILTER_BITS)
    word, bit = F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")
    bits = listed.select(word.alias("__word"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("__bit"))
    bits = bits.groupBy("__word").agg(F.bit_or("__bit").alias("__bits"))
    met = rows.withColumn("__word", word).join(F.broadcast(bits), "__word", "left")
    return met.withColumn("maybe", F.coalesce(F.bit_get("__bits", bit) == 1, F.lit(False))).drop("__word", "__bits")


def _texts_of(rows: DataFrame, reps: DataFrame, pairs: DataFrame) -> DataFrame:
    """``uid`` and text of every text in ``pairs`` (p, x)."""
    wanted = pairs.select(F.col("p").alias("uid")).unionAll(pairs.select(F.col("x").alias("uid"))).distinct()
    wanted = written(reps.join(wanted, "uid", "left_semi").select("uid", "row1", "row2"), "wanted")
    near = maybe_listed(rows.select("row1", "row2", "text"), wanted).where("maybe")
    return near.join(wanted, ["row1", "row2"]).select("uid", "text").dropDuplicates(["uid"])


def linked_rows(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                text_col: str = "text", rarest: bool = True) -> DataFrame:
    """One row per document: uid, id, row1, row2, n_shingles and component_id (smallest id reachable)."""
    spark = docs.sparkSession
    ident, text = F.col(id_col).cast("long"), whole_text(text_col)
    rows = docs.select(
        ident.alias("id"), F.xxhash64(ident, text).alias("row1"), F.xxhash64(F.lit("row"), text, ident).alias("row2"), text.alias("text")
    )
    shards = shuffle_width(spark)
    made = written(rows.mapInArrow(_sketcher(k, num, den, shards, SPARE if rarest else 0), _SKETCHED), "sketches")
    docs_of = made.where("uid IS NOT NULL").select("uid", "id", "row1", "row2", "n", "set1", "set2", "sketch")
    sent = made.where("uid IS NULL").select("chunk", "shard", "keys", "firsts", "more")
    slots = _slots(num, den)
    answers = sent.where("shard >= 0").groupBy("shard").applyInPandas(
        _pivots(slots), "chunk long, shard int, who binary, keys binary, pivots binary, holders binary"
    )
    needs = sent.where("shard = -1").select("chunk", "keys", "firsts")
    pairs = needs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_paired(slots, rarest), "p long, x long, alone boolean")

    sets = docs_of.where("n > 0").groupBy("n", "set1", "set2").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("copies"))
    reps = written(
        docs_of.join(sets.where("copies > 1"), ["n", "set1", "set2"], "left").select(
            "uid", "id", "row1", "row2", "n", F.coalesce("rep", "uid").alias("rep"), F.expr("if(rep IS NULL OR rep = uid, sketch, NULL)").alias("sketch")
        ),
        "sets",
    )
    to_p = reps.select(F.col("uid").alias("p"), F.col("rep").alias("rp"), F.col("n").alias("np"))
    to_x = reps.select(F.col("uid").alias("x"), F.col("rep").alias("rx"), F.col("n").alias("nx"))
    # Two texts that meet alone are no family: if their sizes rule out a link, nothing is left to find.
    meet = f"rp <> rx AND (NOT alone OR least(np, nx) * {den} >= greatest(np, nx) * {num})"
    pairs = pairs.join(to_p, "p").join(to_x, "x").where(meet).select(F.col("rp").alias("p"), F.col("rx").alias("x"), "np", "nx")
    pairs = written(pairs.distinct(), "pairs")
    discard(made)
    fit = written(by_sketch(pairs, reps, num, den), "fit")
    hubs, large = _large_families(pairs, num, den)
    small, large = pairs.join(hubs, "p", "left_anti"), written(large, "large")
    texts = written(_texts_of(rows, reps, fit.unionAll(large)), "texts")
    with small_batches(spark, PAIRS_PER_BATCH):
        near = written(verify(fit, texts, k, num, den, False).where("linked").select("p", "x"), "near")
        checked = written(verify(large, texts, k, num, den, True), "checked")
    discard(texts, fit, large)
    members = written(_centred(checked), "members")
    same = reps.where("rep <> uid").select(F.col("rep").alias("u"), F.col("uid").alias("v"))
    linked = near.unionAll(checked.where("linked").select("p", "x")).unionAll(_surely_linked(members, num, den))
    labels = components(linked.select(F.col("p").alias("u"), F.col("x").alias("v")).unionAll(same))

    def joined(candidates: DataFrame, labels: DataFrame) -> DataFrame:
        """``labels`` with the links among ``candidates``, pairs that sizes and sketches let by."""
        candidates = written(candidates.distinct(), "candidates")
        if not candidates.isEmpty():
            texts = written(_texts_of(rows, reps, candidates), "texts")
            with small_batches(spark, PAIRS_PER_BATCH):
                more = written(verify(candidates, texts, k, num, den, False).where("linked").select("p", "x"), "found")
            if not more.isEmpty():
                # The components so far stand for their edges.
                so_far = labels.where("node <> label").select(F.col("label").alias("u"), F.col("node").alias("v"))
                labels = components(so_far.unionAll(more.select(F.col("p").alias("u"), F.col("x").alias("v"))))
            discard(texts, more)
        discard(candidates)
        return labels

    lookups = _lookups(_split(members, labels, num, den), num, den)
    heads = by_sketch(_head_pairs(lookups, num, den).distinct(), reps, num, den)
    labels = joined(_small_family_pairs(small, labels, reps, num, den).unionByName(heads), labels)
    # What the heads join needs no pairs; the others are told apart one by one.
    labels = joined(by_sketch(_family_pairs(members, labels, num, den, lookups).distinct(), reps, num, den), labels)
    discard(pairs, hubs, near, checked, members, lookups)
    labels = labels.withColumnRenamed("node", "uid")
    named = reps.join(labels, "uid", "left").withColumnRenamed("label", "group")
    smallest = labels.join(reps.select("uid", "id"), "uid").groupBy(F.col("label").alias("group")).agg(F.min("id").alias("least_id"))
    return named.join(smallest, "group", "left").select(
        "uid", "id", "row1", "row2", F.col("n").cast("long").alias("n_shingles"), F.coalesce("least_id", "id").alias("component_id")
    )


def link(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text",
         rarest: bool = False) -> DataFrame:
    """One row per document: id, n_shingles, component_id. Texts link at similarity ``num / den`` or more."""
    found = linked_rows(docs, k, num, den, id_col, text_col, rarest)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id")


def one_of_each(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id",
                text_col: str = "text", rarest: bool = True) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps its smallest identifier; rows without words all stay."""
    found = written(linked_rows(docs, k, num, den, id_col, text_col, rarest), "linked")
    # Written, so that Spark knows its size before it plans how the texts meet it.
    goes = written(found.where("n_shingles > 0 AND NOT id <=> component_id").select("row1", "row2").distinct(), "gone")
    ident, text = F.col(id_col).cast("long"), whole_text(text_col)
    packed = docs.select(F.struct(*docs.columns).alias("doc"), F.xxhash64(ident, text).alias("row1"), F.xxhash64(F.lit("row"), text, ident).alias("row2"))
    # Only rows that may go meet the list; the others stay where they are.
    packed = maybe_listed(packed, goes)
    packed = packed.where("NOT maybe").unionByName(packed.where("maybe").join(goes, ["row1", "row2"], "left_anti"))
    out = packed.select("doc.*", F.col("row1").alias("__row1"), F.col("row2").alias("__row2"))
    twins = found.where("n_shingles > 0").groupBy("row1", "row2").count().where("count > 1")
    if not twins.isEmpty():
        # Only repeated rows need the second shuffle; rows without words are no group.
        worded = F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]"))
        out = out.where(worded).dropDuplicates(["__row1", "__row2"]).unionByName(out.where(~worded))
    return out.select(*docs.columns)
