"""Exact copies, line copies and near copies against brute force."""

import random
import re
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.llm import components as C, exact_dedup as E, line_dedup as L, ngram_join as N
from pricelab.llm.frames import small_batches


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute_components(sets, ids, num, den):
    parent = list(range(len(sets)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and both * den >= num * len(a | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_trie_owners_with_spills():
    rng = random.Random(3)
    keys = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 14))).encode() * rng.randint(1, 9) for _ in range(4000)]
    with tempfile.TemporaryDirectory() as folder:
        trie = E.RadixTrie(max, 20_000, folder)
        want = {}
        for i, k in enumerate(keys):
            trie.insert(k, i)
            want[k] = (i, want.get(k, (0, 0))[1] + 1)
        got = {}
        for k, owner, n in trie.items():
            assert k not in got
            got[k] = (owner, n)
    assert got == want


@pytest.mark.parametrize("keep", ["max", "min"])
def test_exact_dedup_odd_rows(make_docs, odd_rows, keep):
    got = E.dedup(make_docs(odd_rows), keep=keep).collect()
    assert len(got) == len(odd_rows)
    groups = {}
    for i, t, _ in odd_rows:
        groups.setdefault(t or "", []).append(i)
    pick = max if keep == "max" else min
    for r in got:
        members = next(g for t, g in groups.items() if E_sha(t) == r["text_sha256"])
        known = [m for m in members if m is not None]
        assert r["keep_id"] == pick(known) and r["group_size"] == len(members) and r["kept"] == (r["doc_id"] == r["keep_id"])
    stay = E.distinct_texts(make_docs(odd_rows).withColumn("hash", F.lit(1)), keep=keep)
    assert stay.columns[-1] == "hash" and stay.count() == len(groups)
    assert E.dedup(make_docs([])).count() == 0 and E.distinct_texts(make_docs([])).count() == 0


def E_sha(text):
    import hashlib

    return hashlib.sha256(text.encode()).hexdigest()


def near_rows(seed, families=6, size=14, words=60):
    rng = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"f{f}w{rng.randint(0, 400)}" for _ in range(words + 9 * f)]
        for c in range(size):
            w = list(base)
            for _ in range(rng.randint(0, 5)):
                w[rng.randrange(len(w))] = f"e{rng.randint(0, 3)}"
            rows.append((1000 * rng.randint(1, 9) + len(rows), " ".join(w[rng.randint(0, 2):]), "s"))
    return rows


@pytest.mark.parametrize("k,num,seed", [(3, 90, 1), (5, 80, 2), (3, 80, 3), (1, 90, 4)])
def test_ngram_join_against_brute_force(make_docs, k, num, seed):
    rows = near_rows(seed)
    sets = [shingles(t, k) for _, t, _ in rows]
    want = brute_components(sets, [i for i, _, _ in rows], num, 100)
    got = {r["doc_id"]: r for r in N.link(make_docs(rows), k, num, 100).collect()}
    assert [got[i]["component_id"] for i, _, _ in rows] == want
    assert [got[i]["n_shingles"] for i, _, _ in rows] == [len(s) for s in sets]
    assert len(set(want)) < len(rows)


def passage_rows(seed, texts=90):
    """Otherwise different texts of which a third hold one passage, with a few near copies among them."""
    rng = random.Random(seed)
    passage = [f"common{i}" for i in range(60)]
    rows = []
    for i in range(texts):
        own = [f"own{i}n{rng.randint(0, 500)}" for _ in range(rng.randint(30, 200))]
        at = rng.randrange(len(own))
        words = own[:at] + passage + own[at:] if i % 3 == 0 else own
        rows.append((len(rows), " ".join(words), "s"))
        if i % 6 == 0:
            words[rng.randrange(len(words))] = "changed"
            rows.append((len(rows), " ".join(words), "s"))
    return rows


@pytest.mark.parametrize("family", [2, N.FAMILY])
@pytest.mark.parametrize("make,k,num,seed", [(near_rows, 5, 80, 6), (passage_rows, 5, 80, 7)])
@pytest.mark.parametrize("rarest", [False, True])
def test_ngram_join_by_differences_and_by_sketches(make_docs, monkeypatch, family, make, k, num, seed, rarest):
    monkeypatch.setattr(N, "FAMILY", family)
    rows = make(seed)
    want = brute_components([shingles(t, k) for _, t, _ in rows], [i for i, _, _ in rows], num, 100)
    got = {r["doc_id"]: r["component_id"] for r in N.link(make_docs(rows), k, num, 100, rarest=rarest).collect()}
    assert [got[i] for i, _, _ in rows] == want and len(set(want)) < len(rows)


def family_of(seed, pivot_edits, members=40, size=120):
    """Sets around one template as rows of ``verify``, all held against one pivot, and the sets by text."""
    import numpy as np

    rng = np.random.default_rng(seed)
    some = lambda n: rng.integers(0, 2**64, int(n), dtype=np.uint64)
    edited = lambda a, n: np.unique(np.concatenate([rng.permutation(a)[int(n):], some(n + rng.integers(0, 3))]))
    template = some(size)
    pivot, sets = edited(template, pivot_edits), {}
    for x in range(1, members, 2):
        sets[x] = edited(template, rng.integers(2, size // 2))
        sets[x + 1] = edited(sets[x], rng.integers(1, size // 6))
    rows = []
    for x, b in sets.items():
        delta = np.concatenate([np.setdiff1d(b, pivot), np.setdiff1d(pivot, b)])
        linked = len(delta) * 180 <= 20 * (len(pivot) + len(b))
        sketch = N.parity_words(delta, 8 + 8 * len(pivot) * 20 // (64 * 180))
        rows.append((0, x, len(pivot), len(b), linked, len(delta), delta.view(np.int64).tolist(), sketch.tolist()))
    return rows, {x: set(b.tolist()) for x, b in sets.items()}


CHECKED = "p long, x long, np int, nx int, linked boolean, dn int, delta array<long>, sketch array<long>"


@pytest.mark.parametrize("pivot_edits", [4, 40])
def test_no_linked_strays_of_a_family_are_lost(spark, pivot_edits):
    rows, sets = family_of(pivot_edits, pivot_edits)
    checked = spark.createDataFrame(rows, CHECKED)
    near = {r[1] for r in rows if r[4]}
    labels = spark.createDataFrame([(x, 0) for x in {0, *near}], "node long, label long")
    got = {(r["p"], r["x"]) for r in N._family_pairs(checked, labels, 80, 100).collect()}
    linked = lambda a, b: len(a & b) * 100 >= 80 * len(a | b)
    want = {(x, y) for x in sets for y in sets if x < y and not {x, y} <= near and linked(sets[x], sets[y])}
    assert want <= got and len(want) > 5


def test_what_a_family_shares_comes_last(spark):
    rows, _ = family_of(5, 40)
    shared, before = [0, 0], [0, 0]
    for r in N._rare_first(spark.createDataFrame(rows, CHECKED)).collect():
        new = r["dn"] + r["nx"] - r["np"] >> 1
        old = next(x[6] for x in rows if x[1] == r["x"])
        assert sorted(r["new"]) == sorted(old[:new]) and sorted(r["delta"]) == sorted(old)
        for at, head in ((shared, r["new"][:15]), (before, old[:min(new, 15)])):
            held = [sum(g in x[6] for x in rows) for g in head]
            at[0] += sum(n > len(rows) // 2 for n in held)
            at[1] += len(held)
    assert shared[1] == before[1] and shared[0] * 2 < before[0]


def by_template(seed, members=200, size=120, edits=(0, 60)):
    """Rows of ``verify`` for one template's copies with edits of their own, against a pivot far from it, and the sets."""
    import numpy as np

    rng = np.random.default_rng(seed)
    template = rng.integers(0, 2**64, size, dtype=np.uint64)
    edited = lambda n: np.unique(np.concatenate([rng.permutation(template)[n:], rng.integers(0, 2**64, n, dtype=np.uint64)]))
    pivot, sets = edited(40), {x: edited(int(rng.integers(*edits))) for x in range(1, members)}
    rows = []
    for x, b in sets.items():
        delta = np.concatenate([np.setdiff1d(b, pivot), np.setdiff1d(pivot, b)])
        rows.append((0, x, len(pivot), len(b), len(delta) * 180 <= 20 * (len(pivot) + len(b)), delta.view(np.int64).tolist()))
    return rows, {x: set(b.tolist()) for x, b in sets.items()}


def test_a_family_is_held_against_its_centre(spark):
    rows, sets = by_template(8)
    checked = spark.createDataFrame(rows, "p long, x long, np int, nx int, linked boolean, delta array<long>")
    members = N._centred(checked)
    ids = sorted(sets)
    want = brute_components([sets[x] for x in ids], ids, 80, 100)
    found = [(r["p"], r["x"]) for r in N._surely_linked(members, 80, 100).collect()]
    assert all(len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]) for a, b in found) and len(found) > 30
    labels = C.components(spark.createDataFrame(found, "u long, v long"))
    rest = {(r["p"], r["x"]) for r in N._family_pairs(members, labels, 80, 100).collect()}
    # No list of all pairs of the group; before, nearly each of its links came out.
    assert len(rest) < len(ids)
    linked = [(a, b) for a, b in rest if len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b])]
    got = dict(C.components(spark.createDataFrame(found + linked, "u long, v long")).collect())
    assert [got.get(x, x) for x in ids] == want


def test_families_of_one_group_are_one(spark):
    rows = [(1, x, 100, 100) for x in range(2, 200)] + [(2, x, 100, 100) for x in range(3, 300)] + [(500, x, 50, 60) for x in range(501, 600)]
    rows += [(2, 500, 100, 50), (700, 701, 9, 9)]
    hubs, met = N._large_families(spark.createDataFrame(rows, "p long, x long, np int, nx int"), 80, 100)
    assert {r["p"] for r in hubs.collect()} == {1, 2, 500}
    got = sorted((r["p"], r["x"]) for r in met.collect())
    assert got == sorted({(1, x) for x in range(2, 300)} | {(1, 500)} | {(500, x) for x in range(501, 600)})


@pytest.mark.parametrize("rarest", [False, True])
def test_large_group_of_edited_copies(make_docs, monkeypatch, rarest):
    monkeypatch.setattr(N, "FAMILY", 8)
    rng = random.Random(11)
    rows = []
    for base in range(3):
        words = [f"b{base if i % 3 else 0}w{i}" for i in range(150)]
        for c in range(60):
            w = list(words)
            for _ in range(rng.randint(0, 14)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(5000)}"
            rows.append((len(rows), " ".join(w[: rng.randint(110, 150)]), "s"))
    want = brute_components([shingles(t, 5) for _, t, _ in rows], [i for i, _, _ in rows], 80, 100)
    got = {r["doc_id"]: r["component_id"] for r in N.link(make_docs(rows), 5, 80, 100, rarest=rarest).collect()}
    assert [got[i] for i, _, _ in rows] == want and 10 < len(set(want)) < len(rows)


def test_sketches_bound_the_difference():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(300):
        x = np.unique(rng.integers(0, 2**64, int(rng.integers(1, 4000)), dtype=np.uint64))
        y = np.unique(np.concatenate([x[: int(rng.integers(0, len(x) + 1))], rng.integers(0, 2**64, int(rng.integers(0, 300)), dtype=np.uint64)]))
        assert N.sketch_distance(N.whole_sketch(x), N.whole_sketch(y)) <= len(np.setxor1d(x, y))
    strangers = [N.whole_sketch(rng.integers(0, 2**64, 500, dtype=np.uint64)) for _ in range(2)]
    assert N.sketch_distance(*strangers) > 300


def test_a_small_family_is_paired_where_its_texts_meet(spark):
    """One row for each text moves, whatever number of pairs its family has; families go on over batches."""
    rng = np.random.default_rng(5)
    sets, rows = {}, []
    for p in range(12):
        base = rng.integers(0, 1 << 63, 500).astype(np.uint64)
        for i in range(30):
            x = p * 100 + i + 1
            sets[x] = np.unique(np.concatenate([base[: rng.integers(120, 500)], rng.integers(0, 1 << 63, 9).astype(np.uint64)]))
            rows.append((p * 100, x, 500, len(sets[x])))
    pairs = spark.createDataFrame(rows, "p long, x long, np int, nx int")
    labels = spark.createDataFrame([(x, x - x % 3) for x in sets if x % 3 and x % 100 < 20 and x - x % 3 in sets], "node long, label long")
    label = {r["node"]: r["label"] for r in labels.collect()}
    reps = spark.createDataFrame([(x, bytearray(N.whole_sketch(s))) for x, s in sets.items()], "uid long, sketch binary")
    want = set()
    for p in range(12):
        own = [x for x in sets if x // 100 == p]
        for x in own:
            for y in own:
                a, b = len(sets[x]), len(sets[y])
                if x < y and label.get(x, x) != label.get(y, y) and min(a, b) * 100 >= max(a, b) * 80:
                    if N.sketch_distance(N.whole_sketch(sets[x]), N.whole_sketch(sets[y])) * 180 <= 20 * (a + b):
                        want.add((x, y))
    with small_batches(spark, 7):
        found = N._small_family_pairs(pairs, labels, reps, 80, 100)
        got = [(r["p"], r["x"]) for r in found.collect()]
    assert len({len(N.whole_sketch(s)) for s in sets.values()}) > 1 and len(want) > 100
    assert len(got) == len(set(got)) and set(got) == want
    assert found.columns == ["p", "x"]


def test_ngram_join_odd_rows(make_docs, odd_rows):
    docs = make_docs(odd_rows).withColumn("uid", F.lit("x"))
    got = N.link(docs, 3, 90, 100).collect()
    by = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert len(got) == len(odd_rows)
    assert by[1] == by[2] == by[None] == (2, 1)
    assert by[3] == (0, 3) and by[4] == (0, 4) and by[5] == (0, 5)
    assert by[6][1] == by[7][1] == 6 and by[9] == (1, 9)
    left = N.one_of_each(docs, 3, 90, 100)
    assert sorted(r["doc_id"] for r in left.collect()) == [1, 3, 4, 5, 6, 8, 9] and left.columns == docs.columns
    assert N.link(make_docs([])).count() == 0 and N.one_of_each(make_docs([])).count() == 0


def test_block_keys_of_linked_sets_meet():
    import numpy as np

    rng = np.random.default_rng(0)
    edges = N.band_edges(1000)
    for _ in range(500):
        num, n = int(rng.choice([80, 90])), int(rng.integers(1, 300))
        x = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        y = np.unique(np.concatenate([x[int(rng.integers(0, n // 10 + 1)):], rng.integers(0, 2**64, int(rng.integers(0, n // 12 + 1)), dtype=np.uint64)]))
        if not len(y) or len(np.setxor1d(x, y)) * (100 + num) > (100 - num) * (len(x) + len(y)):
            continue
        keys = []
        for z in (x, y):
            own = set()
            for band, need, blocks in N.join_bands(len(z), edges, num, 100):
                made = N.block_keys(z, band, blocks, True)
                own |= set((made if len(made) >= need else N.block_keys(z, band, blocks)).tolist())
            keys.append(own)
        assert keys[0] & keys[1]


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100)]
    got = dict(C.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def test_line_dedup(make_docs, odd_rows):
    passage = "\n".join(f"shared line number {i} with words" for i in range(40))
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "head one\n" + passage + "\ntail one", "a"), (2, "other\nhead two\n" + passage + "\ntail two", "b"),
            (3, f"start\n{long}\nend", "a"), (4, f"begin\n{long}\nstop", "a"), (5, "only\nsmall\ntalk", "a")]
    got = {r["doc_id"]: r for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got[1]["text"] == rows[0][1] and got[3]["text"] == rows[2][1] and got[5]["n_removed_lines"] == 0
    assert got[4]["text"] == "begin\nstop" and got[2]["text"].startswith("other\n") and got[2]["text"].endswith("tail two")
    assert got[2]["n_removed_lines"] > 25 and got[2]["n_lines"] == 43
    odd = L.dedup_lines(make_docs(odd_rows).withColumn("hash", F.lit(0)))
    texts = {(r["doc_id"], r["text"]) for r in odd.collect()}
    assert odd.count() == len(odd_rows) and (3, "") in texts and (4, "") in texts
    assert L.dedup_lines(make_docs([])).count() == 0


def brute_lines(docs, long_words=50):
    """Lines that lie in a run of two worded lines or more, or in one long line, that has an earlier copy elsewhere."""
    lines = {i: text.split("\n") for i, text in docs}
    places = sorted((i, k) for i, ls in lines.items() for k in range(len(ls)))
    gone = set()
    for p in places:
        for q in places:
            if q >= p:
                break
            (d, i), (e, j), n = p, q, 0
            while i + n < len(lines[d]) and j + n < len(lines[e]) and lines[d][i + n] == lines[e][j + n] and not (d == e and j + n >= i):
                n += 1
            run = lines[d][i:i + n]
            while run and not run[-1].split():
                run.pop()
            if run and run[0].split() and (sum(1 for x in run if x.split()) > 1 or len(run[0].split()) >= long_words):
                gone |= {(d, i + k) for k in range(len(run))}
    return {i: "\n".join(x for k, x in enumerate(ls) if (i, k) not in gone) for i, ls in lines.items()}, gone


def test_line_dedup_finds_every_repeated_run(make_docs):
    """Runs of 2 to 8 lines between unique neighbours, with blank lines inside, and parts of other runs."""
    rng = random.Random(5)
    source = [f"common line {i} " + " ".join(f"w{rng.randrange(900)}" for _ in range(rng.randrange(3, 30))) for i in range(40)]
    docs = []
    for d in range(60):
        parts = []
        for u in range(rng.randrange(1, 4)):
            start, size = rng.randrange(32), rng.randrange(1, 9)
            parts += [f"unique {d} {u}"] + source[start:start + size] + ([""] if rng.random() < 0.3 else [])
        parts.insert(rng.randrange(len(parts)), "" if rng.random() < 0.2 else f"mid {d}")
        docs.append((d, "\n".join([*parts, f"end {d}"])))
    want, gone = brute_lines(docs)
    got = {r["doc_id"]: r for r in L.dedup_lines(make_docs([(i, t, "a") for i, t in docs])).collect()}
    assert {i: r["text"] for i, r in got.items()} == want
    assert {i: r["n_removed_lines"] for i, r in got.items()} == {i: sum(1 for d, _ in gone if d == i) for i in got}
    kept = {x for t in want.values() for x in t.split("\n")}
    assert kept >= {x for _, t in docs for x in t.split("\n") if x.split()}


def test_line_dedup_of_equal_neighbours(make_docs):
    rows = [(1, "x y\nx y\nx y", "a"), (2, "a\nx y\nx y\nx y\nb", "a"), (3, "p q\nr s\np q\nr s", "a")]
    got = {r["doc_id"]: r["text"] for r in L.dedup_lines(make_docs(rows)).collect()}
    assert got == {1: "x y\nx y\nx y", 2: "a\nb", 3: "p q\nr s\n"}


def test_only_texts_that_may_be_listed_move(make_docs, odd_rows, monkeypatch):
    rows = make_docs([(i, f"text {i}", "s") for i in range(2000)]).select("doc_id", "text", F.xxhash64("doc_id").alias("row1"))
    listed = rows.where("doc_id % 100 = 0 OR doc_id > 1990").select("row1")
    flagged = {r["doc_id"]: r["maybe"] for r in N.maybe_listed(rows, listed).collect()}
    assert len(flagged) == 2000 and all(flagged[i] for i in flagged if i % 100 == 0 or i > 1990) and sum(flagged.values()) < 40
    assert N.maybe_listed(rows, listed.where("false")).where("maybe").count() == 0
    # A filter that is full lets every row by and changes no result.
    monkeypatch.setattr(N, "FILTER_BITS", 6)
    docs = make_docs(odd_rows + [(i + 100, t, s) for i, t, s in near_rows(6)])
    got = N.one_of_each(docs, 3, 90, 100).orderBy("doc_id", "text").collect()
    monkeypatch.undo()
    assert got == N.one_of_each(docs, 3, 90, 100).orderBy("doc_id", "text").collect() and len(got) < docs.count()
