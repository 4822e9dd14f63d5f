"""Conversation repair against a shortest-path search over whole edit strings."""

import collections
import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from pricelab.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string, extra string"


def brute(rows):
    """Result columns of one conversation of (turn, role, text) after damage, in order, by Dijkstra over (cost, edits)."""
    seen, counts, kinds = set(), [0, 0, 0], []
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        dup = (role, text) in seen
        seen.add((role, text))
        cut = bool(body) and body[-1] not in ".!?"
        kind = 0 if not body else 1 if dup else 2 if cut else None
        if kind is not None:
            counts[kind] += 1
        kinds.append((kind in (0, 1), kind == 2))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            break
        for name in ("user", "assistant"):
            if (state, name[0]) in step and edits.count("I") < len(rows) + 3:
                heapq.heappush(heap, (cost + 2, edits + "I", i, name[0], (*lines, f"{name}:")))
        if i == len(rows):
            continue
        (must, cut), (_, role, text) = kinds[i], rows[i]
        heapq.heappush(heap, (cost + 3, edits + "D", i + 1, state, lines))
        if must:
            continue
        if (state, role[:1]) in step:
            heapq.heappush(heap, (cost + cut, edits + "K", i + 1, step[state, role[:1]], (*lines, f"{role}:{text}")))
        for name in ("user", "assistant"):
            if (state, name[0]) in step:
                heapq.heappush(heap, (cost + 2 + cut, edits + "R", i + 1, name[0], (*lines, f"{name}:{text}")))
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (gaps, *counts, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damage(rows):
    """Rows (conv_id, turn, role, text) of a table, damaged and grouped as the contract says."""
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        out[conv]
        if h == 0:
            continue
        text = "" if h == 1 else text.translate({46: None, 33: None, 63: None}) if h == 2 else text
        out[conv] += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    digest = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: sorted(t, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], digest(r))) for c, t in out.items()}


def test_search_is_cheapest_and_least():
    rnd = random.Random(3)
    for _ in range(400):
        n = rnd.randrange(0, 9)
        rows = [(i, rnd.choice(["system", "user", "assistant", "assistant", "tool"]), rnd.choice(["a.", "b", "", "c!", f"x{i}.", f"y{i}"])) for i in range(n)]
        assert R.repair(rows) == brute(rows), rows


@pytest.mark.parametrize("codes", ["", "u", "sua", "uuaD?A", "aaUUs", "DDss!"])
def test_prices_of_segments(codes):
    """Every pair of states against all edit strings of the segment."""
    want = {(e, t): R.NEVER for e in range(4) for t in range(4)}
    for entry in range(4):
        best = {(0, entry): 0}
        todo = [(0, 0, entry)]
        while todo:
            cost, i, state = heapq.heappop(todo)
            if cost > best.get((i, state), R.NEVER):
                continue
            if i == len(codes):
                want[entry, state] = min(want[entry, state], cost)
                continue
            for _, step, to, more in R._moves(codes[i], state):
                if cost + more < best.get((i + step, to), R.NEVER):
                    best[i + step, to] = cost + more
                    heapq.heappush(todo, (cost + more, i + step, to))
    assert R.prices(codes) == [want[e, t] for e, t in itertools.product(range(4), range(4))]


def _table(rnd):
    rows = []
    for conv in range(40):
        for turn in range(rnd.randrange(1, 12)):
            rows.append((conv, turn * rnd.choice([1, 1, 2]), rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "No", "", f"t {turn}.", f"v {turn}"])))
    roles = ["user", "assistant"]
    rows += [(99, t, roles[t % 2], rnd.choice(["ok.", f"number {t}.", f"cut {t}", f"word {t}!"])) for t in range(700)]
    rows += [(None, None, None, None), (None, 3, "user", "Hi."), (None, None, "user", "a."), (None, None, "user", "b."), (7, None, "assistant", "x" * 100_000)]
    rows += [(98, 5, "", "no role."), (98, 5, "user", "t" * 70 + "a."), (98, 5, "user", "t" * 70 + "b."), (98, 5, "user", "t" * 70 + "a.")]
    dropped = next(c for c in itertools.count(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return [*rows, (dropped, 0, "user", "gone."), (97, 0, "user", "été."), (97, 0, "user", "été.")]


@pytest.mark.parametrize("run_rows, block_bits", [(R.RUN_ROWS, R.BLOCK_BITS), (5, 2), (64, 5)])
def test_whole_tables(spark, run_rows, block_bits):
    rows = _table(random.Random(5))
    df = spark.createDataFrame([(*r, "pos") for r in rows], SCHEMA).withColumnRenamed("extra", "digest").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in R.repair_conversations(R.damaged(df), run_rows, block_bits).collect()}
    want = {c: brute(t) for c, t in damage(rows).items()}
    assert got == want


def test_empty_table(spark):
    assert R.repair_conversations(R.damaged(spark.createDataFrame([], SCHEMA))).collect() == []


def test_query_on_given_table(spark):
    from pricelab.llm.queries import QUERIES

    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, path).collect()}
    assert got == {c: brute(t) for c, t in damage(rows).items()}
