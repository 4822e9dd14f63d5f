"""Cheapest repair of damaged conversations by iterative-deepening A*.

A conversation is well formed when the initials of its roles read ``(s?(ua)+)?``.
Four edits lead there: Delete (3), Insert an empty user or assistant turn (2), Keep
(0) and Rerole to user or assistant (2); a truncated turn that stays costs 1 more,
a blank or repeated one must go. The search walks the turns depth first, tries the
edits in ASCII order of their initials and deepens its cost bound only when a whole
pass fails, so the first accepted path is the cheapest and, of these, the least in
ASCII order. A table keeps for each (turn, state) the largest budget that failed.

Turns are range-partitioned by conversation and place, so that one conversation with
a third of all rows spreads over many tasks. A conversation that lies inside one
partition and below ``RUN_ROWS`` turns is searched at once. The others are cut into
segments of at most ``2 ** BLOCK_BITS`` turns: a search per pair of entry and exit
states prices each segment, one backward pass over the segments gives every exit its
cost to the end, the same search then finds each segment's edits per entry state, and
a forward pass picks the entry states. Edits of a segment are prefix-free (they end
with the segment's last turn), so the least string of the whole is made of the least
strings of its segments. These passes, and the SHA-256 of the repaired text, which no
two tasks can share, stream over one row per segment in constant memory.

Defined results: null role and text are one space, a null ``conv_id`` or ``turn`` is
one space in the damage key and otherwise stays null (one conversation; turns first).
Turns of one number stand in the order of role, first 64 code points, digest of the
text; equal rows are interchangeable. An empty role has no initial, so it cannot be
kept. A conversation without rows left has zeros and the hash of the empty string.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelab.llm.frames import ship, written

ship(__name__)

#: Turns of a conversation that one search takes whole, and bytes of text held for it.
RUN_ROWS, RUN_BYTES = 512, 16 << 20
#: Segments of longer conversations have at most 2 ** BLOCK_BITS turns.
BLOCK_BITS = 8
#: Bytes of repaired text in one row between tasks.
PIECE_BYTES = 4 << 20

# States: start, after system, after user, after assistant.
START, SYSTEM, USER, REPLY = range(4)
# The state that keeping a letter leads to; the state and role that an inserted or reroled turn has.
KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): REPLY, (REPLY, "u"): USER}
FORCED = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (REPLY, "assistant"), REPLY: (USER, "user")}
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 3, 2, 2, 1
# At the end of a conversation only insertions are left.
END_COST, END_TAIL = (0, 4, 2, 0), ("", "II", "I", "")
NEVER = 1 << 60

_BLANKS = " \t\n\v\f\r"
_LEGAL = {"su", "ua", "au"}


def code(role: str, blank: bool, duplicate: bool, truncated: bool) -> str:
    """One character for a turn: ``D`` must go; else its initial, upper case when truncated, ``?``/``!`` when no initial fits."""
    if blank or duplicate:
        return "D"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "?"
    return {"s": "S", "u": "U", "a": "A", "?": "!"}[letter] if truncated else letter


class _Bounds:
    """Admissible estimates of the cost from a turn and state to the end of the row codes.

    Every turn costs at least its own cheapest edit. Two user (or two assistant) turns
    next to each other cost 2 more, whichever edit parts them; disjoint such pairs add
    up, so the heaviest set of disjoint pairs from a turn on is a bound.
    """

    def __init__(self, codes: str, exits: tuple[int, ...]):
        n = len(codes)
        self.exits, self.low = exits, min(exits)
        low = self.low
        self.least = [low] * (n + 1)
        self.pairs = [0] * (n + 1)  # heaviest disjoint pairs among the turns from i on
        self.after = [0] * (n + 1)  # the same without the first turn that may stay
        self.letter = [""] * (n + 1)  # its letter
        self.system = [False] * (n + 1)  # a system turn is left, which the start state keeps for nothing
        self.final = {letter: min(INSERT_COST, exits[state] - low) for letter, state in (("u", USER), ("a", REPLY))}
        for i in range(n - 1, -1, -1):
            c = codes[i]
            own = c.lower() if c in "SUA" else c
            self.system[i] = self.system[i + 1] or own == "s"
            if c == "D":
                self.least[i] = self.least[i + 1] + DELETE_COST
                self.pairs[i], self.after[i], self.letter[i] = self.pairs[i + 1], self.after[i + 1], self.letter[i + 1]
                continue
            cut = TRUNCATED_COST if c in "SUA!" else 0
            fixed = min(DELETE_COST, REROLE_COST + cut) if own in "s?" else cut
            self.least[i] = self.least[i + 1] + fixed
            best = self.pairs[i + 1]
            if own in "ua":
                if not self.letter[i + 1]:
                    best = max(best, self.final[own])
                elif self.letter[i + 1] == own:
                    best = max(best, INSERT_COST + self.after[i + 1])
            self.pairs[i], self.after[i], self.letter[i] = best, self.pairs[i + 1], own

    def estimate(self, i: int, state: int) -> int:
        pairs, first = self.pairs[i], self.letter[i]
        if first in ("u", "a"):
            wrong = first == "u" if state == USER else first == "a"
            if wrong:
                pairs = max(pairs, INSERT_COST + self.after[i])
        elif not first:
            pairs = max(pairs, min(INSERT_COST, self.exits[state] - self.low))
        found = self.least[i] + pairs
        return max(0, found - REROLE_COST) if state == START and self.system[i] else found


def search(codes: str, entry: int, exits: tuple[int, ...], most: int = NEVER) -> tuple[int, str, int] | None:
    """Cost with the exit's, edits and exit state of the cheapest, then ASCII-least path; None beyond ``most``."""
    n = len(codes)
    bounds = _Bounds(codes, exits)
    estimate = bounds.estimate
    failed: dict[int, int] = {}
    bound = estimate(0, entry)
    while bound <= most and bound < NEVER:
        beyond = NEVER
        # A frame: turn, state, budget left, moves still to try (last first), edits so far.
        stack = [[0, entry, bound, None]]
        path: list[str] = []
        while stack:
            frame = stack[-1]
            i, state, left, moves = frame
            if moves is None:
                over = estimate(i, state) - left
                if over > 0:
                    beyond = min(beyond, bound + over)
                    moves = []
                elif failed.get(4 * i + state, -1) >= left:
                    # Its reasons are known no more; a pass that fails raises the bound by one at least.
                    beyond = min(beyond, bound + 1)
                    moves = []
                elif i == n:
                    if exits[state] <= left:
                        return bound - left + exits[state], "".join(path), state
                    beyond = min(beyond, bound + exits[state] - left)
                    moves = []
                else:
                    moves = _moves(codes[i], state)
                frame[3] = moves
            if moves:
                letter, step, to, cost = moves.pop()
                if cost <= left:
                    path.append(letter)
                    stack.append([i + step, to, left - cost, None])
                else:
                    beyond = min(beyond, bound + cost - left)
                continue
            if i < n:
                key = 4 * i + state
                if failed.get(key, -1) < left:
                    failed[key] = left
            stack.pop()
            if path:
                path.pop()
        bound = beyond
    return None


def _moves(c: str, state: int) -> list[tuple[str, int, int, int]]:
    """Edits at a turn as (initial, turns consumed, next state, cost), the ASCII-least last."""
    made = FORCED[state][0]
    if c == "D":
        return [("I", 0, made, INSERT_COST), ("D", 1, state, DELETE_COST)]
    cut = TRUNCATED_COST if c in "SUA!" else 0
    out = [("R", 1, made, REROLE_COST + cut)]
    kept = KEEP.get((state, c.lower()))
    if kept is not None:
        out.append(("K", 1, kept, cut))
    return [*out, ("I", 0, made, INSERT_COST), ("D", 1, state, DELETE_COST)]


def prices(codes: str) -> list[int]:
    """Cheapest cost from each entry to each exit state of a segment, row by row; ``NEVER`` where there is no way."""
    n, out = len(codes), []
    for entry in range(4):
        for to in range(4):
            if to >= USER:
                ends = tuple(0 if s == to else NEVER for s in range(4))
                # Deleting everything after two insertions at most bounds every reachable pair.
                found = search(codes, entry, ends, DELETE_COST * n + 2 * INSERT_COST)
                out.append(found[0] if found else NEVER)
            elif entry == to:
                # Nothing but deletions stays at the start or behind the system turn.
                out.append(DELETE_COST * n)
            elif entry == START and to == SYSTEM and any(c in "sS" for c in codes):
                out.append(DELETE_COST * (n - 1) + (0 if "s" in codes else TRUNCATED_COST))
            else:
                out.append(NEVER)
    return out


def repaired_lines(edits: str, entry: int, turns) -> tuple[list[str], int]:
    """``role:text`` lines after the edits of a segment, and the state behind them."""
    out, state = [], entry
    rows = iter(turns)
    for edit in edits:
        if edit == "I":
            state, role = FORCED[state]
            out.append(f"{role}:")
            continue
        role, text = next(rows)
        if edit == "K":
            state = KEEP[state, role[0]]
            out.append(f"{role}:{text}")
        elif edit == "R":
            state, role = FORCED[state]
            out.append(f"{role}:{text}")
    return out, state


def faults(text: str) -> tuple[bool, bool]:
    """Whether a text is blank, and whether its last non-blank character ends no sentence."""
    body = text.rstrip(_BLANKS)
    return not body, bool(body) and body[-1] not in ".!?"


def _illegal(roles: list[str]) -> int:
    return sum(a[:1] + b[:1] not in _LEGAL for a, b in zip(roles, roles[1:]))


def repair(turns: list[tuple]) -> tuple:
    """Result columns of one whole conversation of (turn, role, text) in order."""
    seen: set[tuple[str, str]] = set()
    codes, counts = [], [0, 0, 0]
    for _, role, text in turns:
        blank, truncated = faults(text)
        duplicate = (role, text) in seen
        seen.add((role, text))
        if blank or duplicate or truncated:
            counts[0 if blank else 1 if duplicate else 2] += 1
        codes.append(code(role, blank, duplicate, truncated))
    cost, edits, state = search("".join(codes), START, END_COST)
    lines, _ = repaired_lines(edits + END_TAIL[state], START, [(r, t) for _, r, t in turns])
    numbers = {t for t, _, _ in turns if t is not None}
    gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, *counts, _illegal([r for _, r, _ in turns]), cost, edits + END_TAIL[state], digest


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) after the dealt damage; dropped rows stay as ``gone`` markers."""
    word = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.pmod(F.crc32(F.concat(word("conv_id"), F.lit(":"), word("turn")).cast("binary")), F.lit(20))
    base = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), word("role").alias("role"), word("text").alias("text"), fate.alias("fate"))
    gone = F.col("fate") == 0
    text = F.when(F.col("fate") <= 1, F.lit("")).when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(gone, F.lit("")).when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return base.select("conv_id", F.when(~gone, F.col("turn")).alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone"), F.explode(copies).alias("copy")).drop("copy")


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_RESULT_NAMES = [part.split()[0] for part in _RESULT.split(", ")]


def _fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def repair_conversations(rows: DataFrame, run_rows: int = RUN_ROWS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """One row per ``conv_id`` of ``rows`` (conv_id, turn, role, text, gone boolean) with faults, edits and the repaired text's hash.

    ``gone`` rows only keep their conversation in the result.
    """
    spark = rows.sparkSession
    conv = rows.schema["conv_id"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    head, digest = F.substring("text", 1, 64), F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    keyed = rows.select("conv_id", "turn", "role", "text", "gone", head.alias("head"), digest.alias("digest"), F.monotonically_increasing_id().alias("row"))
    order = ["conv_id", "turn", "role", "head", "digest", "row"]
    placed = keyed.repartitionByRange(width, *order).sortWithinPartitions(*order)
    placed = placed.select("conv_id", "turn", "role", "text", "gone", "digest", F.monotonically_increasing_id().alias("pos"))
    solved_schema = T.StructType(
        [T.StructField("conv_id", conv.dataType), *_fields("pos long, turn long, role string, text string, gone boolean, digest string"), *_fields(_RESULT)]
    )
    solved = written(placed.mapInArrow(_solve_runs(solved_schema, run_rows), solved_schema), "repaired")
    whole = solved.where("pos IS NULL").select("conv_id", *_RESULT_NAMES)
    parts = solved.where("pos IS NOT NULL").select("conv_id", "pos", "turn", "role", "text", "gone", "digest")
    return whole.unionByName(_long_conversations(parts, block_bits))


def _names_of(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]


def _arrow_rows(schema: T.StructType):
    """A function from lists of row tuples to Arrow batches of ``schema``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return batch


def _tuples(batches, names):
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _solve_runs(schema: T.StructType, run_rows: int):
    """Result rows of conversations inside the partition, input rows of all others."""
    as_batch = _arrow_rows(schema)
    empty = (None,) * len(_RESULT_NAMES)

    def part(row):
        conv, turn, role, text, gone, digest, pos = row
        return (conv, pos, turn, role, text, gone, digest, *empty)

    def whole(run):
        turns = [(turn, role, text) for _, turn, role, text, gone, _, _ in run if not gone]
        return (run[0][0], *((None,) * 6), *repair(turns))

    def task(batches):
        out, held, run, size, first, long = [], 0, [], 0, True, False
        for row in _tuples(batches, ["conv_id", "turn", "role", "text", "gone", "digest", "pos"]):
            if run and row[0] != run[0][0] or long and row[0] != long[0]:
                # The first run may have begun in the partition before.
                out.extend(map(part, run) if first or long else [whole(run)])
                run, size, first, long = [], 0, False, False
            run.append(row)
            size += len(row[3])
            held += len(row[3])
            if long or len(run) > run_rows or size > RUN_BYTES:
                long = (row[0],)
                out.extend(map(part, run))
                run, size = [], 0
            if held > PIECE_BYTES or len(out) > 4096:
                yield as_batch(out)
                out, held = [], 0
        # The last one may go on in the next.
        out.extend(map(part, run))
        if out:
            yield as_batch(out)

    return task


def _long_conversations(parts: DataFrame, block_bits: int) -> DataFrame:
    conv = parts.schema["conv_id"]
    key = [T.StructField("conv_id", conv.dataType)]
    block = F.shiftright("pos", block_bits).alias("block")

    firsts = parts.where("NOT gone").groupBy("conv_id", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("new"))
    trimmed = F.rtrim(F.translate("text", _BLANKS, " " * len(_BLANKS)))
    narrow = parts.select(
        "conv_id", "pos", "turn", F.substring("role", 1, 1).alias("initial"), "gone",
        (trimmed == "").alias("blank"), (~F.substring(trimmed, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    narrow = narrow.join(firsts, "pos", "left").withColumn("new", F.coalesce("new", F.lit(False))).select("*", block)
    segment = _fields(
        "block long, seg long, codes string, price array<long>, blank long, duplicate long, truncated long, illegal long, "
        "first string, last string, turns long, low long, high long"
    )
    schema = T.StructType(key + segment)
    segments = narrow.repartition("block").sortWithinPartitions("block", "pos").mapInArrow(_price_segments(schema), schema)
    segments = written(segments, "segments")

    costed = T.StructType(key + _fields("block long, seg long, codes string, exits array<long>"))
    backward = segments.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("seg"))
    costs = backward.select("conv_id", "block", "seg", "codes", "price").mapInArrow(_cost_exits(costed), costed)

    edited = T.StructType(key + _fields("block long, seg long, edits array<string>, after array<int>, cost long"))
    choices = costs.repartition("seg").mapInArrow(_edit_segments(edited), edited)

    chosen = T.StructType(key + _fields("block long, pos long, entry int, edits string, cost long"))
    forward = choices.repartition("conv_id").sortWithinPartitions("conv_id", "seg")
    plan = written(forward.mapInArrow(_choose_entries(chosen), chosen), "edits")

    piece = T.StructType(key + _fields("seg long, piece int, lines binary"))
    texts = parts.select("conv_id", block, "pos", F.lit(1).alias("kind"), "role", "text", "gone", F.lit(0).alias("entry"))
    edits = plan.select("conv_id", "block", "pos", F.lit(0).alias("kind"), F.lit("").alias("role"), F.col("edits").alias("text"), F.lit(False).alias("gone"), "entry")
    both = texts.unionByName(edits).repartition("block").sortWithinPartitions("block", "pos", "kind")
    pieces = both.select("conv_id", "pos", "kind", "role", "text", "gone", "entry").mapInArrow(_apply_edits(piece), piece)

    counts = ["blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "low", "high"]
    heads = segments.join(plan.select(F.col("pos").alias("seg"), "edits", "cost"), "seg")
    heads = heads.select("conv_id", "seg", F.lit(-1).alias("piece"), F.lit(None).cast("binary").alias("lines"), "edits", "cost", *counts)
    pieces = pieces.unionByName(heads, allowMissingColumns=True)
    result = T.StructType(key + _fields(_RESULT))
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "seg", "piece")
    return ordered.select(*_names_of(T.StructType(key)), "piece", "lines", "edits", "cost", *counts).mapInArrow(_finish(result), result)


def _runs(rows, *at: int):
    """Lists of neighbouring rows that agree in the fields ``at``; only for rows of one block."""
    run: list[tuple] = []
    for row in rows:
        if run and any(row[i] != run[0][i] for i in at):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def _price_segments(schema):
    as_batch = _arrow_rows(schema)
    names = ["conv_id", "block", "pos", "turn", "initial", "gone", "blank", "truncated", "new"]

    def task(batches):
        for run in _runs(_tuples(batches, names), 0, 1):
            conv, block, seg = run[0][:3]
            stay = [row for row in run if not row[5]]
            codes = "".join(code(initial, blank, not new, cut) for _, _, _, _, initial, _, blank, cut, new in stay)
            counts = [0, 0, 0]
            for *_, blank, cut, new in stay:
                if blank or not new or cut:
                    counts[0 if blank else 1 if not new else 2] += 1
            turns = [row[3] for row in stay if row[3] is not None]
            initials = [row[4] for row in stay]
            ends = (initials[0], initials[-1]) if initials else (None, None)
            span = (min(turns), max(turns)) if turns else (None, None)
            yield as_batch([(conv, block, seg, codes, prices(codes), *counts, _illegal(initials), *ends, len(set(turns)), *span)])

    return task


def _cost_exits(schema):
    """From the last segment of a conversation to its first: what each exit state costs until the end."""
    as_batch = _arrow_rows(schema)

    def task(batches):
        now, exits = None, END_COST
        for batch in batches:
            out = []
            for conv, block, seg, codes, price in _tuples([batch], ["conv_id", "block", "seg", "codes", "price"]):
                if now is None or now[0] != conv:
                    now, exits = (conv,), END_COST
                out.append((conv, block, seg, codes, list(exits)))
                exits = tuple(min(NEVER, *(price[4 * s + t] + exits[t] for t in range(4))) for s in range(4))
            yield as_batch(out)

    return task


def _edit_segments(schema):
    """Cheapest edits of a segment for each state it may be entered in."""
    as_batch = _arrow_rows(schema)

    def task(batches):
        for batch in batches:
            out = []
            for conv, block, seg, codes, exits in _tuples([batch], ["conv_id", "block", "seg", "codes", "exits"]):
                found = [search(codes, entry, tuple(exits)) for entry in range(4)]
                edits = [f[1] for f in found]
                out.append((conv, block, seg, edits, [f[2] for f in found], found[START][0]))
            yield as_batch(out)

    return task


def _choose_entries(schema):
    """From the first segment on: the state each is entered in. The whole cost stands at the first one."""
    as_batch = _arrow_rows(schema)

    def task(batches):
        # The last segment's tail needs the next row, so one row is held back.
        now, state, held = None, START, None
        for batch in batches:
            out = []
            for conv, block, seg, edits, after, cost in _tuples([batch], ["conv_id", "block", "seg", "edits", "after", "cost"]):
                begins = now is None or now[0] != conv
                if held is not None:
                    out.append((*held[:4], held[4] + (END_TAIL[state] if begins else ""), held[5]))
                if begins:
                    now, state = (conv,), START
                held = (conv, block, seg, state, edits[state], cost if begins else 0)
                state = after[state]
            if out:
                yield as_batch(out)
        if held is not None:
            yield as_batch([(*held[:4], held[4] + END_TAIL[state], held[5])])

    return task


def _apply_edits(schema):
    """Repaired lines of each segment, in pieces of bounded size; the edits of a segment come before its rows."""
    as_batch = _arrow_rows(schema)

    def task(batches):
        conv = seg = None
        edits, state, at, number = "", START, 0, 0
        lines: list[str] = []
        size = 0

        def insertions():
            """Turns inserted before the next turn's own edit."""
            nonlocal state, at
            begin = at
            while at < len(edits) and edits[at] == "I":
                at += 1
            made, state = repaired_lines(edits[begin:at], state, ())
            lines.extend(made)

        def flush():
            return as_batch([(conv, seg, number, "".join(f"{x}\n" for x in lines).encode())])

        for row_conv, pos, kind, role, text, gone, entry in _tuples(batches, ["conv_id", "pos", "kind", "role", "text", "gone", "entry"]):
            if kind == 0:
                if seg is not None and lines:
                    yield flush()
                conv, seg, edits, state, at, number, lines, size = row_conv, pos, text, entry, 0, 0, [], 0
                insertions()
                continue
            if gone:
                continue
            edit = edits[at]
            at += 1
            kept, state = repaired_lines(edit, state, [(role, text)])
            lines += kept
            size += sum(map(len, kept))
            insertions()
            if size > PIECE_BYTES:
                yield flush()
                lines, size, number = [], 0, number + 1
        if seg is not None and lines:
            yield flush()

    return task


def _finish(schema):
    """Counts, edits and hash of each conversation from its segments in order."""
    as_batch = _arrow_rows(schema)
    names = ["conv_id", "piece", "lines", "edits", "cost", "blank", "duplicate", "truncated", "illegal", "first", "last", "turns", "low", "high"]

    class State:
        def __init__(self, conv):
            self.conv, self.sha, self.begun, self.edits, self.counts = conv, hashlib.sha256(), False, [], [0] * 5
            self.last = self.low = self.high = None
            self.turns = 0

        def head(self, edits, cost, blank, duplicate, truncated, illegal, first, last, turns, low, high):
            self.edits.append(edits)
            if first is not None:
                illegal += self.last is not None and self.last + first not in _LEGAL
                self.last = last
            for i, x in enumerate((blank, duplicate, truncated, illegal, cost)):
                self.counts[i] += x
            if low is not None:
                # Turns are in order, so only the first one can have been counted before.
                self.turns += turns - (self.high == low)
                self.low = low if self.low is None else self.low
                self.high = high

        def lines(self, lines):
            # Every line brings its newline; the one before the first line of all and the last are left out.
            self.sha.update((b"\n" if self.begun else b"") + lines[:-1])
            self.begun = True

        def row(self):
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
            return (self.conv, gaps, *self.counts[:4], self.counts[4], "".join(self.edits), self.sha.hexdigest())

    def task(batches):
        state = None
        for batch in batches:
            out = []
            for conv, piece, lines, *head in _tuples([batch], names):
                if state is None or state.conv != conv:
                    if state is not None:
                        out.append(state.row())
                    state = State(conv)
                if piece < 0:
                    state.head(*head)
                else:
                    state.lines(lines)
            if out:
                yield as_batch(out)
        if state is not None:
            yield as_batch([state.row()])

    return task
