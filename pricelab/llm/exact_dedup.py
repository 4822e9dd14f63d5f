"""Exact duplicates by radix tries over (length, content hash) partitions.

Rows of equal length and content hash meet in one partition, whose compressed
radix trie holds the whole byte strings. A terminal node stores the owner
(largest or smallest identifier) and the copies counted so far. Before the
shuffle every map task folds its own copies in a trie of bounded size, so a text
that fills a third of the table arrives as a few rows per map task.

A trie that outgrows ``limit`` bytes writes its heaviest subtree to a file of
the task and goes on; later keys below that subtree are appended to the same
file, which is rebuilt as a trie of its own at the end.

Null texts count as empty. Empty texts, ties, repeated rows and null identifiers
are ordinary members of their group (a group of null identifiers only has a null
owner). An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import heapq
import pickle
import tempfile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import chunks, ship, whole_text, written

ship(__name__)

#: Bytes of strings that a trie holds before it spills or flushes a part.
TRIE_BYTES = 48 << 20


def shared_prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving on slice comparisons."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while lo < n:
        mid = (lo + n + 1) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            n = mid - 1
    return lo


class Node:
    __slots__ = ("label", "children", "owner", "count", "spill")

    def __init__(self, label: bytes):
        self.label, self.children, self.owner, self.count, self.spill = label, {}, None, 0, None


class RadixTrie:
    """Byte strings with an owner and a count at each terminal node.

    ``better(a, b)`` picks the owner. With ``folder`` the trie spills subtrees.
    """

    def __init__(self, better=min, limit: int = TRIE_BYTES, folder: str | None = None):
        self.root, self.better, self.limit, self.folder = Node(b""), better, limit, folder
        self.held = 0

    def insert(self, key: bytes, owner, count: int = 1) -> None:
        node, at = self.root, 0
        while True:
            if node.spill is not None:
                pickle.dump((key[at:], owner, count), node.spill)
                return
            if at == len(key):
                break
            child = node.children.get(key[at])
            if child is None:
                child = Node(key[at:])
                node.children[key[at]] = child
                self.held += len(child.label) + 200
                node, at = child, len(key)
                break
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            keep = shared_prefix(label, key[at:at + len(label)])
            upper = Node(label[:keep])
            child.label = label[keep:]
            upper.children[child.label[0]] = child
            node.children[key[at]] = upper
            self.held += 200
            node, at = upper, at + keep
        if owner is not None:
            node.owner = owner if node.owner is None else self.better(node.owner, owner)
        node.count += count
        if self.folder and self.held > self.limit:
            self._spill()

    def _weigh(self, node: Node) -> int:
        total, stack = 0, [node]
        while stack:
            x = stack.pop()
            total += len(x.label) + 200
            stack.extend(x.children.values())
        return total

    def _spill(self) -> None:
        """Write the heaviest subtrees below the first branching to files until half the bound is free."""
        top = self.root
        while len(top.children) == 1 and not top.count and top.spill is None:
            top = next(iter(top.children.values()))
        heavy = heapq.nlargest(256, ((self._weigh(c), b) for b, c in top.children.items() if c.spill is None))
        for weight, first in heavy:
            if self.held <= self.limit // 2:
                return
            node = top.children[first]
            out = tempfile.TemporaryFile(dir=self.folder)
            for x in list(self._open(node)):
                pickle.dump(x, out)
            node.children, node.owner, node.count, node.spill = {}, None, 0, out
            self.held -= weight

    def _open(self, node: Node):
        """All entries below ``node``, those of spilled subtrees included."""
        stack = [(node, b"")]
        while stack:
            x, prefix = stack.pop()
            if x.spill is not None:
                yield from ((prefix + k, o, n) for k, o, n in self._read(x.spill))
                x.spill.close()
            if x.count:
                yield prefix, x.owner, x.count
            stack.extend((c, prefix + c.label) for c in x.children.values())

    @staticmethod
    def _read(file):
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return

    def items(self):
        """(key, owner, count) of all terminals; spilled subtrees are rebuilt one at a time."""
        stack = [(self.root, b"")]
        while stack:
            x, prefix = stack.pop()
            if x.spill is not None:
                sub = RadixTrie(self.better, self.limit, self.folder)
                for key, owner, count in self._read(x.spill):
                    sub.insert(key, owner, count)
                x.spill.close()
                yield from ((prefix + k, o, n) for k, o, n in sub.items())
                continue
            if x.count:
                yield prefix, x.owner, x.count
            stack.extend((c, prefix + c.label) for c in x.children.values())


_PARTIAL = "text binary, size long, hash long, owner long, n long"


def _rows(entries, size: int = 2 << 20):
    """Arrow batches of (text, owner, n) with a bounded number of bytes."""
    keys, owners, counts, held = [], [], [], 0
    for key, owner, n in entries:
        keys.append(key), owners.append(owner), counts.append(n)
        held += len(key) + 64
        if held > size:
            yield keys, owners, counts
            keys, owners, counts, held = [], [], [], 0
    if keys:
        yield keys, owners, counts


def _fold(better, limit):
    """Map side: one row per distinct text of the batch run, owners folded in a trie."""

    def run(batches):
        trie = RadixTrie(better)

        def flush():
            for keys, owners, counts in _rows(trie.items()):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(owners, pa.int64()), pa.array(counts, pa.int64())],
                    ["text", "owner", "n"],
                )

        for part in chunks(batches, "text"):
            for key, owner in zip(part.column("text"), part.column("id").to_pylist()):
                trie.insert(key.as_buffer().to_pybytes(), owner)
            if trie.held > limit:
                yield from flush()
                trie = RadixTrie(better)
        yield from flush()

    return run


def _owners(better, limit):
    """Reduce side: the trie of a partition, one row per distinct text."""

    def run(batches):
        import hashlib

        with tempfile.TemporaryDirectory(prefix="trie-") as folder:
            trie = RadixTrie(better, limit, folder)
            for part in chunks(batches, "text"):
                cols = zip(part.column("text"), part.column("owner").to_pylist(), part.column("n").to_pylist())
                for key, owner, n in cols:
                    trie.insert(key.as_buffer().to_pybytes(), owner, n)
            for keys, owners, counts in _rows(trie.items()):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashlib.sha256(k).digest() for k in keys], pa.binary()),
                        pa.array([len(k) for k in keys], pa.int64()),
                        pa.array(owners, pa.int64()), pa.array(counts, pa.int64()),
                    ],
                    ["sha", "size", "owner", "n"],
                )

    return run


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
           limit: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: ``sha`` and ``size`` of its bytes, ``owner`` and copies ``n``.

    Two different texts of one digest would make the lookup ambiguous; the trie
    tells them apart, and :func:`dedup` then fails loudly instead of merging them.
    """
    better = {"max": max, "min": min}[keep]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).cast("binary").alias("text"))
    folded = rows.mapInArrow(_fold(better, limit), "text binary, owner long, n long")
    dealt = folded.withColumns({"size": F.octet_length("text"), "hash": F.xxhash64("text")}).repartition("size", "hash")
    return dealt.select("text", "owner", "n").mapInArrow(_owners(better, limit), "sha binary, size long, owner long, n long")


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max") -> DataFrame:
    """One row per document, copies included: id, keep_id, group_size, kept, text_sha256.

    ``kept`` marks the row whose identifier owns the group; a repeated row with
    the same identifier and text is marked as its twin is.
    """
    found = written(owners(docs, id_col, text_col, keep), "owners")
    if not found.groupBy("sha", "size").count().where("count > 1").isEmpty():
        raise ValueError("two texts share one digest")
    text = whole_text(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias(id_col), F.octet_length(text).cast("long").alias("size"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("sha"),
    )
    return rows.join(found, ["sha", "size"]).select(
        id_col, F.col("owner").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("owner").eqNullSafe(F.col(id_col))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _older(keep: str):
    sign = {"max": 1, "min": -1}[keep]

    def better(a, b):
        # Owners are (identifier, other values); any identifier is better than none.
        known = [x for x in (a, b) if x[0] is not None]
        return max(known, key=lambda x: sign * x[0]) if known else a

    return better


def _own_rows(text_col: str, id_col: str, keep: str, limit: int, spill: bool):
    """The row that owns each text, by a trie whose terminals hold the other columns."""

    def run(batches):
        better = _older(keep)
        with tempfile.TemporaryDirectory(prefix="trie-") as folder:
            fresh = lambda: RadixTrie(better, limit, folder if spill else None)
            trie, schema = fresh(), None

            def flush():
                for keys, owners, _ in _rows(trie.items()):
                    columns = {c: [o[1][c] for o in owners] for c in schema.names if c != "__key"}
                    yield pa.RecordBatch.from_pydict({**columns, "__key": keys}, schema)

            for part in chunks(batches, "__key"):
                schema = part.schema
                rest = part.drop_columns(["__key"]).to_pylist()
                for key, values in zip(part.column("__key"), rest):
                    trie.insert(key.as_buffer().to_pybytes(), (values[id_col], values))
                if not spill and trie.held > limit:
                    yield from flush()
                    trie = fresh()
            if schema is not None:
                yield from flush()

    return run


def distinct_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "max",
                   limit: int = TRIE_BYTES) -> DataFrame:
    """The rows of ``docs`` that own their text, all columns kept; of repeated owner rows one stays.

    The rows travel once: tries on both sides of the shuffle hold them whole. A
    null text that owns its group comes back null.
    """
    text = F.col(text_col).cast("string")
    # The text moves into the trie's key; whether it was null stays with the row.
    slim = docs.withColumns({"__null": text.isNull(), "__key": whole_text(text_col).cast("binary")}).drop(text_col)
    folded = slim.mapInArrow(_own_rows(text_col, id_col, keep, limit, False), slim.schema)
    dealt = folded.repartition(F.octet_length("__key"), F.xxhash64("__key"))
    owned = dealt.mapInArrow(_own_rows(text_col, id_col, keep, limit, True), slim.schema)
    back = owned.withColumn(text_col, F.when(~F.col("__null"), F.col("__key").cast("string")))
    return back.select(*docs.columns)
