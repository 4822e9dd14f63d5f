"""Byte-level BPE: linear-time encoding by longest matches, and decoding.

Each piece of the split pattern is mapped byte for byte to Latin-1, so that an
Aho-Corasick automaton over all tokens finds the longest token at every byte.
Encoding then walks forward with the longest token that is compatible with the
one before it, tries that token's shorter prefixes otherwise, and steps back
when none fits; a position found dead is never entered again, which bounds the
work by the piece's length. Two adjacent tokens are compatible when undoing
their merges down to bytes shows no pair across the border that would have been
merged earlier; the answer is memoised per pair. A sequence in which all
neighbours are compatible is the one the merges produce.

Null texts count as empty; empty texts have no tokens and decode to nothing.
Every text is encoded whole, a piece without breaks of any length included.
Repeated rows give equal results, an empty table none. Other columns are kept
by :func:`encode` unless they carry the names of its results.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import chunks, once_per_worker, ship, whole_text

ship(__name__)

#: Pieces whose encoding a task remembers in each of two generations; the older one is dropped when the younger is full.
CACHE_PIECES = 100_000
#: Token pairs whose compatibility is remembered.
CACHE_PAIRS = 100_000
#: Longest piece, in bytes, that is remembered.
CACHE_BYTES = 64


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Bpe:
    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], int] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int | None] = {}
        for token, rank in ranks.items():
            self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), None)
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            self.halves[rank] = self._last_merge(token, rank)
        self.memo.clear()  # answers made before all pairs were known
        self.matcher = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.matcher.add_word(token.decode("latin-1"), (len(token), rank))
        self.matcher.make_automaton()

    def _last_merge(self, token: bytes, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge gives ``token``; None for one that no merge gives."""
        left = self.shorter[rank]
        while left is not None:
            right = self.ranks.get(token[len(self.bytes_of[left]):])
            if right is not None and left < rank and right < rank and self._compatible(left, right):
                self.pairs[left, right] = rank
                return left, right
            left = self.shorter[left]
        return None

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging keeps ``a`` and ``b`` apart, by undoing the later of the two merges each time."""
        before = 1 << 62
        while True:
            if self.pairs.get((a, b), before) < before:
                return False
            x, y = self.halves.get(a), self.halves.get(b)
            if x is None and y is None:
                return True
            # Ties (equal tokens) undo the right one: the left of two equal merges happens first.
            if y is None or (x is not None and a > b):
                before, a = min(before, a), x[1]
            else:
                before, b = min(before, b + 1), y[0]

    def compatible(self, a: int, b: int) -> bool:
        known = self.memo.get((a, b))
        if known is None:
            if len(self.memo) >= CACHE_PAIRS:
                self.memo.clear()
            known = self.memo[a, b] = self._compatible(a, b)
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        longest: list[int | None] = [None] * len(piece)
        for end, (size, rank) in self.matcher.iter(piece.decode("latin-1")):
            longest[end - size + 1] = rank  # matches come by rising end, so the last one is the longest
        size_of, dead = self.bytes_of, bytearray(len(piece) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < len(piece):
            while token is not None:
                end = at + len(size_of[token])
                if not dead[end] and (not out or self.compatible(out[-1], token)):
                    break
                token = self.shorter[token]
            if token is None:
                if not out:
                    raise ValueError("the ranks lack a byte of the text")
                dead[at] = 1
                last = out.pop()
                at -= len(size_of[last])
                token = self.shorter[last]
            else:
                out.append(token)
                at = end
                token = longest[at] if at < len(piece) else None
        return out


def _load(path: str) -> Bpe:
    return once_per_worker(("bpe", path), lambda: Bpe(read_ranks(path)))


def _encoder(path: str, pattern: str):
    return once_per_worker(("encoder", path, pattern), lambda: _new_encoder(path, pattern))


def _new_encoder(path: str, pattern: str):
    """A function from text to ids, with the encodings of short pieces remembered."""
    import regex

    bpe, split = _load(path), regex.compile(pattern).findall
    young: dict[str, tuple] = {}
    old: dict[str, tuple] = {}

    def look_up(piece: str) -> tuple:
        nonlocal young, old
        got = old.get(piece)
        if got is None:
            raw = piece.encode("utf-8")
            got = tuple(bpe.encode_piece(raw))
            if len(raw) > CACHE_BYTES:
                return got
        if len(young) >= CACHE_PIECES:
            young, old = {}, young
        young[piece] = got
        return got

    def ids(text: str) -> list[int]:
        out: list[int] = []
        extend = out.extend
        for piece in split(text):
            extend(young.get(piece) or look_up(piece))
        return out

    return ids


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text", ids_col: str = "ids", keep: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with an array of token ids. ``ranks_path`` must exist on every executor.

    Only the columns ``keep``, all of them by default, travel with the text and come back.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c != ids_col]

    def run(batches):
        ids = _encoder(ranks_path, pattern)
        for part in chunks(batches, "__text"):
            arrays = [ids(t) for t in part.column("__text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + [pa.array(arrays, pa.list_(pa.int32()))], [*keep, ids_col]
            )

    schema = docs.select(*keep).withColumn(ids_col, F.lit(None).cast("array<int>")).schema
    return docs.select(*keep, whole_text(text_col).alias("__text")).mapInArrow(run, schema)


def decode(docs: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """``docs`` with the bytes of their ids; null ids give empty bytes."""
    keep = [c for c in docs.columns if c != bytes_col]

    def run(batches):
        token = _load(ranks_path).bytes_of
        for part in batches:
            raw = [b"".join([token[i] for i in ids or ()]) for ids in part.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + [pa.array(raw, pa.binary())], [*keep, bytes_col]
            )

    schema = docs.select(*keep).withColumn(bytes_col, F.lit(None).cast("binary")).schema
    return docs.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of encoding and decoding in one pass: id, n_tokens, ids_sha256, decoded_sha256."""

    def run(batches):
        ids_of, token = _encoder(ranks_path, pattern), _load(ranks_path).bytes_of
        spelled = {i: str(i) for i in token}
        for part in chunks(batches, "text"):
            counts, ids_sha, raw_sha = [], [], []
            for text in part.column("text"):
                ids = ids_of(text.as_py())
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join([spelled[i] for i in ids]).encode()).hexdigest())
                raw_sha.append(hashlib.sha256(b"".join([token[i] for i in ids])).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(id_col), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(raw_sha)],
                [id_col, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias(id_col), whole_text(text_col).alias("text"))
    return rows.mapInArrow(run, f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string")
