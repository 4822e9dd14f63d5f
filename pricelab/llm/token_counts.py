"""Exact token counts at every prefix of a text, by dynamic programming over its pieces.

Of byte-level BPE the last token of a prefix's encoding is the one token that ends
there and agrees with the last token of the prefix before it, and its count is that
prefix's plus one. One pass over a piece therefore knows the count of *every*
prefix. Piece counts are kept by the worker and laid end to end, which gives the
count of each prefix of the whole text, so that questions for the length of a text,
for the part that fits a budget or for the tokens of a passage's head are look-ups:
nothing is encoded again.

A prefix is counted as the library would count it standing alone. Three places need
care, since a text splits into pieces with a look at what follows: the last blank of
a run goes to the next word, so a prefix that ends inside or right behind a run
counts the run as one piece; a contraction cut before its last letter is two pieces;
and a special string counts as one token only when it is complete.

Null texts count as empty: no bytes, no tokens. Texts of any length are counted
whole. Repeated rows give repeated results, an empty table none. Other columns are
ignored unless asked for, whatever their names.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import chunks, once_per_worker, ship, whole_text

ship(__name__)

#: Characters of pieces, and pairs of tokens, that a worker remembers before it starts anew.
CACHE_CHARS, CACHE_PAIRS = 8 << 20, 500_000

# Contractions of three characters, which a shorter prefix splits differently.
_LONG_CONTRACTIONS = ("'re", "'ve", "'ll")


class PrefixCounter:
    """Counts of a byte-level BPE in the JSON form of the tokenizers library."""

    def __init__(self, path: str, pattern: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("only byte-level BPE without a normaliser or prefix space is counted")
        specials = [t for t in spec["added_tokens"]]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in specials):
            raise ValueError("special strings that take their surroundings are not counted")
        self.split = regex.compile(pattern).findall
        names = [t["content"] for t in specials]
        self.specials = regex.compile("|".join(regex.escape(n) for n in sorted(names, key=len, reverse=True))) if names else None
        to_byte = _byte_letters()
        raw = lambda token: bytes(to_byte[c] for c in token)
        #: Rank of the merge of two neighbours; tokens are told apart by their bytes.
        self.rank = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.rank[raw(a), raw(b)] = rank
        self.agreed: dict[tuple[bytes, bytes], bool] = {}
        self.matcher = ahocorasick.Automaton()
        for token in model["vocab"]:
            if token not in names:
                self.matcher.add_word(raw(token).decode("latin-1"), raw(token))
        self.matcher.make_automaton()
        self.forget()

    def forget(self):
        #: Number of a piece; ``flat`` holds the counts of its ``length`` prefixes from ``start`` on, ``total`` the last one.
        self.index: dict[str, int] = {}
        self.start, self.length, self.total, self.flat = array("q"), array("q"), array("q"), array("q")

    def agree(self, a: bytes, b: bytes) -> bool:
        """Whether two tokens stay as they are when their bytes are merged together."""
        known = self.agreed.get((a, b))
        if known is None:
            if len(self.agreed) >= CACHE_PAIRS:
                self.agreed.clear()
            known = self.agreed[a, b] = self._merged(a + b) == [a, b]
        return known

    def _merged(self, raw: bytes) -> list[bytes]:
        """Plain merges, least rank first; only for the few bytes of two tokens."""
        parts = [raw[i:i + 1] for i in range(len(raw))]
        while len(parts) > 1:
            ranked = [(self.rank.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def byte_prefixes(self, raw: bytes) -> list[int]:
        """Token counts of the prefixes of 0, 1, ... bytes of one piece."""
        count, last = [0] * (len(raw) + 1), [b""] * (len(raw) + 1)
        ending: list[list[bytes]] = [[] for _ in range(len(raw) + 1)]
        for end, token in self.matcher.iter(raw.decode("latin-1")):
            ending[end + 1].append(token)
        for end in range(1, len(raw) + 1):
            for token in ending[end]:
                begin = end - len(token)
                if begin == 0 or (last[begin] and self.agree(last[begin], token)):
                    # A token that merges do not give from its own bytes is no encoding of them.
                    if begin == 0 and len(token) > 1 and not self._whole(token):
                        continue
                    count[end], last[end] = count[begin] + 1, token
                    break
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return count

    def _whole(self, token: bytes) -> bool:
        known = self.agreed.get((b"", token))
        if known is None:
            known = self.agreed[b"", token] = self._merged(token) == [token]
        return known

    def piece_prefixes(self, piece: str) -> list[int]:
        """Token counts after each character of one piece, the piece alone."""
        counts = self.byte_prefixes(piece.encode())
        if piece in _LONG_CONTRACTIONS:
            return [1, 1 + self.byte_prefixes(piece[1].encode())[-1], counts[-1]]
        if piece.isascii():
            return counts[1:]
        ends = np.cumsum([len(c.encode()) for c in piece])
        return [counts[e] for e in ends]

    def _piece(self, piece: str) -> int:
        at = self.index.get(piece)
        if at is None:
            counts = self.piece_prefixes(piece)
            at = len(self.start)
            self.index[piece] = at
            self.start.append(len(self.flat))
            self.length.append(len(counts))
            self.total.append(counts[-1])
            self.flat.extend(counts)
        return at

    def _plain(self, text: str) -> np.ndarray:
        """Counts after each character of a text without special strings."""
        if not text:
            return np.zeros(0, np.int64)
        if len(self.flat) > CACHE_CHARS:
            self.forget()
        pieces = self.split(text)
        index = self.index
        at = np.fromiter((index[p] if p in index else self._piece(p) for p in pieces), np.int64, len(pieces))
        runs = [(i, self._piece(pieces[i] + pieces[i + 1][0])) for i in self._cut_runs(pieces)]
        # Views of growing arrays; they end with this call.
        start, length, total, flat = (np.frombuffer(a, np.int64) for a in (self.start, self.length, self.total, self.flat))
        sizes, totals = length[at], total[at]
        ends = np.cumsum(sizes)
        before = np.cumsum(totals) - totals
        out = flat[np.arange(ends[-1]) + np.repeat(start[at] - (ends - sizes), sizes)] + np.repeat(before, sizes)
        # A prefix that ends with the blanks before a word holds them as one piece.
        for i, run in runs:
            out[ends[i]] = before[i] + total[run]
        return out

    @staticmethod
    def _cut_runs(pieces: list[str]) -> list[int]:
        """Pieces of blanks that gave their last blank to the next piece."""
        return [i for i in range(len(pieces) - 1) if pieces[i].isspace() and pieces[i + 1][0].isspace()]

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, ... characters, each as if it stood alone."""
        out, base, at = [np.zeros(1, np.int64)], 0, 0
        for special in self.specials.finditer(text) if self.specials else ():
            begin, end = special.span()
            # Until its last character the special string is ordinary text.
            counts = self._plain(text[at:end - 1])
            out.append(base + counts)
            base += (int(counts[begin - at - 1]) if begin > at else 0) + 1
            out.append(np.array([base]))
            at = end
        out.append(base + self._plain(text[at:]))
        return np.concatenate(out)


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 letters for themselves, 256 on for the rest."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _counter(path: str, pattern: str) -> PrefixCounter:
    return once_per_worker(("prefix-counter", path, pattern), lambda: PrefixCounter(path, pattern))


def fits(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    return int(np.flatnonzero(counts <= budget)[-1])


def prefix_counts(
    docs: DataFrame, path: str, pattern: str, budgets: Sequence[int] = (), keep: Sequence[str] = ("doc_id",), text_col: str = "text", store: bool = True
) -> DataFrame:
    """``keep`` columns with ``n_bytes``, ``n_tokens``, ``fit_<budget>`` per budget and the stored counts.

    ``fit_<budget>`` is the length in characters of the longest prefix of at most that
    many tokens. With ``store``, ``counts`` holds the token count of every prefix, the
    empty one first; :func:`tokens_at` and :func:`longest_within` answer later questions
    from it in Spark SQL.
    """
    keep, budgets = list(keep), list(budgets)

    def run(batches):
        counter = _counter(path, pattern)
        for part in chunks(batches, "__text"):
            sizes, totals, cuts, stored = [], [], [[] for _ in budgets], []
            for value in part.column("__text"):
                text = value.as_py()
                counts = counter.prefixes(text)
                sizes.append(value.as_buffer().size)
                totals.append(int(counts[-1]))
                for cut, budget in zip(cuts, budgets):
                    cut.append(fits(counts, budget))
                if store:
                    stored.append(counts.astype(np.int32))
            columns = [pa.array(sizes, pa.int64()), pa.array(totals, pa.int64()), *(pa.array(c, pa.int64()) for c in cuts)]
            if store:
                columns.append(pa.array(stored, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays([*(part.column(f"__{c}") for c in keep), *columns], names)

    new = ["n_bytes", "n_tokens", *(f"fit_{b}" for b in budgets)]
    names = [*keep, *new, *(["counts"] if store else [])]
    rows = docs.select(*(F.col(c).alias(f"__{c}") for c in keep), whole_text(text_col).alias("__text"))
    schema = docs.select(*keep, *(F.lit(0).cast("long").alias(c) for c in new), *([F.lit(None).cast("array<int>").alias("counts")] if store else [])).schema
    return rows.mapInArrow(run, schema)


def tokens_at(chars: F.Column, counts: str = "counts") -> F.Column:
    """Tokens of the prefix of ``chars`` characters, from stored counts; null beyond the text."""
    return F.try_element_at(counts, (chars + 1).cast("int"))


def longest_within(budget: int, counts: str = "counts") -> F.Column:
    """Characters of the longest prefix within ``budget`` tokens, from stored counts."""
    return F.expr(f"array_max(filter(transform({counts}, (n, i) -> if(n <= {int(budget)}, i, null)), i -> i is not null))")
