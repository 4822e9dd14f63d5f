"""Language-model scores from Elias-Fano trigram tries, sharded by middle word.

Documents are dealt to chunks by a hash. With u, v the two tokens before w, each
chunk sends its distinct (v, u, w), nested as v, its u, their w, with counts in
training documents, to the shard of v; a phrase that fills the corpus is one
request per chunk. A shard adds up the counts, which hold c(v), c(u,v), c(v,w) and
c(u,v,w) at once, and builds a trie in mapped memory: words v, monotone pointers to
the words before (u) and after (w) each, and pointers from each (u, v) to its
successors. A successor in the last level is its place among the successors of v,
so it is searched relative to its context: first w below v, then that place below
(u, v). Each level is an Elias-Fano sequence; one byte per entry holds a smoothed
log probability and one per context its back-off weight, both rounded down:

    P(w | u, v) = c(u,v,w) / (c(u,v) + BACK[1])                  if c(u,v,w) > 0
                  BACK[1] / (c(u,v) + BACK[1]) * P(w | v)        otherwise
    P(w | v)    = c(v,w) / (c(v) + BACK[0])                      if c(v,w) > 0
                  BACK[0] / (c(v) + BACK[0]) * (c(w)+1) / (N+V+1)  otherwise

so no probability is above 1 and those of one context sum to at most 1 (a byte ends
at 10 ** -12.65). Every distinct request is looked up in the trie; the answers go
back to the chunks, which score their documents. No model is ever whole in one
place. Words and pairs that a sample finds more often than once in two shards (or
in ``1 / RAREST`` tokens, so at most 2 * RAREST hashes travel with the tasks) are
split: (v, u) by u, (v, w) by w, and a frequent (u, v) by w; each part then gets
the whole count of its context. What is split never changes a result.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end. A
begin, which is never scored, stands twice before the first. Words are told apart by
63-bit hashes, neighbours of one word by 32 bits; a clash would add two counts.

Null and empty texts consist of the end. Repeated rows are documents of their own.
A null identifier counts as held out only if ``held_out`` says so. An empty table
gives no rows; without training documents N and V are 0. Names of other columns
don't matter, since only the identifier, the text and ``held_out`` are read.
"""

from __future__ import annotations

import math
import tempfile
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.elias_fano import EliasFano
from pricelab.llm.frames import CHUNK_BYTES, chunks, ship, whole_text, written
from pricelab.llm.words import BASE, mix, words_of

ship(__name__)

#: Bytes of text per chunk and per shard, on average.
PART_BYTES, SHARD_BYTES = 8 << 20, 8 << 20
#: Weight of the shorter context below one word and below two, as a count.
BACK = (32.0, 4.0)
#: Steps of quantised log10 probabilities.
STEPS = 20
END = np.uint64(0x5851F42D4C957F2D)
BEGIN = np.uint64(0x14057B7EF767814F)
#: Bytes of the sample that names the words and pairs to split, and the tokens of which one makes the rarest of them.
HOT_BYTES, RAREST = 32 << 20, 1 << 16
# Groups of a shard: all of a word; one (u, v) of a frequent v; a part of a frequent (u, v); a part of the successors
# of a frequent v, the first of which stands for the word.
_WORD, _PAIR, _PAIR_PART, _FIRST_PART, _PART = range(5)


def tokens_of(text: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by END, and the place of each text's first token."""
    column = text.combine_chunks() if isinstance(text, pa.ChunkedArray) else text
    parts, sizes = [], []
    for part in chunks([pa.RecordBatch.from_arrays([column], ["text"])], "text", CHUNK_BYTES):
        w = words_of(part.column("text"))
        counts = np.diff(w.bounds)
        out = np.full(len(w.hash) + len(counts), END, np.uint64)
        out[np.arange(len(w.hash)) + w.doc] = w.hash
        parts.append(out), sizes.append(counts + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def numbered(high: np.ndarray, low: np.ndarray, low_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ``high << low_bits | low`` in order, and the place of each pair among them."""
    key = high.astype(np.uint64) << np.uint64(low_bits) | low.astype(np.uint64)
    if not len(key):
        return key, np.zeros(0, np.int64)
    bits = (len(key) - 1).bit_length()
    if int(key.max()).bit_length() + bits <= 64:
        # Keys with their places behind them sort as plain numbers.
        both = np.sort(key << np.uint64(bits) | np.arange(len(key), dtype=np.uint64))
        order, key = (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)
    else:
        order = np.argsort(key)
        key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.empty(len(key), np.int64)
    at[order] = np.cumsum(new) - 1
    return key[new], at


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes, compressed; the first eight bytes are the plain size."""
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes() for a in arrays]
    plain = np.array([len(a) for a in arrays], np.uint64).tobytes() + b"".join(planes)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def unpack(data: bytes, *kinds) -> list[np.ndarray]:
    plain = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    out, at = [], 8 * len(kinds)
    for size, kind in zip(np.frombuffer(plain, np.uint64, len(kinds)).tolist(), kinds):
        wide = np.dtype(kind).itemsize
        planes = np.frombuffer(plain, np.uint8, size * wide, at).reshape(wide, size)
        out.append(np.ascontiguousarray(planes.T).view(kind).reshape(-1))
        at += size * wide
    return out


_REQUEST = (np.uint64, np.uint8, np.uint64, np.uint32, np.uint32, np.uint32, np.uint32, np.uint32)
_ANSWER = (np.int64, np.uint8, np.uint8, np.uint8, np.uint8)


def contexts(token: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words with BEGIN at the end, and each token's place among them, that of the one before, and before that."""
    word, w = np.unique(token, return_inverse=True)
    v, u = np.empty(len(token), np.int64), np.empty(len(token), np.int64)
    v[1:], u[2:] = w[:-1], w[:-2]
    starts, later = first[:-1], first[:-1] + 1
    v[starts] = u[starts] = len(word)
    u[later[later < first[1:]]] = len(word)
    return np.append(word, BEGIN), w, v, u


def pair_code(v: np.ndarray, u: np.ndarray) -> np.ndarray:
    return mix(v) * np.uint64(BASE) + u


def group_code(code: np.ndarray, salt: np.ndarray | int) -> np.ndarray:
    return mix(mix(code) + np.asarray(salt, np.uint64)) >> np.uint64(1)


def parts_of(code: np.ndarray, hot: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Parts (a power of two) of the contexts that are split, 0 for the others."""
    codes, parts = hot
    if not len(codes):
        return np.zeros(len(code), np.int64)
    at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    return np.where(codes[at] == code, parts[at], 0)


class Grams:
    """Distinct groups, (group, u), (group, w) and (group, u, w) of a chunk in shard order, and where each token finds them.

    Tokens behind a frequent word have a second entry in the part of its successors;
    ``second`` is the entry that holds the bigram. ``hot`` has the codes of split words
    and pairs in order, and their numbers of parts.
    """

    def __init__(self, token: np.ndarray, first: np.ndarray, hot: tuple[np.ndarray, np.ndarray], shards: int, train: np.ndarray | None = None):
        n = len(token)
        train = np.zeros(n, bool) if train is None else train
        word, w, v, u = contexts(token, first)
        begin = len(word) - 1
        follow = (mix(word + np.uint64(BASE)) >> np.uint64(32)).astype(np.uint32)
        word_parts = parts_of(word, hot)
        behind = np.flatnonzero(word_parts[v])
        hw, hv, after = w[behind], v[behind], follow[w[behind]].astype(np.int64)
        pairs, pair_of = numbered(hv, u[behind], 32)
        codes = pair_code(word[(pairs >> np.uint64(32)).astype(np.int64)], word[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)])
        pair_parts = parts_of(codes, hot)
        # Group 0 of a pair is the whole pair; its parts count from 1.
        split = pair_parts[pair_of]
        by_u = group_code(codes[pair_of], np.where(split > 0, 1 + (after & np.maximum(split - 1, 0)), 0))
        by_w = group_code(word[hv] ^ np.uint64(BASE), after & (word_parts[hv] - 1))
        # Every part of a split context gets the whole count of the context.
        pair_n = np.bincount(pair_of, train[behind], len(pairs)).astype(np.uint64)
        words, word_of = np.unique(hv, return_inverse=True)
        word_n = np.bincount(word_of, train[behind], len(words)).astype(np.uint64)

        def every(parts: np.ndarray) -> np.ndarray:
            return np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)

        pair_salt, word_salt = every(pair_parts), every(word_parts[words])
        all_pairs = group_code(np.repeat(codes, pair_parts), pair_salt + 1)
        all_words = group_code(np.repeat(word[words] ^ np.uint64(BASE), word_parts[words]), word_salt)
        groups, at = np.unique(np.concatenate([by_u, by_w, all_pairs, all_words]), return_inverse=True)
        kind, total = np.full(len(groups), _PAIR, np.uint8), np.zeros(len(groups), np.uint64)
        a, b, c = len(behind), 2 * len(behind), 2 * len(behind) + len(all_pairs)
        kind[at[b:c]], total[at[b:c]] = _PAIR_PART, np.repeat(pair_n, pair_parts)
        kind[at[c:]], total[at[c:]] = np.where(word_salt == 0, _FIRST_PART, _PART), np.repeat(word_n, word_parts[words])

        group = np.concatenate([v, len(word) + at[a:b]])
        group[behind] = len(word) + at[:a]
        value = np.concatenate([word >> np.uint64(1), groups])
        used = np.bincount(group, minlength=len(value)) > 0
        used[len(word):] = True
        used = np.flatnonzero(used)
        shard = ((mix(value[used]) >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        order = np.lexsort((value[used], shard))
        place = np.full(len(value), -1)
        place[used[order]] = np.arange(len(used))
        used = used[order]
        self.group, self.shard = value[used], shard[order]
        self.kind = np.concatenate([np.full(len(word), _WORD, np.uint8), kind])[used]
        self.total = np.concatenate([np.zeros(len(word), np.uint64), total])[used]
        # Where each token's own count is found: the first part of a split word; the end as often as the begin.
        own = place[:len(word)].copy()
        own[words] = place[len(word) + at[c:][word_salt == 0]]
        own[np.searchsorted(word[:-1], END)] = own[begin]
        self.word_at = own[w]

        names, rank = np.unique(np.append(follow, np.uint32(0)), return_inverse=True)
        bits = len(names).bit_length()
        low = np.uint64((1 << bits) - 1)
        self.group_at = place[group]
        # The group of a split word's pair names its u already.
        earlier = np.concatenate([rank[u], np.full(len(behind), rank[-1])])
        earlier[behind] = rank[-1]
        later = rank[np.concatenate([w, hw])]
        pair, self.pair_at = numbered(self.group_at, earlier, bits)
        three, self.three_at = numbered(self.pair_at, later, bits)
        two, self.two_at = numbered(self.group_at, later, bits)
        self.pair_group, self.before = (pair >> np.uint64(bits)).astype(np.int64), names[(pair & low).astype(np.int64)]
        self.three_pair, self.after = (three >> np.uint64(bits)).astype(np.int64), names[(three & low).astype(np.int64)]
        self.three_n = np.bincount(self.three_at, np.concatenate([train, train[behind]]), len(three)).astype(np.uint32)
        self.second = np.arange(n)
        self.second[behind] = n + np.arange(len(behind))

    def requests(self, shards: int):
        """(shard, packed request) for every shard that this chunk asks."""
        group = np.searchsorted(self.shard, np.arange(shards + 1, dtype=np.uint64))
        pair = np.searchsorted(self.pair_group, group)
        three = np.searchsorted(self.three_pair, pair)
        before_n = np.bincount(self.pair_group, minlength=len(self.group)).astype(np.uint32)
        after_n = np.bincount(self.three_pair, minlength=len(self.before)).astype(np.uint32)
        for s in range(shards):
            g, p, t = (slice(x[s], x[s + 1]) for x in (group, pair, three))
            if g.start < g.stop:
                yield s, pack(
                    self.group[g], self.kind[g], self.total[g], before_n[g], self.before[p], after_n[p], self.after[t], self.three_n[t]
                )


_ASKED = "chunk long, shard int, request binary"
_ASKED_ARROW = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("request", pa.binary())])


def _asker(hot: tuple[np.ndarray, np.ndarray], shards: int):
    def ask(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        token, first = tokens_of(table.column("text"))
        train = np.repeat(~table.column("held").to_numpy(), np.diff(first))
        asked = list(Grams(token, first, hot, shards, train).requests(shards))
        return pa.table([[chunk] * len(asked), [s for s, _ in asked], [r for _, r in asked]], schema=_ASKED_ARROW)

    return ask


def coded(p: np.ndarray) -> np.ndarray:
    """One byte per probability, rounded down; 0 is kept for entries that don't exist."""
    return (1 + np.minimum(254, np.ceil(-STEPS * np.log10(p)))).astype(np.uint8)


class Trie:
    """Words, the words before and after them, and successors of two words, in mapped files below ``folder``.

    ``before`` holds (word's place, u), ``after`` (word's place, w) and ``successors``
    (place in ``before``, place of w among the word's own in ``after``), all sorted.
    """

    def __init__(self, folder: str, words, word_back, before, before_back, after, after_code, successors, code):
        self.folder, self.n = folder, len(words)
        places = np.arange(len(words) + 1, dtype=np.uint64) << np.uint64(32)
        self.words = self._level("words", words)
        self.before, self.before_from = self._level("before", before), self._level("before-from", np.searchsorted(before, places))
        self.after, self.after_from = self._level("after", after), self._level("after-from", np.searchsorted(after, places))
        places = np.arange(len(before) + 1, dtype=np.uint64) << np.uint64(32)
        self.successors, self.successors_from = self._level("successors", successors), self._level("successors-from", np.searchsorted(successors, places))
        self.word_back, self.before_back = self._kept("word-back", word_back), self._kept("before-back", before_back)
        self.after_code, self.code = self._kept("after-code", after_code), self._kept("code", code)

    def _kept(self, name: str, values: np.ndarray) -> np.ndarray:
        np.save(f"{self.folder}/{name}.npy", values)
        return np.load(f"{self.folder}/{name}.npy", mmap_mode="r")

    def _level(self, name: str, values: np.ndarray) -> EliasFano:
        level = EliasFano.build(values)
        for part, kept in level.arrays().items():
            setattr(level, part, self._kept(f"{name}-{part}", kept))
        return level

    def word(self, value: np.ndarray) -> np.ndarray:
        """Place of each word, -1 where it was never seen."""
        if not self.n:
            return np.full(len(value), -1)
        place = self.words.rank_of(value)
        known = place < self.n
        known[known] = self.words.access(place[known]) == value[known]
        return np.where(known, place, -1)

    def below(self, level: EliasFano, pointers: EliasFano, context: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of ``value`` in its context's range of the level, -1 where it is not there, and the range's start."""
        out, start = np.full(len(context), -1), np.zeros(len(context), np.int64)
        ask = np.flatnonzero((context >= 0) & (value >= 0))
        if not len(ask) or not level.size:
            return out, start
        at = context[ask]
        first, end = pointers.access(at).astype(np.int64), pointers.access(at + 1).astype(np.int64)
        key = at.astype(np.uint64) << np.uint64(32) | value[ask].astype(np.uint64)
        place = level.rank_of(key, first, end)
        inside = place < end
        inside[inside] = level.access(place[inside]) == key[inside]
        out[ask[inside]], start[ask] = place[inside], first
        return out, start


def _taken(codes: np.ndarray, place: np.ndarray, missing: int) -> np.ndarray:
    out = np.full(len(place), missing, np.uint8)
    out[place >= 0] = codes[place[place >= 0]]
    return out


_ANSWERED = "chunk long, shard int, answer binary, n long, v long"
_ANSWERED_ARROW = pa.schema([("chunk", pa.int64()), ("shard", pa.int32()), ("answer", pa.binary()), ("n", pa.int64()), ("v", pa.int64())])


def looked_up(asked: list[list[np.ndarray]]) -> SimpleNamespace:
    """Counts of a shard's words and the codes of all its distinct requests, with the places of the requests among them."""
    group, kind, given, before_n, before, after_n, after, three_n = (np.concatenate(x) for x in zip(*asked))
    words, group_at = np.unique(group, return_inverse=True)
    kinds = np.zeros(len(words), np.uint8)
    kinds[group_at] = kind
    given = np.bincount(group_at, given, len(words)).astype(np.int64)
    pair, pair_at = numbered(np.repeat(group_at, before_n), before, 32)
    three, three_at = numbered(np.repeat(pair_at, after_n), after, 32)
    n3 = np.bincount(three_at, three_n, len(three)).astype(np.int64)
    del group, before, after, three_n
    pair_group, three_pair = (pair >> np.uint64(32)).astype(np.int64), (three >> np.uint64(32)).astype(np.int64)
    three_after = three & np.uint64(0xFFFFFFFF)
    two, two_of = numbered(pair_group[three_pair], three_after, 32)
    two_group = (two >> np.uint64(32)).astype(np.int64)
    n2 = np.bincount(two_of, n3, len(two)).astype(np.int64)
    pair_n = np.bincount(three_pair, n3, len(pair)).astype(np.int64)
    word_n = np.where(kinds >= _PAIR_PART, given, np.bincount(pair_group, pair_n, len(words)).astype(np.int64))
    pair_n = np.where(kinds[pair_group] == _PAIR_PART, given[pair_group], pair_n)

    # The trie holds what training documents hold.
    keep_word, keep_pair, keep_two, keep_three = word_n > 0, pair_n > 0, n2 > 0, n3 > 0
    word_place, pair_place = np.cumsum(keep_word) - 1, np.cumsum(keep_pair) - 1
    two_place, low = np.cumsum(keep_two) - 1, np.uint64(0xFFFFFFFF)

    def below(places: np.ndarray, value: np.ndarray) -> np.ndarray:
        return places.astype(np.uint64) << np.uint64(32) | value

    kept_two = below(word_place[two_group[keep_two]], two[keep_two] & low)
    two_from = np.searchsorted(kept_two, np.arange(int(keep_word.sum()) + 1, dtype=np.uint64) << np.uint64(32))
    relative = two_place[two_of[keep_three]] - two_from[word_place[pair_group[three_pair[keep_three]]]]
    with tempfile.TemporaryDirectory(prefix="trie-") as folder:
        trie = Trie(
            folder, words[keep_word], coded(BACK[0] / (word_n[keep_word] + BACK[0])),
            below(word_place[pair_group[keep_pair]], pair[keep_pair] & low), coded(BACK[1] / (pair_n[keep_pair] + BACK[1])),
            kept_two, coded(n2[keep_two] / (word_n[two_group[keep_two]] + BACK[0])),
            below(pair_place[three_pair[keep_three]], relative.astype(np.uint64)),
            coded(n3[keep_three] / (pair_n[three_pair[keep_three]] + BACK[1])),
        )
        word_at = trie.word(words)
        pair_found, _ = trie.below(trie.before, trie.before_from, word_at[pair_group], (pair & low).astype(np.int64))
        two_found, start = trie.below(trie.after, trie.after_from, word_at[two_group], (two & low).astype(np.int64))
        place = np.where(two_found >= 0, two_found - start, -1)
        found, _ = trie.below(trie.successors, trie.successors_from, pair_found[three_pair], place[two_of])
        word_back, pair_back = _taken(trie.word_back, word_at, 1), _taken(trie.before_back, pair_found, 1)
        two_code, code = _taken(trie.after_code, two_found, 0), _taken(trie.code, found, 0)
    return SimpleNamespace(
        kinds=kinds, group_at=group_at, pair_at=pair_at, three_at=three_at, two_of=two_of, three_pair=three_pair, two_group=two_group,
        word_n=word_n, word_back=word_back, pair_back=pair_back, two_code=two_code, code=code,
    )


def _answer(table: pa.Table) -> pa.Table:
    """Answers to one shard's requests, and a row of totals under a chunk of its own."""
    chunk, shard = table.column("chunk").to_pylist(), table.column("shard")[0].as_py()
    asked = [unpack(r.as_py(), *_REQUEST) for r in table.column("request")]
    sizes = np.array([[len(r[0]), len(r[4]), len(r[6])] for r in asked])
    found = looked_up(asked)
    del asked
    counted = (found.kinds == _WORD) | (found.kinds == _FIRST_PART)
    out = [(-1 - shard, shard, None, int(found.word_n[counted].sum()), int((found.word_n[counted] > 0).sum()))]
    # Only what was never seen behind two words backs off: other weights and bigrams are not read and travel as one value.
    unseen = found.code == 0
    pair_back = np.where(np.bincount(found.three_pair[unseen], minlength=len(found.pair_back)) > 0, found.pair_back, np.uint8(1))
    backed = np.bincount(found.two_of[unseen], minlength=len(found.two_code)) > 0
    two_code = np.where(backed | (found.kinds[found.two_group] >= _FIRST_PART), found.two_code, np.uint8(0))
    ends = np.cumsum(sizes, axis=0)
    for c, (g, p, t), (ge, pe, te) in zip(chunk, sizes.tolist(), ends.tolist()):
        g, p, t = found.group_at[ge - g:ge], found.pair_at[pe - p:pe], found.three_at[te - t:te]
        two = np.unique(found.two_of[t])
        out.append((c, shard, pack(found.word_n[g], found.word_back[g], pair_back[p], two_code[two], found.code[t]), 0, 0))
    return pa.table([list(x) for x in zip(*out)], schema=_ANSWERED_ARROW)


_SCORED = "id long, held boolean, n_tokens long, n_known long, logs double, score double, backs long, n long, v long"


def _scorer(hot: tuple[np.ndarray, np.ndarray], shards: int):
    schema = pa.schema([(n, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[t]) for n, t in (x.split(" ") for x in _SCORED.split(", "))])

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if docs.num_rows == 0:
            n = answers.num_rows
            empty = {c: [None] * n for c in schema.names}
            return pa.table({**empty, "n": answers.column("n"), "v": answers.column("v")}, schema)
        token, first = tokens_of(docs.column("text"))
        g = Grams(token, first, hot, shards)
        got = zip(*[unpack(a.as_py(), *_ANSWER) for a in answers.sort_by("shard").column("answer")])
        count, word_back, pair_back, two, three = (np.concatenate(x) for x in got)
        n = len(token)
        c = count[g.word_at]
        log_c = np.log10(c + 1.0)
        three, two = three[g.three_at[:n]], two[g.two_at[g.second]]
        word_back, pair_back = word_back[g.group_at[g.second]], pair_back[g.pair_at[:n]]
        backs = (three == 0) & (two == 0)
        steps = np.where(three > 0, three, pair_back - 1.0 + np.where(two > 0, two, word_back)) - 1.0
        logs = np.where(backs, log_c, 0.0) - steps / STEPS
        at = first[:-1]
        return pa.table(
            {
                "id": docs.column("id"), "held": docs.column("held"), "n_tokens": np.diff(first),
                "n_known": np.add.reduceat((c > 0).astype(np.int64), at), "logs": np.add.reduceat(log_c, at),
                "score": np.add.reduceat(logs, at), "backs": np.add.reduceat(backs.astype(np.int64), at),
                "n": pa.nulls(len(at), pa.int64()), "v": pa.nulls(len(at), pa.int64()),
            },
            schema,
        )

    return score


def _counter(share: float):
    def count(batches):
        for part in chunks(batches, "text"):
            word, w, v, u = contexts(*tokens_of(part.column("text")))
            one, pair = np.bincount(v, minlength=len(word)), numbered(v, u, 32)
            two = np.bincount(pair[1], minlength=len(pair[0]))
            codes = pair_code(word[(pair[0] >> np.uint64(32)).astype(np.int64)], word[(pair[0] & np.uint64(0xFFFFFFFF)).astype(np.int64)])
            for code, n in ((word, one), (codes, two)):
                often = n > share / 2 * len(w)
                yield pa.RecordBatch.from_arrays([pa.array(code[often].view(np.int64)), pa.array(n[often])], ["code", "n"])
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([len(w)])], ["code", "n"])

    return count


def hot_contexts(rows: DataFrame, size: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of frequent words and pairs of a sample, in order, and how many parts each is split into.

    They decide where counts are added up, and no result.
    """
    share = max(1 / (2 * shards), 1 / RAREST)
    sample = rows.select("text").sample(min(1.0, HOT_BYTES / max(size, 1)), seed=6)
    counted = sample.mapInArrow(_counter(share), "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    found = {r["code"]: r["n"] for r in counted.orderBy(F.desc("n")).limit(2 * RAREST).collect()}
    total = found.pop(None, 0)
    often = {c: 1 << math.ceil(math.log2(max(1, 2 * shards * n / total))) for c, n in found.items() if n > share * total}
    codes = np.array(list(often), np.int64).view(np.uint64)
    order = np.argsort(codes)
    return codes[order], np.array(list(often.values()), np.int64)[order]


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score and score.

    The model learns from the documents for which ``held_out`` is false.
    """
    ident, text = F.col(id_col).cast("long"), whole_text(text_col)
    size = docs.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    parts, shards = max(1, math.ceil(size / PART_BYTES)), max(1, math.ceil(size / SHARD_BYTES))
    rows = docs.select(
        F.pmod(F.xxhash64(ident, text), F.lit(parts)).alias("chunk"), ident.alias("id"),
        F.coalesce(held_out, F.lit(False)).alias("held"), text.alias("text"),
    )
    hot = hot_contexts(rows, size, shards)
    rows = rows.repartition(parts, "chunk")
    asked = rows.groupBy("chunk").applyInArrow(_asker(hot, shards), _ASKED)
    answers = asked.groupBy("shard").applyInArrow(_answer, _ANSWERED)
    scored = written(rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scorer(hot, shards), _SCORED), "scores")
    total = scored.where("n_tokens IS NULL").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    n, v = total["n"] or 0, total["v"] or 0
    back = F.lit(math.log10(n + v + 1))
    return scored.where("n_tokens IS NOT NULL").select(
        F.col("id").alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * back).alias("base_score"), (F.col("score") - F.col("backs") * back).alias("score"),
    )
