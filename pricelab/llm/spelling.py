"""Words that are one edit apart, by PartEnum signatures, and the form each is a variant of.

One inserted, deleted or replaced character changes at most two entries of a word's
letter multiset, seen as a binary vector over (letter, occurrence). PartEnum deals
these dimensions to four groups and signs each of the six pairs of groups: two words
whose vectors differ in two places at most agree in a whole pair of groups, so they
share a signature. The edit also leaves one half of the word alone. Each signature is
therefore made per half that stays (and per length of the shorter word), over the
letters of the other half, which keeps the words of one signature few without losing
a pair. An equi-join on the signatures gives the candidates; the edit distance itself
decides.

A word has at most about 90 * (2 * length + 1) words one edit away, so the verified
pairs grow with the words and not with their square, and are counted per word as rows.

Null texts have no words, a null ``doc_id`` is the empty string in the damage key.
Every text is read whole. Repeated rows count as often as they occur; an empty table
gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import chunks, ship, whole_text, written

ship(__name__)

#: Distinct words whose counts a task holds before it passes them on.
HELD_WORDS = 400_000
#: Groups of dimensions, and how many of them a signature covers: all but the two that an edit may touch.
GROUPS, SIGNED = 4, 2
_PAIRS = tuple(combinations(range(GROUPS), SIGNED))
_KEPT_BITS = (1 << 63) - 1
#: Words of one Arrow batch of signatures.
BATCH_WORDS = 2_000


def damaged_run(doc_id: str, run: str, one_in: int) -> str:
    """The run, less one character when ``one_in`` divides the checksum of document and run."""
    return _less_one(run, zlib.crc32(f"{doc_id}:{run}".encode()), one_in)


def _less_one(run: str, h: int, one_in: int) -> str:
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def run_finder(least_chars: int):
    """A function of UTF-8 bytes to their lower-cased runs and how often each occurs.

    A deletion only shortens, so runs of fewer than ``least_chars`` characters give no
    words and are not told apart. Bytes are lower-cased as ASCII, which leaves others alone.
    """
    find = re.compile(f"[a-zÀ-ÿ]{{{max(1, least_chars)},}}").findall
    return lambda raw: Counter(find(raw.lower().decode()))


def word_counts(docs: DataFrame, one_in: int = 97, least_chars: int = 5, least_count: int = 3) -> DataFrame:
    """``word`` and its count ``n`` over all documents (doc_id, text), after the dealt deletions."""

    def run(batches):
        runs_of = run_finder(least_chars)
        held: Counter[str] = Counter()

        def flush():
            words = pa.array(list(held), pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for part in chunks(batches, "text"):
            for doc, text in zip(part.column("doc").to_pylist(), part.column("text")):
                # The checksum goes on from that of the document, which all its runs have in common.
                seed = zlib.crc32(f"{doc}:".encode())
                for found, n in runs_of(text.as_buffer().to_pybytes()).items():
                    word = _less_one(found, zlib.crc32(found.encode(), seed), one_in)
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) >= HELD_WORDS:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"), whole_text().alias("text"))
    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


@functools.cache
def _group(letter: str, occurrence: int) -> int:
    """The group of a dimension, from the low bits of a multiplicative hash."""
    return ((ord(letter) * 31 + occurrence) * 0x9E3779B1 >> 13) % GROUPS


def _grouped(letters: str) -> list[str]:
    """The letters of each group in order, each occurrence by its own dimension."""
    groups, last, occurrence = [""] * GROUPS, "", 0
    for letter in sorted(letters):
        occurrence = occurrence + 1 if letter == last else 0
        last = letter
        groups[_group(letter, occurrence)] += letter
    return groups


def _hash(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little")


@functools.lru_cache(maxsize=50_000)
def _group_hash(group: int, letters: str) -> int:
    return _hash(f"{group}\n{letters}")


def signatures(word: str, least_chars: int = 5) -> set[int]:
    """63-bit PartEnum signatures, each a sum of the hashes of its parts; two words that are one edit apart share at least one."""
    out = set()
    for shorter in (len(word), len(word) - 1):
        if shorter < least_chars:
            continue
        half = shorter // 2
        for side, kept, rest in (
            ("<", word[:half], word[half:]),
            (">", word[half - shorter:], word[:len(word) - (shorter - half)]),
        ):
            begin = _hash(f"{shorter}{side}{kept}")
            signed = [_group_hash(i, letters) for i, letters in enumerate(_grouped(rest))]
            for chosen in _PAIRS:
                out.add(sum([signed[i] for i in chosen], begin) & _KEPT_BITS)
    return out


def near_words(words: DataFrame, least_chars: int = 5) -> DataFrame:
    """Each pair of ``words`` (word, n) that are one edit apart, once: word, n, other, other_n, with word < other."""

    def run(batches):
        for batch in batches:
            for begin in range(0, batch.num_rows, BATCH_WORDS):
                part = batch.slice(begin, BATCH_WORDS)
                signed = [sorted(signatures(w, least_chars)) for w in part.column("word").to_pylist()]
                at = pa.array([i for i, s in enumerate(signed) for _ in s], pa.int64())
                flat = pa.array([x for s in signed for x in s], pa.int64())
                yield pa.RecordBatch.from_arrays([flat, part.column("word").take(at), part.column("n").take(at)], ["sig", "word", "n"])

    signed = written(words.select("word", "n").mapInArrow(run, "sig long, word string, n long"), "signatures")
    other = signed.select("sig", F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = signed.join(other, "sig").where("word < other AND levenshtein(word, other, 1) = 1")
    return pairs.select("word", "n", "other", "other_n").distinct()


def variants(words: DataFrame, pairs: DataFrame, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n; the form is the most frequent near word with ``ratio`` times the count at least."""
    both = pairs.unionAll(pairs.select("other", "other_n", "word", "n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form"))).alias("best"))
    near = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "best.form", (-F.col("best.less")).alias("form_n"))
    fits = F.col("form_n") >= ratio * F.col("n")
    formed = written(near.select("word", "n", "n_near", F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n")), "forms")
    roots = _roots(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    out = formed.join(roots, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """Ends of the chains ``word -> root``. Counts at least double along a chain, so a few doubling jumps end it."""
    while True:
        ahead = steps.select(F.col("word").alias("at"), F.col("root").alias("next"))
        jumped = steps.join(ahead, steps["root"] == ahead["at"], "left")
        jumped = written(jumped.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        steps = jumped.select("word", "root")
        if not jumped.where("moved").limit(1).count():
            return steps


def spelling_variants(docs: DataFrame, one_in: int = 97, least_chars: int = 5, least_count: int = 3) -> DataFrame:
    """Variants among the words of ``docs`` (doc_id, text)."""
    words = written(word_counts(docs, one_in, least_chars, least_count), "words")
    return variants(words, near_words(words, least_chars))
