"""Toxicity scores over text restored by a noisy channel.

A character language model (trigrams over byte classes) is counted on all
documents. Spans that look disguised -- a sign or digit among letters, a letter
three times or more in a row, single letters strung on separators -- become
character lattices: a sign may stand for the letters it resembles, a repeated
letter and a separator may be dropped, and every character may stay as it is.
Viterbi decoding takes the likeliest path under channel and language model. A
span without any of these has one path, itself, and is left alone. Restored words
join the words of the text.

Features are the words (runs of letters) and their beginnings, so that endings
put on a stem don't hide it. The most telling ones of a bounded sample of labelled
rows enter a logistic regression fitted by Spark; each counts once per text.

Null and empty texts have no features and get the score of the intercept. Texts of
any length are scored whole, repeated rows alike. Labels that disagree for one
identifier count as toxic; labels without a document are ignored. Without labels
of both kinds every score is the share of toxic labels. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import chunks, ship, whole_text, written
from pricelab.llm.words import letters_in, lower_bytes, mix, span_hashes, text_bytes, words_of

ship(__name__)

#: Labelled rows that the classifier is fitted on, at most (drawn by a hash of the identifier).
SAMPLE_ROWS = 16_000
#: Features of the classifier.
FEATURES = 512
#: Lengths in bytes of the beginnings that count besides the whole word.
PREFIXES = (4, 5, 6, 7)
#: Letters that a sign or digit may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il",
    "+": "t", "*": "aeiou",
}
SIGNS = "".join(LOOKS_LIKE)
_LETTER = r"[^\W\d_]"
_SIGN = "[" + re.escape(SIGNS) + "]"
#: Signs among letters or one before them; letters tripled; single characters on separators.
SPANS = re.compile(
    rf"(?<!\w){_SIGN}?{_LETTER}+(?:{_SIGN}+{_LETTER}+)+{_SIGN}*|(?<!\S){_SIGN}{_LETTER}{{2,}}"
    rf"|{_LETTER}*({_LETTER})\1\1{_LETTER}*|(?<!\w)(?:\w[ .\-_]){{3,}}\w(?!\w)"
)
CLASSES = 28
#: Log costs of the channel: a sign read as a letter, a sign kept, a repeat dropped, a separator dropped or kept.
READ, KEEP, DROP, JOIN, PART = math.log(0.6), math.log(0.02), math.log(0.5), math.log(0.7), math.log(0.05)
MEMO = 50_000


def classes(raw: np.ndarray) -> np.ndarray:
    """0 for anything but letters, 1 to 26 for a to z, 27 for bytes of other characters."""
    out = np.zeros(256, np.int64)
    out[97:123] = np.arange(1, 27)
    out[128:] = 27
    return out[raw]


def _count_trigrams(batches):
    total = np.zeros(CLASSES**3, np.int64)
    for part in chunks(batches, "text"):
        kind = classes(lower_bytes(text_bytes(part.column("text"))[0]))
        if len(kind) > 2:
            total += np.bincount((kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:], minlength=CLASSES**3)
    place = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(total[place])], ["gram", "n"])


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities [a, b, c] of class c after a and b, over all documents; CLASSES ** 3 numbers at most."""
    text = docs.select(whole_text(text_col).alias("text"))
    counts = np.ones(CLASSES**3)
    for row in text.mapInArrow(_count_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] += row["n"]
    counts = counts.reshape(CLASSES, CLASSES, CLASSES)
    return np.log(counts / counts.sum(2, keepdims=True))


def _class_of(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27 if c > "\x7f" else 0


def lattice(span: str) -> list[list[tuple[str, float]]]:
    """Per character its readings and their log costs; "" drops it."""
    strung = len(span) > 2 and all((c in " .-_") == (i % 2 == 1) for i, c in enumerate(span))
    out = []
    for i, c in enumerate(span):
        if strung and i % 2:
            out.append([("", JOIN), (c, PART)])
        elif c in LOOKS_LIKE:
            letters = LOOKS_LIKE[c]
            out.append([(x, READ - math.log(len(letters))) for x in letters] + [(c, KEEP)])
        elif not strung and i and span[i - 1] == c:
            out.append([(c, 0.0), ("", DROP)])
        else:
            out.append([(c, 0.0)])
    return out


def decode(span: str, model: list) -> str:
    """The likeliest reading of a span between two breaks, by Viterbi over (last two classes)."""
    best = {(0, 0): (0.0, None)}
    for readings in lattice(span):
        after = {}
        for (a, b), (value, path) in best.items():
            row = model[a][b]
            for c, cost in readings:
                if c:
                    kind = _class_of(c)
                    key, total, way = (b, kind), value + cost + row[kind], (path, c)
                else:
                    key, total, way = (a, b), value + cost, path
                if key not in after or total > after[key][0]:
                    after[key] = (total, way)
        best = after
    path = max(((value + model[a][b][0], way) for (a, b), (value, way) in best.items()), key=lambda x: x[0])[1]
    out = []
    while path is not None:
        path, c = path
        out.append(c)
    return "".join(reversed(out))


def disguised(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text may hold a span: a superset of the pattern's texts, by bytes."""
    if len(raw) < 3:
        return np.zeros(len(offsets) - 1, bool)
    letter = letters_in(raw)
    sign = np.zeros(256, bool)
    sign[np.frombuffer(SIGNS.encode(), np.uint8)] = True
    odd = np.zeros(len(raw), bool)
    odd[:-1] |= sign[raw[:-1]] & letter[1:]
    odd[2:] |= letter[2:] & (raw[2:] == raw[1:-1]) & (raw[1:-1] == raw[:-2])
    # Two-byte letters tripled: the lead byte returns at a distance of two.
    odd[4:] |= (raw[4:] >= 128) & (raw[4:] == raw[2:-2]) & (raw[2:-2] == raw[:-4])
    inner = np.zeros(256, bool)
    inner[[32, 46, 45, 95]] = True
    gap = inner[raw]
    odd[2:] |= gap[2:] & gap[:-2] & ~gap[1:-1]
    odd[3:] |= gap[3:] & gap[:-3] & (raw[1:-2] >= 128) & (raw[2:-1] >= 128)
    seen = np.concatenate([[0], np.cumsum(odd)])
    return seen[offsets[1:]] > seen[offsets[:-1]]


def restored(text: str, model: list, memo: dict) -> str:
    """The restored words of all disguised spans, separated by blanks."""
    out = []
    for found in SPANS.finditer(text.lower()):
        span = found.group()
        word = memo.get(span)
        if word is None:
            word = decode(span, model)
            if len(memo) < MEMO and len(span) <= 64:
                memo[span] = word
        if word != span:
            out.append(word)
    return " ".join(out)


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature hash) of every word and beginning."""
    w = words_of(column, letters=True)
    hashes, size = span_hashes(w.raw), w.end - w.start
    docs, found = [w.doc], [w.hash]
    for k in PREFIXES:
        long = size > k
        start = w.start[long]
        docs.append(w.doc[long]), found.append(mix(hashes(start, start + k) + np.uint64(k)))
    return np.concatenate(docs), np.concatenate(found)


def doc_features(column: pa.Array, model: list, memo: dict, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, feature) of texts and their restored words; only ``wanted`` (sorted) if given, as places in it."""
    raw, offsets = text_bytes(column)
    docs, found = _features(column)
    odd = np.flatnonzero(disguised(lower_bytes(raw), offsets))
    if len(odd):
        extra = pa.array([restored(t, model, memo) for t in column.take(pa.array(odd)).to_pylist()], pa.string())
        more_docs, more = _features(extra)
        docs, found = np.concatenate([docs, odd[more_docs]]), np.concatenate([found, more])
    if wanted is not None:
        mask = np.zeros(1 << 16, bool)
        mask[(wanted & np.uint64(0xFFFF)).astype(np.int64)] = True
        some = np.flatnonzero(mask[(found & np.uint64(0xFFFF)).astype(np.int64)])
        docs, found = docs[some], found[some]
        place = np.minimum(np.searchsorted(wanted, found), len(wanted) - 1)
        hit = wanted[place] == found
        key = np.unique(docs[hit] * len(wanted) + place[hit])
        return key // len(wanted), key % len(wanted)
    order = np.lexsort((found, docs))
    docs, found = docs[order], found[order]
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (found[1:] != found[:-1])
    return docs[new], found[new]


def _counter(model: np.ndarray):
    def run(batches):
        table, memo = model.tolist(), {}
        for part in chunks(batches, "text", 8 << 20):
            toxic = part.column("toxic").to_numpy().astype(bool)
            docs, found = doc_features(part.column("text"), table, memo)
            kinds, at = np.unique(found, return_inverse=True)
            hits = np.bincount(at, toxic[docs], len(kinds)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds.view(np.int64)), pa.array(np.bincount(at, minlength=len(kinds))), pa.array(hits)], ["feature", "n", "hits"]
            )

    return run


def _vectors(model: np.ndarray, wanted: np.ndarray):
    def run(batches):
        table, memo = model.tolist(), {}
        for part in chunks(batches, "text"):
            docs, place = doc_features(part.column("text"), table, memo, wanted)
            dense = np.zeros((part.num_rows, len(wanted)))
            dense[docs, place] = 1.0
            yield pa.RecordBatch.from_arrays(
                [part.column("toxic"), pa.array(list(dense), pa.list_(pa.float64()))], ["toxic", "values"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        rows: int = SAMPLE_ROWS) -> dict:
    """Character model, features, weights and intercept. ``learn`` picks the documents whose labels may be used."""
    model = character_model(docs, text_col)
    known = labels.where(F.col(id_col).isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    texts = docs.where(learn).select(F.col(id_col).alias("__id"), whole_text(text_col).alias("text"))
    total = known.count()
    share = min(1.0, rows / total) if total else 1.0
    picked = F.pmod(F.xxhash64("__id", F.lit(29)), F.lit(1 << 20)) < F.lit(share * (1 << 20))
    sample = written(texts.where(picked).join(known.where(picked), "__id").select("text", "toxic").repartition(12), "labelled")
    size = sample.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("hits")).first()
    n, hits = size["n"], size["hits"] or 0
    empty = {"model": model, "wanted": np.zeros(1, np.uint64), "weights": np.zeros(1)}
    if not 0 < hits < n:
        return {**empty, "intercept": math.log((hits + 0.5) / (n - hits + 0.5))}
    counted = sample.mapInArrow(_counter(model), "feature long, n long, hits long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("hits").alias("hits")
    )
    # Log-likelihood ratio of the feature's share of toxic texts against the sample's.
    rate = hits / n
    gain = F.expr(f"hits * ln(hits / n / {rate}) + (CASE WHEN n > hits THEN (n - hits) * ln((n - hits) / n / {1 - rate}) ELSE 0 END)")
    best = counted.where(f"hits >= 3 AND hits > {rate} * n").orderBy(gain.desc(), "feature").limit(FEATURES).collect()
    if not best:
        return {**empty, "intercept": math.log(hits / (n - hits))}
    wanted = np.sort(np.array([r["feature"] for r in best], np.int64).view(np.uint64))
    vectors = sample.mapInArrow(_vectors(model, wanted), "toxic int, values array<double>")
    data = written(vectors, "vectors").select(F.col("toxic").cast("double").alias("label"), array_to_vector("values").alias("features"))
    got = LogisticRegression(regParam=0.002, maxIter=60, standardization=False).fit(data)
    return {"model": model, "wanted": wanted, "weights": got.coefficients.toArray(), "intercept": float(got.intercept)}


def score(docs: DataFrame, fitted: dict, keep: list[Column], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``score`` of every document."""
    model, wanted, weights, intercept = fitted["model"], fitted["wanted"], fitted["weights"], fitted["intercept"]
    rows = docs.select(*keep, whole_text(text_col).alias("__text"))
    names = [c for c in rows.columns if c != "__text"]

    def run(batches):
        table, memo = model.tolist(), {}
        for part in chunks(batches, "__text"):
            at, place = doc_features(part.column("__text"), table, memo, wanted)
            total = intercept + np.bincount(at, weights[place], part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in names] + [pa.array(1 / (1 + np.exp(-np.clip(total, -500, 500))))], [*names, "score"]
            )

    return rows.mapInArrow(run, rows.drop("__text").withColumn("score", F.lit(0.0)).schema)
