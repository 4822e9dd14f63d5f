"""Repeated passages of lines, found at every line.

A passage is two lines with words or more, or one line of ``LONG_WORDS`` words or
more; blank lines between its lines belong to it, those around it don't. Every two
neighbouring lines with words and every long line are looked up in the whole corpus
by hash and size; the ones found more than once are cut from the texts and compared
byte by byte (rows are grouped by the bytes). A longer passage is found through its
pairs, so its ends need no border of their own. A pair stays at its first place, by
smallest identifier, row hash and offset, and goes everywhere else, within one text
too unless it shares a line with its first place. Pairs that overlap may have
different first places: each line of a removed passage stays somewhere, but not
always beside the same neighbour.

Null and empty texts have no lines. Text without a repeated passage comes back
unchanged. Repeated rows (same identifier and text) are the same place and treated
alike; null identifiers come after all others. An empty table gives no rows. Names
of other columns don't matter, since only the identifier and the text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import chunks, ship, whole_text, written
from pricelab.llm.words import span_hashes, text_bytes

ship(__name__)

#: Words that make a single line a passage.
LONG_WORDS = 50


def line_pairs(raw: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Text, start, end and hash of every two neighbouring worded lines and every long line; places in ``raw``."""
    n = len(raw)
    breaks = raw == 10
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = np.unique(np.concatenate([offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(breaks) + 1]))
    starts = starts[starts < n]
    if not len(starts):
        return [np.zeros(0, np.int64)] * 4
    doc = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.append(starts[1:], n)
    bare = ends - (breaks[ends - 1])
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    opens = ~blank & (first[:n] | np.concatenate([[True], blank[:-1]]))
    upto = np.concatenate([[0], np.cumsum(opens)])
    words = upto[ends] - upto[starts]
    worded = np.flatnonzero(words > 0)
    a, b = worded[:-1], worded[1:]
    both = doc[a] == doc[b]
    long = np.flatnonzero(words >= LONG_WORDS)
    a, b = np.concatenate([a[both], long]), np.concatenate([b[both], long])
    return [doc[a], starts[a], bare[b], span_hashes(raw)(starts[a], bare[b])]


_PAIR = "id long, row1 long, row2 long, start int, size int, hash long"


def _find(batches):
    for part in chunks(batches, "text"):
        raw, offsets = text_bytes(part.column("text"))
        doc, start, end, hashes = line_pairs(raw, offsets)
        at = pa.array(doc)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id").take(at), part.column("row1").take(at), part.column("row2").take(at),
                pa.array((start - offsets[doc]).astype(np.int32)), pa.array((end - start).astype(np.int32)),
                pa.array(hashes.astype(np.uint64).view(np.int64)),
            ],
            ["id", "row1", "row2", "start", "size", "hash"],
        )


def _bytes(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            part = batch.slice(k, 1)
            raw = part.column("text")[0].as_buffer().to_pybytes()
            spans = part.column("spans")[0].as_py()
            for i in range(0, len(spans), 1024):
                some = spans[i:i + 1024]
                same = pa.array(np.zeros(len(some), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(same), part.column("row1").take(same), part.column("row2").take(same),
                        pa.array([s["start"] for s in some], pa.int32()), pa.array([s["size"] for s in some], pa.int32()),
                        pa.array([raw[s["start"]:s["start"] + s["size"]] for s in some], pa.binary()),
                    ],
                    ["id", "row1", "row2", "start", "size", "bytes"],
                )


def _cut(batches):
    for part in batches:
        texts, lines, gone = [], [], []
        for text, spans in zip(part.column("text"), part.column("spans").to_pylist()):
            raw = text.as_buffer().to_pybytes() if text.is_valid else b""
            # Pairs of one passage overlap: cut their union.
            runs = []
            for start, size in sorted((s["start"], s["size"]) for s in spans or ()):
                if runs and start <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], start + size)
                else:
                    runs.append([start, start + size])
            kept, at = [], 0
            lost = 0
            for start, end in runs:
                kept.append(raw[at:start])
                lost += raw.count(b"\n", start, end) + 1
                at = end + (raw[end:end + 1] == b"\n")
            texts.append(b"".join([*kept, raw[at:]]).decode())
            lines.append(raw.count(b"\n") + 1 if raw else 0), gone.append(lost)
        yield pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(gone, pa.int64())],
            ["id", "text", "n_lines", "n_removed_lines"],
        )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, the text without repeated passages, n_lines and n_removed_lines."""
    ident, text = F.col(id_col).cast("long"), whole_text(text_col)
    rows = docs.select(
        ident.alias("id"), F.xxhash64(ident, text).alias("row1"), F.xxhash64(F.lit("row"), text, ident).alias("row2"), text.alias("text")
    )
    found = written(rows.mapInArrow(_find, _PAIR), "line-pairs")
    often = found.groupBy("hash", "size").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hash", "size")
    candidates = found.join(often, ["hash", "size"], "left_semi").groupBy("row1", "row2").agg(
        F.collect_set(F.struct("start", "size")).alias("spans")
    )
    # The bytes of candidates: a text meets all its candidates once.
    bytes_ = rows.join(candidates, ["row1", "row2"]).select("id", "row1", "row2", "text", "spans").mapInArrow(
        _bytes, "id long, row1 long, row2 long, start int, size int, bytes binary"
    )
    placed = written(bytes_, "passages")
    place = F.struct(F.col("id").isNull().alias("unknown"), "id", "row1", "row2", "start")
    first = placed.groupBy("bytes").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    kinds = first.select(F.sha2("bytes", 256).alias("sha"), "first")
    # A pair of equal lines may overlap its own first place, which is no second copy.
    gone = placed.select(F.sha2("bytes", 256).alias("sha"), "row1", "row2", "start", "size", place.alias("place")).join(kinds, "sha").where(
        "place <> first AND NOT (row1 = first.row1 AND row2 = first.row2 AND place.id <=> first.id AND start < first.start + size)"
    )
    spans = gone.groupBy("row1", "row2").agg(F.collect_set(F.struct("start", "size")).alias("spans"))
    return rows.join(spans, ["row1", "row2"], "left").select("id", "text", "spans").mapInArrow(
        _cut, "id long, text string, n_lines long, n_removed_lines long"
    ).withColumnRenamed("id", id_col).withColumnRenamed("text", text_col)
