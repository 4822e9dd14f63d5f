"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Every document gets the base counts. The other rules form one ``CASE`` chain: a
document that one rule rejects never reaches the next. A bounded sample of rows
tells each rule's rejection share and its cost (seconds that the rule takes on
the written sample), and the chain runs by falling rejection per cost. The order
changes the work, never the verdict, since a document is kept only if no rule
rejects it.

Null and empty texts have no words: all counts are 0 and the base rule rejects
them. Texts of any length are read whole. Rows stay as they are, ties and copies
included; an empty table gives no rows (the chain then keeps its written order).
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelab.llm.frames import whole_text, written

#: White space that ends a word.
BLANK = r"[\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window whose repetition counts.
WINDOW = 5
#: Rows of the sample that orders the rules.
SAMPLE_ROWS = 2_000


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANK), lambda w: w != "")


def chars_in(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: F.length(F.translate(line, BLANKS, "")) > 0)
    return F.size(lines) - F.size(F.array_distinct(lines))


def repeated_words(text_words: str) -> Column:
    """SQL of the count over the column of words named ``text_words``.

    Hashes of all windows come first; only a text in which two agree sorts its
    windows (as strings, so a chance agreement adds nothing), takes the places
    of those equal to a neighbour and adds up the words they cover.
    """
    k = WINDOW
    starts = f"sequence(1, size({text_words}) - {k - 1})"
    sorted_windows = f"array_sort(transform({starts}, i -> struct(concat_ws(' ', slice({text_words}, i, {k})) AS w, i AS i)))"
    repeated = (
        f"transform(array({sorted_windows}), s -> array_sort(filter(transform(s, (x, j) -> "
        "IF(x.w <=> get(s, j - 1).w OR x.w <=> get(s, j + 1).w, x.i, 0)), p -> p > 0)))[0]"
    )
    total = (
        f"transform(array({repeated}), p -> aggregate(transform(p, (x, j) -> "
        f"least({k}, coalesce(get(p, j + 1) - x, {k}))), 0, (a, b) -> a + b))[0]"
    )
    some = f"size(array_distinct(transform({starts}, i -> xxhash64(slice({text_words}, i, {k}))))) < size({text_words}) - {k - 1}"
    return F.expr(f"CASE WHEN size({text_words}) <= {k} THEN 0 WHEN {some} THEN {total} ELSE 0 END")


def with_base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    text = whole_text(text_col)
    split = docs.withColumn("__words", words(text))
    counted = split.withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
            "n_symbols": chars_in(text, SYMBOLS).cast("long"),
            "n_dup_lines": duplicate_lines(text).cast("long"),
            "n_repeat_words": repeated_words("__words").cast("long"),
        }
    )
    return counted.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


@dataclass(frozen=True)
class Rule:
    """``rejects`` is SQL over the base columns, ``__words`` (array) and ``__text``."""

    name: str
    rejects: str


#: The rules beyond the base. Thresholds are shares of words or lines, or (distinct words, which grow
#: with the root of a text's length) a power of them, so they hold at any length.
RULES: tuple[Rule, ...] = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("repeated_lines", "n_dup_lines * 2 > size(split(__text, '\n'))"),
    Rule("stutter", "size(filter(transform(__words, (w, i) -> w = get(__words, i - 1)), x -> x)) * 3 > n_words"),
    Rule("few_distinct", "pow(size(array_distinct(__words)), 2) < n_words"),
    Rule("capitals", "n_words >= 20 AND length(translate(__text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) * 2 < length(__text)"),
    Rule("marks", "length(__text) - length(translate(__text, '!?', '')) > n_words"),
)


def estimate(docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", rows: int = SAMPLE_ROWS) -> dict[str, tuple[float, float]]:
    """Rejected share and seconds of each rule on a written sample of at most ``rows`` rows."""
    total = docs.count()
    share = min(1.0, 1.5 * rows / total) if total else 1.0
    picked = docs.select(F.col(text_col).alias("text")).sample(False, share, 17).limit(rows)
    sample = with_base(picked).withColumn("__text", whole_text())
    sample = written(sample.drop("text"), "rule-sample").cache()
    n = sample.count()
    out = {}
    for rule in rules:
        start = time.perf_counter()
        hits = sample.agg(F.count_if(F.expr(rule.rejects))).first()[0]
        out[rule.name] = (hits / n if n else 0.0, time.perf_counter() - start)
    sample.unpersist()
    return out


def ordered(docs: DataFrame, rules: Sequence[Rule] = RULES, text_col: str = "text") -> list[Rule]:
    """The rules by falling rejection per cost; the written order breaks ties."""
    seen = estimate(docs, rules, text_col)
    return sorted(rules, key=lambda r: -seen[r.name][0] / max(seen[r.name][1], 1e-9))


def judge(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with the base columns, ``rejected_by`` and ``kept``.

    ``rejected_by`` names the first rule of the cascade that rejected, so with
    several reasons it follows the estimated order; ``kept`` doesn't.
    """
    chain = list(rules) if rules is not None else ordered(docs, RULES, text_col)
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "rejected_by", "kept"]
    rest = [c for c in docs.columns if c not in base]
    rows = with_base(docs.select(*rest), text_col).withColumn("__text", whole_text(text_col))
    cases = "CASE WHEN base_failed THEN 'base' " + "".join(f"WHEN {r.rejects} THEN '{r.name}' " for r in chain) + "END"
    return rows.withColumn("rejected_by", F.expr(cases)).withColumn("kept", F.col("rejected_by").isNull()).select(*rest, *base)


def kept_rows(docs: DataFrame, rules: Sequence[Rule] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with their columns only."""
    # Without the row mark in it the optimizer would move the filter below the counts and repeat them in it.
    judged = judge(docs, rules, text_col).withColumn("__mark", F.monotonically_increasing_id())
    return judged.where("kept AND __mark >= 0").select(*docs.columns)
