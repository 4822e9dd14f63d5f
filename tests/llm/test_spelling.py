"""Spelling variants against all pairs of words."""

import collections
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pricelab.llm import spelling as S
from pricelab.llm.queries import QUERIES


def edit_one(a, b):
    """Exactly one inserted, deleted or replaced character, by trying all."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(docs, one_in=97, least_count=3):
    n = collections.Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least_count}
    near = {w: [v for v in n if edit_one(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def test_signatures_miss_no_pair():
    rnd = random.Random(2)
    for _ in range(4000):
        word = "".join(rnd.choices("abcdeéàß", k=rnd.randrange(5, 14)))
        at = rnd.randrange(len(word) + 1)
        kind = rnd.randrange(3)
        other = word[:at] + rnd.choice("abcdeéx") + word[at:] if kind == 0 else word[:at] + word[at + 1:] if kind == 1 else word[:at] + "z" + word[at + 1:]
        if len(other) >= 5 and other != word:
            assert edit_one(word, other) and S.signatures(word) & S.signatures(other), (word, other)


def test_runs_too_short_for_words_are_not_told_apart():
    text = "Abcd ABCDÉ abcdé l'ÉTÉ×étÉÉé abcde-ABCDE"
    assert S.run_finder(5)(text.encode()) == {"abcdÉ": 1, "abcdé": 1, "ÉtÉ×étÉÉé": 1, "abcde": 2}
    assert S.run_finder(1)(text.encode())["abcd"] == 1


def test_the_checksum_of_a_run_goes_on_from_its_document(spark, make_docs):
    runs = ["abcdef", "Été", "ÉTÉÉÉÀ", "wörter", "x" * 300]
    docs = [(d, " ".join(r for r in runs for _ in range(3)), "a") for d in (0, -7, 12345678901, None)]
    got = {r["word"]: r["n"] for r in S.word_counts(make_docs(docs), 3, 3, 1).collect()}
    want = collections.Counter()
    for d, _, _ in docs:
        for r in runs:
            low = re.sub("[A-Z]", lambda m: m[0].lower(), r)
            want[S.damaged_run("" if d is None else str(d), low, 3)] += 3
    assert got == {w: n for w, n in want.items() if len(w) >= 3} and len(got) > len(runs)


def _text(rnd, n):
    words = ["".join(rnd.choices("abé", k=rnd.randrange(4, 8))) for _ in range(n)]
    return " ".join(rnd.choices(words, k=6 * n))


@pytest.mark.parametrize("held", [S.HELD_WORDS, 7])
def test_against_all_pairs(spark, make_docs, odd_rows, monkeypatch, held):
    monkeypatch.setattr(S, "HELD_WORDS", held)
    rnd = random.Random(4)
    rows = [*odd_rows, *((50 + i, _text(rnd, 40), "a") for i in range(12))]
    rows += [(80, "Colour colour colour COLOR color coloré " * 9 + "colors colors colors colour×÷x", "b"), (81, "l'Été ÉTÉÉÉ ÉTÉÉÉ étééé ÉTÉÉÉ" * 3, "b")]
    docs = make_docs(rows).withColumn("word", F.lit("clash")).withColumn("n", F.lit(1))
    got = S.spelling_variants(docs, one_in=11).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = brute([(i, t) for i, t, _ in rows], one_in=11)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert sum(r["form"] is not None for r in got) > 50 and any(r["form"] not in (None, r["root"]) for r in got)


def test_long_chains(spark):
    words = [("a" * 5 + "b" * i, 2**i) for i in range(12)]
    df = spark.createDataFrame(words, "word string, n long")
    got = {r["word"]: r["root"] for r in S.variants(df, S.near_words(df)).collect()}
    assert set(got.values()) == {words[-1][0]}


def test_empty_table(spark, make_docs):
    assert S.spelling_variants(make_docs([])).collect() == []


def test_query_on_given_table(spark):
    path = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op13_spelling_variants"](spark, path).collect()
    assert {tuple(r) for r in got} == brute(docs) and len(got) > 100
