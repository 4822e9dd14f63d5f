"""Prefix counts against the library, for texts and for every prefix of them."""

import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pricelab.llm import token_counts as C
from pricelab.llm.queries import QUERIES

PATH = P.path("byte_bpe_50k.json")
ODD = [
    "", " ", "   ", "We're  they've\n\n  don't'll 'r 're'r\t\t x", "a<|endoftext|> b<|endoftext|><|endoft  <|endoftext|>", "<|endoftext|>",
    "été 日本語 テスト 👩‍👩‍👧 x　　y   z   \x1c\x1d", "\n\n\n a\r\n\r\n  cc", "x" * 300, "'" * 20, "aaaa    bbbb", "1234567 12 3456   99",
    "𝔘𝔫𝔦 ½ ⅷ ०१२ ño a‍b", "=" * 70 + "-" * 65,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_every_prefix(library):
    counter = C.PrefixCounter(PATH, P.PATTERN)
    rnd = random.Random(7)
    alphabet = ["a", "the", " ", "  ", "\n", "'", "re", "s", "é", "1", "!", "<|endoftext|>", "<|", "日", "ing", "\t"]
    for text in ODD + ["".join(rnd.choices(alphabet, k=40)) for _ in range(60)]:
        assert counter.prefixes(text).tolist() == [library(text[:i]) for i in range(len(text) + 1)], text


def test_all_characters(library):
    counter = C.PrefixCounter(PATH, P.PATTERN)
    letters = [chr(i) for i in range(0x3100)] + [chr(i) for i in range(0xA000, 0x20000, 7) if not 0xD800 <= i < 0xE000]
    for i in range(0, len(letters), 3000):
        text = "".join(f"a{c}1{c}{c} " for c in letters[i:i + 3000])
        assert counter.prefixes(text)[-1] == library(text)


def test_a_full_memory_starts_anew(library, monkeypatch):
    monkeypatch.setattr(C, "CACHE_CHARS", 20)
    monkeypatch.setattr(C, "CACHE_PAIRS", 3)
    counter = C.PrefixCounter(PATH, P.PATTERN)
    for text in ODD:
        assert counter.prefixes(text)[-1] == library(text)


def test_budgets_and_stored_counts(spark, make_docs, odd_rows, library):
    rows = [*odd_rows, *((100 + i, t, "a") for i, t in enumerate(ODD))]
    docs = make_docs(rows).withColumn("counts", F.lit("x")).withColumn("__text", F.lit("y"))
    got = C.prefix_counts(docs, PATH, P.PATTERN, budgets=[0, 3]).withColumn("fit", C.longest_within(3))
    got = got.withColumn("at2", C.tokens_at(F.lit(2)))
    want = {(i, len((t or "").encode()), library(t or "")) for i, t, _ in rows}
    taken = got.collect()
    assert len(taken) == len(rows) and {(r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in taken} == want
    texts = {r[0]: r[1] or "" for r in rows}
    for r in taken:
        text = texts[r["doc_id"]]
        assert r["fit_0"] == 0 and r["fit"] == r["fit_3"] and r["at2"] == (library(text[:2]) if len(text) >= 2 else None)
        if len(text) < 500:
            assert r["fit_3"] == max(i for i in range(len(text) + 1) if library(text[:i]) <= 3)


def test_empty_table(spark, make_docs):
    assert C.prefix_counts(make_docs([]), PATH, P.PATTERN).collect() == []


def test_query_on_given_table(spark, library):
    path = "/root/testdata/sf0.001"
    texts = {r[0]: r[1] or "" for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()}
    got = QUERIES["op12_token_counts"](spark, path).collect()
    assert len(got) == len(texts)
    for r in got:
        n = library(texts[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 1024)
