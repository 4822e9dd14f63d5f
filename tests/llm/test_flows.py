"""Mixing, URL filters, tool calls, the pipeline and the registered queries."""

import collections
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelab.llm import balanced_mix as B, tool_calls as TC, url_filter as U
from pricelab.llm.queries import ORACLE, QUERIES, TOOLS, URL_RULES

SF_DIR = "/root/testdata/sf0.001"


def test_fill_targets():
    assert B.fill_targets([100, 100], [1, 1], 150, 2.0) == [75.0, 75.0]
    assert B.fill_targets([10, 100, 100], [3, 1, 2], 300, 2.0) == pytest.approx([20.0, 280 / 3, 560 / 3])
    assert B.fill_targets([10, 10], [1, 1], 90, 2.0) == [20.0, 20.0]
    assert B.fill_targets([0, 10], [1, 1], 15, 2.0) == [0.0, 15.0]


def test_mixture_tells_sources_apart(make_docs):
    """One identifier and text in two sources: each source's rows are its own share of the mix."""
    rows = [(i, " ".join(["w"] * (5 + i % 7)), s) for i in range(60) for s in ("a", "b")] + [(99, "w w", None)]
    docs = make_docs(rows)
    share = {r["source"]: r["n"] for r in B.mix(docs, (3, 1, 2), 1.5, 2.0).groupBy("source").agg(F.sum("taken").alias("n")).collect()}
    words = F.size(F.split("text", " "))
    mixed = {r["source"]: r["n"] for r in B.mixture(docs, (3, 1, 2), 1.5, 2.0).groupBy("source").agg(F.sum(words).alias("n")).collect()}
    assert mixed == {s: n for s, n in share.items() if n} and share["a"] != share["b"]


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    size = rng.integers(1, 900, 3000).astype(float)
    p = np.full(3000, 0.37)
    out = B.flight(p, size, rng)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(p.sum()) and (out @ size) == pytest.approx(p @ size)


@pytest.mark.parametrize("cell_rows", [50, 4096])
def test_mix(make_docs, odd_rows, cell_rows):
    rng = np.random.default_rng(2)
    rows = [r for r in odd_rows if r[0] not in (6, 7)]
    rows += [(100 + i, " ".join(["w"] * int(rng.integers(0, 60))), "abc"[i % 3] if i % 9 else None) for i in range(900)]
    docs = make_docs(rows).withColumn("deal", F.lit(1))
    got = B.mix(docs, (3, 1, 2), 1.5, 2.0, cell_rows=cell_rows).collect()
    again = B.mix(docs.repartition(5), (3, 1, 2), 1.5, 2.0, cell_rows=cell_rows).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"], r["size"], r["times"])
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    total = collections.defaultdict(lambda: [0, 0, 0])
    for r in got:
        t = total[r["source"]]
        t[0], t[1], t[2] = t[0] + r["taken"], r["target"], r["source_size"]
        assert r["taken"] <= 2 * r["size"]
    for taken, target, _ in total.values():
        assert abs(taken - target) <= 0.02 * target + 30
    assert sum(t[1] for t in total.values()) == pytest.approx(1.5 * sum(t[2] for t in total.values()))
    mixed = B.mixture(docs, (3, 1, 2), 1.5, 2.0)
    assert mixed.columns == docs.columns and mixed.count() == sum(r["times"] for r in B.mix(docs, (3, 1, 2), 1.5, 2.0).collect())
    assert B.mix(make_docs([]), (3, 1, 2), 1.5).count() == 0


def test_cascade_is_exact_on_the_universe(spark):
    keys = [f"site{i}.example" for i in range(4000)]
    listed = spark.createDataFrame([(k,) for k in keys[::9]] + [("elsewhere",), (None,)], "key string")
    universe = spark.createDataFrame([(k,) for k in keys] * 2, "key string")
    levels = U.cascade(listed, universe)
    h = np.array([r["h"] for r in universe.select(F.xxhash64("key").alias("h")).collect()], np.int64).view(np.uint64)
    assert len(levels) > 1 and U.listed_in(levels, h).tolist() == ([i % 9 == 0 for i in range(4000)] * 2)
    assert U.cascade(listed.limit(0), universe) == [] and U.cascade(listed, universe, max_bytes=10) is None


@pytest.mark.parametrize("max_bytes", [U.MAX_BYTES, 8])
def test_url_filter(spark, max_bytes):
    urls = [
        ("http://A.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12?x#y", "example.org", "/en/12", "example.org/en/1", "block"),
        ("https://example.org/en/2", "example.org", "/en/2", "org/", "allow"),
        ("https://org", "org", "", None, "allow"),
        ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
        ("http://xcom/fr/a", "xcom", "/fr/a", None, "allow"),
        ("http://deep.bad.net/a", "deep.bad.net", "/a", None, "block"),
        ("http://notbad.net/a", "notbad.net", "/a", None, "allow"),
        ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
        ("http://x.com?q=/fr/", "x.com", "", None, "allow"), ("http://x.com/fr/a", "x.com", "/fr/a", "com/fr/", "allow"),
    ]
    pages = spark.createDataFrame([(i, u[0], "old") for i, u in enumerate(urls)], "page_id long, url string, host string")
    listed = spark.createDataFrame([("bad.net",)], "key string")
    got = {r["page_id"]: r for r in U.judge(pages, URL_RULES, listed, max_bytes=max_bytes).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == (host, path, rule, verdict)
    assert U.judge(pages.limit(0), URL_RULES, listed).count() == 0


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        [
            (1, "a", None, "reply", '{"text":"hi","chars":2}', 0), (1, "b", "a", "reply", '{"chars":"x","text":"t"}', 1),
            (1, "c", "b", "setup", '{"text":"é \\"q\\""}', 2), (1, "c", "a", "setup", "{}", 3), (1, "d", "e", "none", "{}", 4),
            (1, "e", "d", "reply", None, 5), (2, "b", "a", "setup", '{"text":"t","more":1}', 0), (2, None, None, "setup", '{"text":"t"}', 1),
        ],
        "conv_id long, call_id string, after string, name string, arguments string, position long",
    )
    results = spark.createDataFrame(
        [(1, "a", "ok", 9), (1, "a", "late", 10), (1, "zz", "lost", 3), (None, "a", "no", 1)],
        "conv_id long, call_id string, content string, position long",
    )
    got = {(r["conv_id"], r["call_id"]): r for r in TC.link(calls, results, TOOLS).collect()}
    assert len(got) == 9
    assert got[1, "a"]["json"] == '{"arguments":"{\\"chars\\":2,\\"text\\":\\"hi\\"}","call_id":"a","content":"ok","conv_id":1,"depth":0,"name":"reply"}'
    facts = {k: (r["depth"], r["linked"], r["valid"]) for k, r in got.items()}
    assert facts[1, "a"] == (0, True, True) and facts[1, "b"] == (1, False, False) and facts[1, "c"] == (2, False, True)
    assert facts[1, "d"][0] is None and facts[1, "e"] == (None, False, False)
    assert facts[2, "b"] == (0, False, False) and facts[2, None] == (None, False, True)
    assert facts[1, "zz"] == (None, False, False) and facts[None, "a"] == (None, False, False)
    assert TC.link(calls.limit(0), results.limit(0), TOOLS).count() == 0


def test_chain_depths(spark):
    rows = [(1, f"c{i}", f"c{i - 1}" if i else None) for i in range(40)]
    got = {r["call_id"]: r["depth"] for r in TC.depths(spark.createDataFrame(rows, "conv_id long, call_id string, after string")).collect()}
    assert got == {f"c{i}": i for i in range(40)}


def test_pipeline_stages(spark, make_docs, odd_rows):
    import corpus_pipeline as P

    words = [f"word{i}" for i in range(300)]
    rng = np.random.default_rng(3)
    rows = list(odd_rows)
    for i in range(100, 160):
        rows.append((i, " ".join(rng.choice(words, 80)), "ab"[i % 2]))
    rows += [(500, rows[-1][1], "a"), (501, rows[-2][1] + " more", "b"), (502, "### $$$ %%% " * 30, "a")]
    docs = make_docs(rows)
    kept = P.quality(spark, docs, "")
    assert kept.columns == P.COLUMNS and {r["doc_id"] for r in kept.collect()} >= {*range(100, 160), 500, 501}
    assert 502 not in {r["doc_id"] for r in kept.collect()}
    single = P.exact(spark, kept, "")
    assert 500 in {r["doc_id"] for r in single.collect()} and 159 not in {r["doc_id"] for r in single.collect()}
    near = P.near(spark, single, "")
    ids = {r["doc_id"] for r in near.collect()}
    assert 501 not in ids and 158 in ids and len(ids) == single.count() - 1 - (7 in {r["doc_id"] for r in single.collect()})
    mixed = P.mixing(spark, near, "")
    assert mixed.columns == P.COLUMNS and {r["doc_id"] for r in mixed.collect()} <= ids
    coded = P.encoding(spark, mixed, "")
    assert coded.count() == mixed.count() and coded.where("n_tokens <> size(ids)").count() == 0
    for _, stage in P.STAGES:
        assert stage(spark, make_docs([]).select(*P.COLUMNS), "").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")
def test_every_operator_has_a_query():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 11)), "pipeline"} and set(ORACLE) <= set(QUERIES)
