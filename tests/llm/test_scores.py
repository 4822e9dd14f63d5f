"""Rules, language model, toxicity and encoding against brute force and held-out rows."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from pricelab.llm import bpe, ngram_lm, quality_rules as Q, toxicity as T, words as W
from pricelab.llm.elias_fano import EliasFano

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def test_words_match_the_pattern():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\n\t\x0b😀 X") for _ in range(rng.randint(0, 50))) for _ in range(300)] + ["", None, " ", "a"]
    w = W.words_of(pa.array(texts))
    got = [[bytes(w.raw[s:e]).decode() for s, e in zip(w.start[a:b], w.end[a:b])] for a, b in zip(w.bounds[:-1], w.bounds[1:])]
    assert got == [WORD.findall(low(t)) for t in texts]
    seen = {}
    for a, words in zip(w.bounds[:-1], got):
        for j, x in enumerate(words):
            assert seen.setdefault(x, w.hash[a + j]) == w.hash[a + j]
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (5, 3), (900, 10), (900, 10**6), (4000, 2**60), (3000, 3000)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n).astype(np.uint64))
    level = EliasFano.build(v)
    keys = np.concatenate([rng.integers(0, top + 5, 500).astype(np.uint64), v])
    assert (level.rank_of(keys) == np.searchsorted(v, keys)).all()
    if n:
        at = rng.integers(0, n, 200)
        assert (level.access(at) == v[at]).all()


def base_counts(text):
    w = WORD.findall(text or "")
    grams = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_quality_rules(make_docs, odd_rows):
    rng = random.Random(2)
    rows = odd_rows + [(100 + i, " ".join(rng.choice(["a", "b", "c#", "dé\n", "x|"]) for _ in range(rng.randint(0, 40))), "s") for i in range(150)]
    docs = make_docs(rows).withColumn("n_words", F.lit(-1))
    got = Q.judge(docs).collect()
    counts = collections.Counter((r["doc_id"], r["text"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got)
    assert counts == collections.Counter((i, t, *base_counts(t)) for i, t, _ in rows)
    assert all(not r["kept"] for r in got if r["base_failed"])
    forward = {r["doc_id"]: r["kept"] for r in Q.judge(docs, Q.RULES).collect()}
    backward = {r["doc_id"]: r["kept"] for r in Q.judge(docs, Q.RULES[::-1]).collect()}
    assert forward == backward == {r["doc_id"]: r["kept"] for r in got}
    clean = Q.kept_rows(docs)
    assert clean.columns == docs.columns and clean.count() == sum(r["kept"] for r in got)
    assert Q.judge(make_docs([])).count() == 0


def brute_scores(rows, held):
    """Per row (n_tokens, n_known, train_tokens, base score, exact score) of the trigram model."""
    one, pair, context = collections.Counter(), collections.Counter(), collections.Counter()
    two, three = collections.Counter(), collections.Counter()
    texts = [WORD.findall(low(t)) + ["\n"] for _, t, _ in rows]
    for (i, _, _), w in zip(rows, texts):
        if not held(i):
            p = ["^", "^", *w]
            one.update(w), pair.update(zip(p[1:], w)), three.update(zip(p, p[1:], w)), two.update(zip(p, p[1:-1])), context.update(p[1:-1])
    total = sum(one.values())
    unit = math.log10(total + len(one) + 1)
    k2, k3 = ngram_lm.BACK
    out = []
    for w in texts:
        p, model = ["^", "^", *w], 0.0
        for a, b, c in zip(p, p[1:], w):
            if three[a, b, c]:
                model += math.log10(three[a, b, c] / (two[a, b] + k3))
                continue
            model += math.log10(k3 / (two[a, b] + k3))
            model += math.log10(pair[b, c] / (context[b] + k2)) if pair[b, c] else math.log10(k2 / (context[b] + k2) * (one[c] + 1)) - unit
        out.append((len(w), sum(one[x] > 0 for x in w), total, sum(math.log10(one[x] + 1) - unit for x in w), model))
    return out


def test_language_model_against_brute_force(make_docs, odd_rows, monkeypatch):
    """Exact counts, scores within the quantisation and never above 0, whichever words are split."""
    monkeypatch.setattr(ngram_lm, "PART_BYTES", 40_000)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 60_000)
    rng = random.Random(4)
    rows = odd_rows + [(50 + i, " ".join(f"t{int(rng.paretovariate(0.9)) % 60}" for _ in range(rng.randint(0, 90))), "s") for i in range(200)]
    held = F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False))
    want = collections.defaultdict(list)
    for (i, _, _), w in zip(rows, brute_scores(rows, lambda i: i is not None and i % 7 == 2)):
        want[i].append(w)
    seen = []
    for rarest in (1 << 16, 30, 1):
        monkeypatch.setattr(ngram_lm, "RAREST", rarest)
        docs = make_docs(rows)
        for name in ("chunk", "held", "score"):
            docs = docs.withColumn(name, F.lit(0))
        got = ngram_lm.score(docs, held).collect()
        assert len(got) == len(rows)
        for r in got:
            n, known, total, base, model = want[r["doc_id"]][0]
            assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
            assert r["base_score"] == pytest.approx(base, rel=1e-9, abs=1e-9)
            assert r["score"] <= min(0, model + 1e-9) and r["score"] >= model - 2 * n / ngram_lm.STEPS - 1e-9
        seen.append(sorted((r["doc_id"] or -1, round(r["score"], 6)) for r in got))
    assert seen[0] == seen[1] == seen[2]
    assert ngram_lm.score(make_docs([]), held).count() == 0
    nothing = ngram_lm.score(make_docs(rows[:5]), F.lit(True)).collect()
    assert [(r["train_tokens"], r["n_known"], r["score"]) for r in nothing] == [(0, 0, 0.0)] * 5


def test_language_model_of_one_text_repeated(make_docs):
    got = ngram_lm.score(make_docs([(i, "x y", "s") for i in range(1060)]), F.lit(False)).collect()
    assert len(got) == 1060 and all(-0.6 < r["score"] <= 0 for r in got)


def test_probabilities_of_a_context_sum_to_at_most_one():
    """Quantised successors and the back-off of every context of one and of two words, split or whole."""
    rng = random.Random(9)
    text = pa.chunked_array([[" ".join(f"t{int(rng.paretovariate(0.7)) % 40}" for _ in range(300)) for _ in range(60)]])
    token, first = ngram_lm.tokens_of(text)
    word, w, v, u = ngram_lm.contexts(token, first)
    codes = np.unique(np.concatenate([word[:5], word[-1:], ngram_lm.pair_code(word[v[:90]], word[u[:90]])]))
    hot = codes, 1 << (np.arange(len(codes)) % 4)
    g = ngram_lm.Grams(token, first, hot, 3, np.ones(len(token), bool))
    answers = {}
    for shard, request in g.requests(3):
        r = ngram_lm.looked_up([ngram_lm.unpack(request, *ngram_lm._REQUEST)])
        answers[shard] = r.group_at, r.word_back[r.group_at], r.pair_back[r.pair_at], r.two_code, r.code[r.three_at]
    _, word_back, pair_back, two, three = (np.concatenate(x) for x in zip(*(answers[s] for s in sorted(answers))))

    def p(codes):
        return 10 ** (-(codes.astype(float) - 1) / ngram_lm.STEPS)

    assert (three > 0).all() and (two > 0).all()
    n = len(token)
    before = {}
    places = np.append(token, ngram_lm.BEGIN)
    starts = set(first[:-1].tolist())
    for i in range(n):
        v = n if i in starts else i - 1
        u = n if i in starts or v in starts else i - 2
        u, v, w = places[u], places[v], token[i]
        before.setdefault((u, v), [{}, set()])[0][w] = p(three)[g.three_at[i]]
        before[u, v][1].add(p(pair_back)[g.pair_at[i]])
        k = g.second[i]
        before.setdefault(v, [{}, set()])[0][w] = p(two)[g.two_at[k]]
        before[v][1].add(p(word_back)[g.group_at[k]])
    for successors, back in before.values():
        assert len(back) == 1 and 0.8 < sum(successors.values()) + back.pop() <= 1


def test_deobfuscation_restores_words(make_docs):
    text = ["the idiot was a stupid loser and the moron said that it is pathetic scum of the earth " * 3] * 5
    model = T.character_model(make_docs([(i, t, "s") for i, t in enumerate(text)])).tolist()
    for hidden, plain in (("m0ron", "moron"), ("stup1d", "stupid"), ("l o s e r", "loser"), ("s.t.u.p.i.d", "stupid"),
                          ("p@thetic", "pathetic"), ("$cum", "scum"), ("looooser", "loser")):
        assert plain in T.restored(f"you {hidden} there", model, {}).split()
    for clean in ("a clean text, see page 3 of 10.", "Mr. Smith & co"):
        assert T.restored(clean, model, {}) == ""
    hidden = pa.array(["clean words", "m0ron", "a b c d e", "sooo", "l.o.s.e.r", "ééé", "é-é-é-é"])
    assert T.disguised(W.lower_bytes(W.text_bytes(hidden)[0]), W.text_bytes(hidden)[1]).tolist() == [False] + [True] * 6


def test_toxicity_on_held_out_rows(spark, make_docs, odd_rows):
    rng = random.Random(5)
    plain = [f"w{i}" for i in range(80)]
    bad = ["idiot", "moron", "scum"]
    rows, labels = list(odd_rows), []
    for i in range(100, 500):
        w = [rng.choice(plain) for _ in range(40)]
        if i % 5 == 0:
            w[7] = rng.choice(bad) + rng.choice(["", "s", "ish"])
        labels.append((i, int(i % 5 == 0)))
        rows.append((i, " ".join(w), "s"))
    table = spark.createDataFrame(labels + [(None, 1), (9999, 1)], "doc_id long, toxic int")
    docs = make_docs(rows).withColumn("score", F.lit(7))
    fitted = T.fit(docs, table, F.col("doc_id") % 4 != 2)
    got = {r["doc_id"]: r["score"] for r in T.score(docs, fitted, [F.col("doc_id")]).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[3] == got[4]
    held = [(got[i], y) for i, y in labels if i % 4 == 2]
    assert sum((s >= 0.3) == bool(y) for s, y in held) >= 0.97 * len(held)
    none = T.fit(docs, table.where("toxic = 7"), F.lit(True))
    assert len(T.score(docs, none, [F.col("doc_id")]).collect()) == len(rows)
    assert T.score(make_docs([]), none, [F.col("doc_id")]).count() == 0


@pytest.fixture(scope="module")
def ranks():
    tokenizers = pytest.importorskip("public_tokenizers")
    return tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


def test_bpe_equals_the_library(ranks):
    import tiktoken

    path, pattern = ranks
    own = bpe._new_encoder(path, pattern)
    ref = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(6)
    for _ in range(1500):
        text = "".join(rng.choice(rng.choice(["ab", "aaab", "the ing", "ñéç", " \n\t", "0123", "日本😀", "!?*#"])) for _ in range(rng.randint(0, 40)))
        assert own(text) == ref.encode_ordinary(text)
    for text in ("a" * 5000, " " * 4000 + "x", "thetion" * 3000, "0" * 3001):
        assert own(text) == ref.encode_ordinary(text)


def test_bpe_round_trip(make_docs, odd_rows, ranks):
    import hashlib

    path, pattern = ranks
    docs = make_docs(odd_rows).withColumn("ids", F.lit("clash"))
    back = bpe.decode(bpe.encode(docs, path, pattern), path).collect()
    assert len(back) == len(odd_rows) and all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in back)
    for r in bpe.round_trip(docs, path, pattern).where("doc_id IN (3, 8)").collect():
        text = {3: "", 8: "Été où l'île"}[r["doc_id"]]
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(make_docs([]), path, pattern).count() == 0


@pytest.mark.parametrize("n", [30, 400, 5000])
def test_few_distinct_words_at_any_length(spark, make_docs, n):
    """A few words in ever new orders go, whatever the length; running prose of that length stays."""
    rng = random.Random(n)
    few = " ".join(rng.choice(["sun", "moon", "star", "sky", "sea"][: 2 if n < 100 else 5]) for _ in range(n))
    prose = " ".join(f"word{rng.randrange(n)}" for _ in range(n))
    rules = [r for r in Q.RULES if r.name == "few_distinct"]
    got = {r["doc_id"]: r for r in Q.judge(make_docs([(1, few, "a"), (2, prose, "a")]), rules).collect()}
    assert got[1]["rejected_by"] in ("base", "few_distinct") and not got[1]["kept"] and got[2]["rejected_by"] != "few_distinct"


def test_bpe_sends_back_the_columns_asked_for(make_docs, odd_rows, ranks):
    path, pattern = ranks
    docs = make_docs(odd_rows)
    coded = bpe.encode(docs, path, pattern, keep=["doc_id", "lang"])
    whole = bpe.encode(docs, path, pattern)
    assert coded.columns == ["doc_id", "lang", "ids"] and whole.columns == [*docs.columns, "ids"]
    assert sorted(map(str, coded.collect())) == sorted(map(str, whole.select("doc_id", "lang", "ids").collect()))
