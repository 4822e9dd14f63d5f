"""Queries of the subpackage on the given tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricelab.llm import (
    balanced_mix, bpe, conversation_repair, exact_dedup, line_dedup, ngram_join, ngram_lm, quality_rules, spelling, token_counts, tool_calls, toxicity,
    url_filter,
)
from pricelab.llm.frames import table

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


@query(
    "op1_exact_dedup",
    """SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
    doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
)
def op1(spark, sf_dir):
    return exact_dedup.dedup(table(spark, sf_dir, "documents", "doc_id", "text"))


_OP4_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM t)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM r) GROUP BY doc_id),
ln AS (SELECT doc_id, list_filter(string_split(x, chr(10)), lambda l: len(regexp_extract_all(l, '[^\\x20\\x09-\\x0D]+')) > 0) AS l FROM t),
b AS (SELECT t.doc_id, x, w, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda a: length(a))), 0)::BIGINT AS word_chars,
  (length(x) - length(translate(x, '#*$%&|<>', '')))::BIGINT AS n_symbols,
  (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM t JOIN ln USING (doc_id) LEFT JOIN c USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
  OR n_dup_lines * 2 > len(string_split(x, chr(10)))
  OR len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) * 3 > n_words
  OR len(list_distinct(w)) * len(list_distinct(w)) < n_words
  OR (n_words >= 20 AND length(regexp_replace(x, '[A-Z]', '', 'g')) * 2 < length(x))
  OR length(x) - length(regexp_replace(x, '[!?]', '', 'g')) > n_words) AS kept
FROM f"""


@query("op4_quality_rules", _OP4_SQL)
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op8_byte_bpe")
def op8(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: Rules of the query, as dealt.
URL_RULES = (
    url_filter.UrlRule("allow", "org", "/"),
    url_filter.UrlRule("block", "example.org", "/es/"),
    url_filter.UrlRule("block", "example.org", "/en/1"),
    url_filter.UrlRule("allow", "com", "/fr/"),
    url_filter.UrlRule("block", "com", "/de/"),
)
#: Site names of the query's block list; each is listed below every domain in BLOCKED_BELOW.
BLOCKED_SITES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
BLOCKED_BELOW = ("example.com", "example.net", "example.org")
_LISTED = [f"{a}.{b}" for a in BLOCKED_SITES for b in BLOCKED_BELOW]

_OP10_SQL = f"""
WITH p AS (SELECT page_id, lower(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)) AS host,
  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
r AS (SELECT *, CASE {" ".join(
    f"WHEN ('.' || host) LIKE '%.{r.host}' AND starts_with(path, '{r.path}') THEN '{r.verdict} {r.text}'"
    for r in sorted(URL_RULES, key=lambda r: -len(r.text)))} END AS hit FROM p)
SELECT page_id, host, path, string_split(hit, ' ')[2] AS rule, CASE WHEN hit IS NOT NULL THEN string_split(hit, ' ')[1]
  WHEN {" OR ".join(f"('.' || host) LIKE '%.{k}'" for k in _LISTED)} THEN 'block' ELSE 'allow' END AS verdict FROM r"""


@query("op10_url_filter", _OP10_SQL)
def op10(spark, sf_dir):
    listed = spark.createDataFrame([(k,) for k in _LISTED], "key string")
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES, listed).drop("url")


#: Weights of the query's sources in turn, the share of all words that is mixed, and the most repeats.
MIX_WEIGHTS, MIX_SHARE, MIX_CAP = (3, 1, 2), 1.5, 2.0


@query("op9_balanced_mix")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source")
    return balanced_mix.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_CAP).drop("deal")


@query("op5_ngram_join")
def op5(spark, sf_dir):
    return ngram_join.link(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, num=90, den=100)


def _remainder(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


@query("op6_ngram_lm")
def op6(spark, sf_dir):
    return ngram_lm.score(table(spark, sf_dir, "documents", "doc_id", "text"), _remainder(7) == 2)


#: Scores from here on count as toxic.
TOXIC_FROM = 0.3


@query("op3_toxicity")
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held = _remainder(4) == 2
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held)
    scored = toxicity.score(docs, fitted, [F.col("doc_id"), F.coalesce(held, F.lit(False)).alias("held_out")])
    return scored.withColumn("predicted", (F.col("score") >= TOXIC_FROM).cast("int"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query("op2_line_dedup")
def op2(spark, sf_dir):
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select(
        "doc_id", "n_lines", "n_removed_lines", F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256")
    )


#: Tools of the query; a system turn must not be longer than a reply's fields allow.
TOOLS = {"reply": tool_calls.Tool({"chars": "int", "text": "string"}, ("chars", "text")), "setup": tool_calls.Tool({"text": "string"}, ("text",))}

_OP7_SQL = """
WITH RECURSIVE a AS (SELECT conv_id, conv_id || '-' || turn AS call_id, conv_id || '-' || (turn - 2) AS after,
  CASE WHEN role = 'user' THEN 'reply' ELSE 'setup' END AS name, turn, length(text) AS chars, text
  FROM conversations WHERE role IN ('user', 'system')),
r AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, text AS content FROM conversations WHERE role = 'assistant'),
d AS (SELECT conv_id, call_id, 0::BIGINT AS depth FROM a WHERE (conv_id, after) NOT IN (SELECT (conv_id, call_id) FROM a)
  UNION ALL SELECT a.conv_id, a.call_id, d.depth + 1 FROM a JOIN d ON a.conv_id = d.conv_id AND a.after = d.call_id)
SELECT conv_id, call_id, name, depth, a.call_id IS NOT NULL AND r.call_id IS NOT NULL AS linked, coalesce(name = 'reply', false) AS valid,
  '{' || concat_ws(',', '"arguments":' || to_json('{"chars":' || chars || ',"text":' || to_json(text)::VARCHAR || '}')::VARCHAR,
  '"call_id":' || to_json(call_id)::VARCHAR, '"content":' || to_json(content)::VARCHAR, '"conv_id":' || conv_id, '"depth":' || depth,
  '"name":' || to_json(name)::VARCHAR) || '}' AS json
FROM a JOIN d USING (conv_id, call_id) FULL JOIN r USING (conv_id, call_id)"""


@query("op7_tool_calls", _OP7_SQL)
def op7(spark, sf_dir):
    calls, results = tool_calls.from_turns(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, TOOLS).select("conv_id", "call_id", "name", "depth", "linked", "valid", "json")


@query("op11_conversation_repair")
def op11(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return conversation_repair.repair_conversations(conversation_repair.damaged(turns))


#: Texts of more tokens are over the query's limit.
TOKEN_LIMIT = 1024


@query("op12_token_counts")
def op12(spark, sf_dir):
    import public_tokenizers

    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.prefix_counts(docs, path, public_tokenizers.PATTERN, budgets=[TOKEN_LIMIT], store=False)
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"), f"fit_{TOKEN_LIMIT}")


@query("op13_spelling_variants")
def op13(spark, sf_dir):
    return spelling.spelling_variants(table(spark, sf_dir, "documents", "doc_id", "text"))
