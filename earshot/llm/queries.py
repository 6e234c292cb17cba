"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import caps, chat, decontaminate, langid, lexical, licenses, lmscore, mixing, negatives, pii, simhash, tokenids, urlfilter
from earshot.llm.words import count_words
from earshot.session import scratch_path, stored

TOKENIZER = "byte_bpe_50k.json"

URL_RULES = (
    urlfilter.Rule("net", "/", "block"),
    urlfilter.Rule("example.net", "/en/", "allow"),
    urlfilter.Rule("example.com", "/de/", "block"),
    urlfilter.Rule("org", "/fr/", "allow"),
)
ODD_TURN = "\\### Assistant: </turn> ok"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@query
def op1_chat_format(spark: SparkSession, root: str) -> DataFrame:
    turns = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", ODD_TURN), (-7, 1, "assistant", ODD_TURN)], "conv_id long, turn long, role string, text string")
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(odd)))


@query
def op2_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, root, "documents"), table(spark, root, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query
def op3_license_scan(spark: SparkSession, root: str) -> DataFrame:
    return licenses.find_licenses(table(spark, root, "documents"))


@query
def op4_token_ids(spark: SparkSession, root: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    tokenids.write_tokens(table(spark, root, "documents"), path, public_tokenizers.path(TOKENIZER))
    return tokenids.document_digests(tokenids.read_tokens(spark, path))


@query
def op5_simhash(spark: SparkSession, root: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, root, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_lm_score(spark: SparkSession, root: str) -> DataFrame:
    return lmscore.score_documents(table(spark, root, "documents"), public_tokenizers.path(TOKENIZER))


@query
def op7_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").withColumn("held_out", langid.held_out())
    found = langid.predict_languages(docs, langid.fit_languages(docs), ("doc_id", "held_out"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op8_mix(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    sized = stored(docs.select("doc_id", "source", count_words(F.col("text")).alias("size")), "sizes")
    return mixing.mix_sources(sized).select("doc_id", "size", "source_size", "target", "taken", "source")


@query
def op9_url_filter(spark: SparkSession, root: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, root, "pages"), URL_RULES)


@query
def op10_cap_dedup(spark: SparkSession, root: str) -> DataFrame:
    return caps.near_vectors(table(spark, root, "embeddings"))


@query
def op11_pii(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    found = pii.find_pii(docs, pii.fit_model(docs))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(base) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.span_text(base), 256).alias("base_sha256"), pii.span_text(F.col("spans")).alias("spans")
    )


@query
def op12_hard_negatives(spark: SparkSession, root: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, root, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


@query
def op13_lexical_search(spark: SparkSession, root: str) -> DataFrame:
    found = lexical.rank_documents(table(spark, root, "documents"), table(spark, root, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


ORACLES: dict[str, str] = {}

# Windows of ten words, or of a whole shorter item, looked up by length.
ORACLES["op2_decontaminate"] = r"""
WITH items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n),
found AS (SELECT r, i, p.n, item_id FROM places p JOIN windows ON p.n = windows.n AND array_to_string(w[i : i + p.n - 1], ' ') = k),
hits AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM found) GROUP BY r),
names AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN names USING (r)
"""

ORACLES["op9_url_filter"] = """
WITH places AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules AS (SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(h, p, v)),
best AS (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(h) DESC, length(p) DESC) AS n
  FROM (SELECT DISTINCT page_id, host, path FROM places) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM places LEFT JOIN (SELECT * FROM best WHERE n = 1) USING (page_id, host, path)
"""

ORACLES["op1_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### <text></turn>' || chr(10)) + length(role) + length(text)
           + length(regexp_replace(role || text, '[^\\<#]', '', 'g')))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

ORACLES["op12_hard_negatives"] = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.l AS al, x.r AS x, x.vec_id, x.l, list_inner_product(a.v, x.v)::BIGINT AS s
  FROM vectors a, vectors x WHERE a.vec_id % 100 = 0 AND a.r <> x.r),
positives AS (
  SELECT a, x, vec_id AS positive_id, s AS positive_score
  FROM scored WHERE l = al QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, vec_id NULLS LAST) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY a, p.x ORDER BY s DESC, vec_id NULLS LAST)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, s AS negative_score
FROM positives p JOIN scored USING (a)
WHERE l <> al AND 80 * positive_score <= 100 * s AND s <= positive_score
QUALIFY rank <= 5
"""

ORACLES["op13_lexical_search"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM docs WHERE len(t) > 0),
items AS (
  SELECT DISTINCT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS i, * FROM benchmark)),
counted AS (
  SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM docs) SEMI JOIN items USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, sizes GROUP BY term, n_docs),
scored AS (
  SELECT i, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM counted JOIN weights USING (term) JOIN items USING (term), sizes GROUP BY i, item_id, r, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50
"""
