"""One query per operator over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gridops.llm import audit, chat, decontam, exact, langid, pagetext, repeats, runs, shards, simhash, spm, tokens, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, table: str, sql: str | None = None):
    def register(f: Callable[[DataFrame], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(spark.read.parquet(f"{sf_dir}/{table}.parquet"))
        if sql:
            ORACLES[name] = sql
        return f

    return register


@_query(
    "op5_chat_formatting",
    "conversations",
    """WITH u AS (
         SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
       t AS (
         SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(role || chr(1) || text)) - 1 AS place,
                (place // 256)::BIGINT AS part FROM u),
       s AS (SELECT DISTINCT conv_id AS conv, role AS speaker FROM t),
       r AS (
         SELECT t.*, speaker, role = speaker AS own,
                CASE WHEN role = speaker THEN '<|im_start|>assistant' ELSE '<|im_start|>user name=' || role END || chr(10) AS head,
                text || '<|im_end|>' || chr(10) AS body
         FROM t JOIN s ON conv_id IS NOT DISTINCT FROM conv),
       p AS (
         SELECT *, coalesce(sum(length(head) + length(body)) OVER (
                     PARTITION BY conv_id, speaker, part ORDER BY place
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos
         FROM r)
       SELECT conv_id, speaker, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
              string_agg(head || body, '' ORDER BY pos) AS text,
              coalesce(string_agg(CASE WHEN own THEN (pos + length(head)) || ':' || (pos + length(head) + length(body)) END,
                                  ',' ORDER BY pos), '') AS mask
       FROM p GROUP BY conv_id, speaker, part""",
)
def op5_chat_formatting(conversations: DataFrame) -> DataFrame:
    return chat.rotate_perspectives(conversations)


@_query("op7_sharding", "documents")
def op7_sharding(documents: DataFrame) -> DataFrame:
    return shards.shard_documents(documents)


@_query(
    "op10_exact_dedup",
    "documents",
    """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
              row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
              sha256(coalesce(text, '')) AS text_sha256
       FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
)
def op10_exact_dedup(documents: DataFrame) -> DataFrame:
    return exact.exact_duplicates(documents)


@_query("op1_sentencepiece", "documents")
def op1_sentencepiece(documents: DataFrame) -> DataFrame:
    return spm.encode_texts(documents, public_tokenizers.path("piece_bpe_32k.model"))


@_query("op2_simhash", "documents")
def op2_simhash(documents: DataFrame) -> DataFrame:
    return simhash.near_duplicates(documents)


@_query("op8_token_ids", "documents")
def op8_token_ids(documents: DataFrame) -> DataFrame:
    return tokens.read_token_blocks(tokens.write_token_blocks(documents, public_tokenizers.path("word_bpe_49k.json")))


@_query("op4_url_filter", "pages")
def op4_url_filter(pages: DataFrame) -> DataFrame:
    return urls.judge_urls(pages)


@_query("op9_language_id", "documents")
def op9_language_id(documents: DataFrame) -> DataFrame:
    return langid.predict_language(documents)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontam.decontaminate(documents, benchmark)


QUERIES["op6_decontamination"] = op6_decontamination


@_query("op3_suffix_dedup", "documents")
def op3_suffix_dedup(documents: DataFrame) -> DataFrame:
    return repeats.remove_repeats(documents).drop("kept")


@_query("op11_periodic_runs", "documents")
def op11_periodic_runs(documents: DataFrame) -> DataFrame:
    return runs.run_digest(runs.find_runs(documents, loops=True))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return audit.audit_filters(documents, labels)


QUERIES["op12_filter_audit"] = op12_filter_audit
ORACLES["op12_filter_audit"] = r"""WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents),
f AS (
  SELECT doc_id, part, (len(words) < 200)::INT + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
         + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT
         + 16 * coalesce(min(doc_id) OVER (PARTITION BY text) < doc_id, false)::INT AS mask FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
c AS (SELECT chr(65 + i::INT) AS c FROM range(5) t(i)),
o AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM c a, c b, c d, c e, c g
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
s AS (
  SELECT filter_order, k::INT AS step, substr(filter_order, k::INT, 1) AS letter,
         list_sum([1 << (ascii(substr(filter_order, i::INT, 1)) - 65) FOR i IN range(1, k)]) AS before
  FROM o, range(1, 6) t(k)),
r AS (
  SELECT part, filter_order, step, letter, 1 << (ascii(letter) - 65) AS bit, coalesce(before, 0)::INT AS before, mask, n, good, toxic FROM m, s),
t AS (
  SELECT part, filter_order, step, letter,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & before <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY part, filter_order, step, letter)
SELECT * EXCLUDE (letter), (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM t"""


@_query("op13_html_extraction", "pages")
def op13_html_extraction(pages: DataFrame) -> DataFrame:
    return pagetext.extract_main_text(pages)
