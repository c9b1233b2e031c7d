"""The operators of this subpackage as named queries over whole tables, and the SQL that
gives the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrublens.llm import (
    chat,
    chunk_fingerprint,
    conversation_repair,
    conversation_trie,
    decontamination,
    exact_dedup,
    html_extract,
    language_id,
    lm_scoring,
    packing,
    simhash,
    url_filter,
    warc,
)
from scrublens.llm.common import fold, table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    url_filter.Rule("allow", "org"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contaminated(docs, "doc_id", "text", items, "item_id", "text")


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 5)
    docs = table(spark, sf_dir, "documents")
    found = lm_scoring.score_texts(docs, "doc_id", "text", train=part != 1, tune=part == 2)
    return found.select(
        "doc_id",
        (part == 1).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), "page_id", "url", URL_RULES)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return warc.round_trip(pages, "page_id", "url", "html").select(
        F.col("id").alias("page_id"),
        "payload_bytes",
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extract_text(pages, "html")


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    return chat.repair(turns, "conv_id", "turn", "role", "text")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 3) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = language_id.identify_languages(docs, "text", "lang", train=~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_fingerprint.compare_with_next(table(spark, sf_dir, "documents"), "doc_id", "text")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    damaged = conversation_repair.damaged(turns, "conv_id", "turn", "role", "text")
    return conversation_repair.repair(damaged, "conv_id", "turn", "role", "text")


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    own = conversation_trie.turn_sequences(turns, "conv_id", "turn", "role", "text")
    base = own.filter("conv % 20 = 0").select(
        F.col("conv").alias("base"), F.slice("turns", 1, 3).alias("opening")
    )
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).cast("int")
    rebuilt = own.join(base, F.col("conv") - F.col("conv") % 20 == F.col("base"), "left").select(
        "conv",
        F.concat(
            F.slice(F.coalesce("opening", F.expr("array()").cast("array<string>")), F.lit(1), head),
            F.slice("turns", head + 1, F.size("turns")),
        ).alias("turns"),
    )
    return conversation_trie.prefix_trie(rebuilt).drop("turn")


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_url_filter": op4_url_filter,
    "op5_packing": op5_packing,
    "op6_warc": op6_warc,
    "op7_html_extraction": op7_html_extraction,
    "op8_chat_format": op8_chat_format,
    "op9_simhash": op9_simhash,
    "op10_language_id": op10_language_id,
    "op11_chunk_fingerprints": op11_chunk_fingerprints,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_conversation_trie": op13_conversation_trie,
}

_VALUES = ", ".join(f"('{r.action}', '{r.host}', '{r.path}')" for r in URL_RULES)

SQL: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               doc_id = first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS kept,
               text_sha256
        FROM d""",
    "op4_url_filter": rf"""
        WITH rules(action, rule_host, rule_path) AS (VALUES {_VALUES}),
        u AS (
            SELECT page_id,
                   translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
            FROM pages),
        m AS (
            SELECT u.page_id, r.rule_host || r.rule_path AS rule, r.action,
                   row_number() OVER (PARTITION BY u.page_id
                                      ORDER BY length(rule_host) DESC, length(rule_path) DESC) AS place
            FROM u JOIN rules r
              ON (u.host = r.rule_host OR ends_with(u.host, '.' || r.rule_host))
             AND starts_with(u.path, r.rule_path))
        SELECT u.page_id, u.host, u.path, m.rule, coalesce(m.action, 'allow') AS verdict
        FROM u LEFT JOIN m ON m.page_id = u.page_id AND m.place = 1""",
    "op6_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END
                   AS record_type,
               CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
        FROM f""",
}
