"""The opN_* queries: each applies one corpus operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chat_format, decontaminate, language_id, lexical_search, ngram_jaccard, oracle, quality_rules, repeated_strings, sharding, substring_dedup, token_files, turn_repair, warc
from .common import table
from .registry import ORACLE, QUERIES, register  # noqa: F401


@register("op9_quality_divergence", oracle.QUALITY)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents."""
    return quality_rules.quality_report(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@register("op2_hypergeometric_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 16 shards with row counts at most one apart."""
    return sharding.shard_documents(table(spark, sf_dir, "documents", "doc_id", "text"), 16)


@register("op10_warc_revisits", """
WITH p AS (SELECT page_id, CASE WHEN html IS NULL THEN '' ELSE html END AS body FROM pages),
h AS (SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
             sha256(encode(body)) AS payload_digest FROM p),
g AS (SELECT payload_digest, min(page_id) AS original FROM h WHERE payload_bytes >= 100
      GROUP BY payload_digest HAVING count(*) > 1)
SELECT h.page_id, h.payload_bytes, h.payload_digest,
       CASE WHEN g.original IS NOT NULL AND h.page_id <> g.original THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.original IS NOT NULL AND h.page_id <> g.original THEN g.original END AS refers_to
FROM h LEFT JOIN g ON h.payload_digest = g.payload_digest
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A WARC record per page, read back."""
    return warc.archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


@register("op4_chat_fingerprints", r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## ') AS et,
  replace(replace(replace(replace(role, '\', '\\'), '</turn>', '<\/turn>'), '### ', '#\## '), ': ', ':\ ') AS er
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  CAST(sum(4 + length(er) + 2 + length(et) + 8) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one with the template's own markers in its texts."""
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)],
                                  "conv_id bigint, turn bigint, role string, text string")
    return chat_format.chat_report(rows.unionByName(probe))


@register("op6_bpe_distinct_words")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded by the public 50k ranks and decoded again."""
    import public_tokenizers
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip_report(table(spark, sf_dir, "documents", "doc_id", "text"), ranks)


@register("op5_compression_language")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document by zstandard dictionaries."""
    return language_id.language_report(table(spark, sf_dir, "documents", "doc_id", "text", "lang"))


@register("op1_separator_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document from flat files with separator 50256."""
    import public_tokenizers
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return token_files.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), ranks,
                                    public_tokenizers.PATTERN, 50256)


@register("op8_jaccard_bitmap_join", oracle.JACCARD)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all documents at Jaccard 0.75 on five-word shingles."""
    return ngram_jaccard.jaccard_components(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op7_gear_chunk_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents that repeat a passage kept elsewhere."""
    return substring_dedup.repeat_report(table(spark, sf_dir, "documents", "doc_id", "text"))


@register("op3_template_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark."""
    return decontaminate.contaminated_pairs(table(spark, sf_dir, "documents", "doc_id", "text"),
                                            table(spark, sf_dir, "benchmark", "item_id", "text"))


@register("op11_reversed_search", oracle.SEARCH)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(table(spark, sf_dir, "documents", "doc_id", "text"),
                                 table(spark, sf_dir, "benchmark", "item_id", "text"))


@register("op12_auction_repair", oracle.REPAIR)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation damaged by its key's checksum and repaired at least cost."""
    return turn_repair.damage_and_repair(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


@register("op13_suffix_dedup")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes that a repeated 400-byte string covers."""
    return repeated_strings.remove_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
