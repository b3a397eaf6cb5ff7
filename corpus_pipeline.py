"""The corpus pipeline: five stages over ``documents``, each written as Parquet
and read back as the next one's input.

quality rules -> one document of each Jaccard component -> repeated passages
taken out -> documents that hold benchmark items removed -> token ids.

All stages but the last return the columns of ``documents``.  SQL cannot
express the content-defined chunks and the token merges, so there is no
``ORACLE_SQL``; the stages are tested against brute force instead.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ratelens.llm import bpe, decontaminate, ngram_jaccard, quality_rules, substring_dedup
from ratelens.llm.common import table, written
from ratelens.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that pass the quality rules."""
    return quality_rules.quality_filter(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: the smallest doc_id of every component of linked documents."""
    return ngram_jaccard.keep_one_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: texts without the passages that an earlier document keeps."""
    return substring_dedup.dedup_documents(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents without any item of the benchmark."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: doc_id, n_tokens, ids and the digests of the round trip."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.round_trip_report(docs, ranks, with_ids=True)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("benchmark decontamination", benchmark_leaks),
    ("byte-level BPE", token_ids),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
