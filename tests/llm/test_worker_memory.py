"""What scans and encoders take and leave behind in a Python worker."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa
import pytest

from ratelens.llm import bpe, pretokens, wordscan

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_scans_stay_small():
    texts = pa.array([" ".join(f"w{i}x{k}" for i in range(600)) for k in range(1200)])
    size = sum(map(len, texts.to_pylist()))
    assert size > 4_000_000
    pretokens.powers.cache_clear()
    tracemalloc.start()
    try:
        sets = sum(len(wordscan.shingle_sets(data, bounds)) for _, _, data, bounds in wordscan.text_steps(texts))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sets == 1200 and most < 10 * size


def test_encoders_leave_no_tables_in_workers(spark):
    def left(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pretokens.powers.cache_info().currsize] * batch.num_rows)], names=["n"])

    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(64)], "doc_id bigint, text string").repartition(8)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert bpe.round_trip_report(docs, ranks).count() == 64
    bpe.encode_texts(docs, ranks).collect()
    found = spark.range(64).repartition(8).mapInArrow(left, "n bigint").collect()
    assert {r.n for r in found} == {0}
