"""The dictionary sample where most rows are copies."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratelens.llm import language_id


def test_copies_do_not_thin_the_sample(spark):
    texts = [f"sample text {w} of many copies" for w in ("alpha", "beta", "gamma", "delta", "epsilon", "zeta")]
    rows = spark.range(30_000).select(
        F.element_at(F.array(*map(F.lit, texts)), (F.col("id") % 6 + 1).cast("int")).alias("text"), F.lit("en").alias("lang"))
    got = language_id.fit_dictionaries(rows)["en"].decode()
    assert sorted(got.split("\n")) == sorted(texts)
