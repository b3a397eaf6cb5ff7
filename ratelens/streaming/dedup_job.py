"""L01, exact variant: cross-run URL dedup whose cost follows the batch.

The seen state is a table partitioned by the first hex digits of the key's hash,
``seen/prefix=<p>/batch=<id>``.  A micro-batch keeps the first arrival per key (a
``min_by`` aggregate, deterministic), reads the partitions of its own prefixes
only (at most ``16 ** PREFIX_DIGITS`` short strings, known before the scan, so they
reach it as partition filters), drops the keys seen by earlier batches and adds its own
keys.  Everything a batch writes is named by its id and it reads earlier
batches only, so a replay rewrites the same folders.  The watermark variant
(``pipeline.dedup_within_watermark``) trades exactness for bounded state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.topk import first_per_group

PREFIX_DIGITS = 2


def _prefix(key: str):
    return F.substring(F.sha2(F.col(key), 256), 1, PREFIX_DIGITS)


def seen_by_earlier(batch: DataFrame, root: str, key: str, batch_id: int) -> DataFrame:
    """Keys that batches before ``batch_id`` saw, from the partitions of the prefixes of
    ``batch``."""
    spark = batch.sparkSession
    schema = T.StructType([T.StructField(key, T.StringType()), T.StructField("prefix", T.StringType()),
                           T.StructField("batch", T.LongType())])
    try:
        seen = spark.read.schema(schema).parquet(f"{root}/seen")
    except AnalysisException as e:                  # no batch before this one
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    prefixes = [r[0] for r in batch.select(_prefix(key)).distinct().collect()]     # at most 16 ** PREFIX_DIGITS
    return seen.where(F.col("prefix").isin(prefixes) & (F.col("batch") < batch_id))


def exact_dedup_writer(root: str, key: str, order: Sequence[str], cols: Sequence[str]):
    """``foreachBatch`` function: rows of keys that no earlier batch had go to
    ``out/batch=<id>``, their keys to the seen table."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        firsts = first_per_group(batch.where(F.col(key).isNotNull()), [key], list(order), [c for c in cols if c != key])
        out = f"{root}/out/batch={batch_id}"
        firsts.join(seen_by_earlier(batch, root, key, batch_id).select(key), key, "left_anti") \
            .write.mode("overwrite").parquet(out)
        keys = spark.read.parquet(out).select(key, _prefix(key).alias("prefix"), F.lit(batch_id).alias("batch"))
        (keys.repartition("prefix").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("prefix", "batch").parquet(f"{root}/seen"))
    return run
