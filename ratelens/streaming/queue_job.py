"""L03 with carry-over: the work queue and the daily call budget as state
tables across micro-batches.

Each micro-batch is one run: candidates are the queued backlog (oldest
first) followed by the batch's new articles not already queued (U02 + J06);
the first ``budget - used`` are processed (T04), the rest stay queued (J07 +
enqueue), and the day's calls are recorded (G21) in the table by day that all
budgeted jobs share (``pipeline.record_calls``).  The queue lives in per-batch
snapshot folders under the shared checkpoint folder: batch k reads the queue
written by batch k-1 and the calls of batches before k and writes its own, so a
replayed batch recomputes exactly the same folders (idempotent, survives executor
or driver loss).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DAILY_EXTRACTION_BUDGET
from ..operators import queue as qu
from .pipeline import calls_before, record_calls

QUEUE = T.StructType([T.StructField("article_id", T.StringType()),
                      T.StructField("source_url", T.StringType()),
                      T.StructField("queued_at", T.TimestampType())])


def _state(spark: SparkSession, root: str, name: str, batch_id: int, schema: T.StructType) -> DataFrame:
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/{name}/batch={batch_id}")


def newest_day(batch: DataFrame, batch_id: int) -> str | None:
    """The day of the newest article of a batch (None: no article)."""
    newest = batch.agg(F.max("published")).first()[0]
    return None if newest is None else newest.strftime("%Y-%m-%d")


def queue_writer(root: str, budget: int = DAILY_EXTRACTION_BUDGET, run_day_of=newest_day):
    """``foreachBatch`` function over article rows (article_id, source_url,
    published).  ``run_day_of(batch, batch_id)`` names the day whose budget the
    run spends -- a scheduler passes its own clock, so a batch without articles
    drains the backlog; by default the newest article tells, and an empty batch
    only carries the state on.  The calls already spent that day are one scalar
    read per batch; the slice is a top-k (``orderBy().limit(k)``, k <= budget)
    -- each task keeps its own k, never a global sort."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run_day = run_day_of(batch, batch_id)
        if run_day is None:
            _state(spark, root, "queue", batch_id - 1, QUEUE).write.mode("overwrite").parquet(
                f"{root}/queue/batch={batch_id}")
            return
        backlog = _state(spark, root, "queue", batch_id - 1, QUEUE)
        today = spark.range(1).select(F.lit(run_day).alias("date_key"))
        used = calls_before(today, root, batch_id).agg(F.sum("calls_used")).first()[0] or 0
        remaining = max(budget - int(used), 0)
        new = batch.select("article_id", "source_url", F.col("published").alias("queued_at"))
        cands = qu.candidates(backlog, new)                    # backlog first, then new
        done = (cands.orderBy("prio", "queued_at", "article_id").limit(remaining)
                .select("article_id", "queued_at", "prio",
                        F.to_date(F.lit(run_day)).alias("run_day")))
        done.write.mode("overwrite").parquet(f"{root}/processed/batch={batch_id}")
        done_ids = spark.read.parquet(f"{root}/processed/batch={batch_id}").select("article_id")
        queue_next = qu.delete_keys(cands.select("article_id", "source_url", "queued_at"),
                                    done_ids, "article_id")
        queue_next.write.mode("overwrite").parquet(f"{root}/queue/batch={batch_id}")
        record_calls(done_ids.agg(F.count(F.lit(1)).cast("int").alias("calls_used"))
                     .select(F.lit(run_day).alias("date_key"), "calls_used"), root, batch_id)
    return run
