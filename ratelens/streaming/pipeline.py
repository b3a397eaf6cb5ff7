"""Structured Streaming versions of the scheduled pipelines.

The analysed application runs scheduled pulls with state persisted between
runs.  Here each is a streaming query over a landed-file folder:

* L01  continuous ingest with URL dedup: watermark + dropDuplicatesWithinWatermark
       (bounded state); the exact unbounded variant is ``foreachBatch`` + anti
       join against the keyed seen-state table.
* L02  new-file discovery: the file source plus its checkpoint -- a rerun picks
       up only files not seen before.
* L03  work queue with a daily budget: ``foreachBatch`` running the budget
       slice on each micro-batch, the calls of a day kept in a table by day.
* L04  at-least-once delivery made idempotent: each micro-batch writes to a
       folder named by its batch id with overwrite, so a retried batch
       replaces its own output.
* L05  ordered refresh: stages run in order, each ``availableNow``.
* L06  event-time day buckets: ``window(ts, '1 day')`` with a watermark.

All queries use ``trigger(availableNow=True)``: process what has landed, then
stop -- the scheduled-run semantics, restartable from the checkpoint after an
executor or driver loss.  Checkpoints and sinks live under the shared folder
named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DAILY_EXTRACTION_BUDGET
from ..operators import queue as qu
from ..session import scratch_path
from ..sinks import tables as sink
from ..sources.landed import split_raw

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def landed_stream(spark: SparkSession, path: str, schema: T.StructType,
                  fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """A file-source stream over a landed folder (or glob) with a declared
    schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def dedup_within_watermark(df: DataFrame, key: Sequence[str], ts: str,
                           delay: str = "30 days") -> DataFrame:
    """Drop repeats of ``key`` seen within the watermark delay; state
    older than the watermark is evicted, so it stays bounded."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def daily_buckets(df: DataFrame, ts: str, keys: Sequence[str] = (), delay: str = "1 day") -> DataFrame:
    """Tumbling one-day event-time windows (append mode emits a day once
    the watermark passes it)."""
    return (df.withWatermark(ts, delay)
            .groupBy(F.window(ts, "1 day").alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.to_date(F.col("w.start")).alias("day"), *keys, "n"))


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      mode: str = "append", partition_by: Sequence[str] = ()) -> None:
    """Process everything landed so far and stop (restartable from the
    checkpoint)."""
    w = (df.writeStream.format(fmt).outputMode(mode).option("checkpointLocation", checkpoint)
         .option("path", sink_path).trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.start().awaitTermination()


def run_foreach_batch(df: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run ``fn(batch_df, batch_id)`` for every micro-batch until the landed
    data is consumed."""
    (df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())


def idempotent_writer(out_root: str, transform: Callable[[DataFrame], DataFrame]):
    """A ``foreachBatch`` function whose output folder is a function of
    the batch id, written with overwrite: replaying a batch after a failure
    rewrites exactly the same folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out_root}/batch={batch_id}")
    return write


CALLS = T.StructType([T.StructField("date_key", T.StringType()), T.StructField("calls_used", T.IntegerType()),
                      T.StructField("batch", T.LongType())])


def calls_before(days: DataFrame, root: str, batch_id: int) -> DataFrame:
    """(date_key, calls_used) that batches before ``batch_id`` spent on the given days
    (a ``date_key`` column); only the partitions of those days are read."""
    spark = days.sparkSession
    try:
        spent = spark.read.schema(CALLS).parquet(f"{root}/calls").where(F.col("batch") < batch_id)
    except AnalysisException as e:                  # no call was made yet
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        spent = spark.createDataFrame([], CALLS)
    return spent.join(F.broadcast(days.select("date_key").distinct()), "date_key", "left_semi") \
        .groupBy("date_key").agg(F.sum("calls_used").cast("int").alias("calls_used"))


def record_calls(calls: DataFrame, root: str, batch_id: int) -> None:
    """Write a batch's calls per day to its own partitions of the table
    ``calls/date_key=<day>/batch=<id>``, which all budgeted jobs share."""
    (calls.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date_key", "batch").parquet(f"{root}/calls"))


def budget_writer(out_root: str, candidates: Callable[[DataFrame], DataFrame], budget: int = DAILY_EXTRACTION_BUDGET):
    """The budgeted FIFO slice over micro-batches.  A batch sums what earlier batches
    spent on the days that it holds, takes the rest of each day's budget, and writes
    its rows and its own calls.  Both are functions of the batch id and of earlier
    batches, so a replay rewrites them alike, and an empty batch adds no calls."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = candidates(batch)
        used = calls_before(rows.select(F.date_format("run_day", "yyyy-MM-dd").alias("date_key")), out_root, batch_id)
        out = f"{out_root}/rows/batch={batch_id}"
        qu.budget_slice(rows, used, budget).select("article_id", "run_day", "processed").write.mode("overwrite").parquet(out)
        record_calls(qu.daily_calls(batch.sparkSession.read.parquet(out)), out_root, batch_id)
    return write


def raw_writer(out_root: str):
    """A ``foreachBatch`` function over ``landed.stream_raw_batches`` that
    feeds the article sink and the dead-letter sink from one pass over the batch; both
    folders are named by the batch id, so a replay leaves one copy in each."""
    def write(batch: DataFrame, batch_id: int) -> None:
        staged = f"{out_root}/records/batch={batch_id}"
        batch.write.mode("overwrite").parquet(staged)
        good, dead = split_raw(batch.sparkSession.read.schema(batch.schema).parquet(staged))
        good.write.mode("overwrite").parquet(f"{out_root}/articles/batch={batch_id}")
        sink.write_dead_letter(dead, f"{out_root}/dead_letters", f"batch-{batch_id}")
    return write


def run_update_batches(df: DataFrame, out_root: str, checkpoint: str) -> None:
    """Update-mode aggregation sink: every micro-batch writes its updated
    rows to its own folder (idempotent by batch id).  ``latest_rows`` reads
    the current value of every key."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
         .parquet(f"{out_root}/batch={batch_id}"))
    (df.writeStream.outputMode("update").foreachBatch(write)
     .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
     .awaitTermination())


def latest_rows(spark: SparkSession, out_root: str, keys: Sequence[str]) -> DataFrame:
    """Current state of an update-mode sink: per key, the row of the latest
    batch (a max_by aggregate, no global sort)."""
    df = spark.read.parquet(out_root)
    values = [c for c in df.columns if c not in set(keys) | {"_batch", "batch"}]
    latest = F.max_by(F.struct(*values), F.col("_batch"))
    return df.groupBy(*keys).agg(latest.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c)
                                                                   for c in values])


def scratch(spark: SparkSession, name: str) -> tuple[str, str]:
    """(sink path, checkpoint path) of a new run under the shared folder."""
    base = scratch_path(spark, f"{name}-{sink.unique_suffix()}")
    return f"{base}/out", f"{base}/_checkpoint"
