"""Q09: the article run as one replay-safe job.

One micro-batch of raw articles is parsed, reduced to unseen ones, put behind the
queued backlog, cut to what each run day's budget leaves, tagged once, validated, and
written as facts, both bridges, sources, dead letters, the remaining queue, the day's
calls and the seen keys.  Every table is a folder per batch, and a batch counts only
when its commit mark is there, which is written last: readers (``committed``) leave
out batches without one, so a run that stops between two tables shows none of them.
The replay overwrites what was left behind; a replay of a committed batch does
nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import DAILY_EXTRACTION_BUDGET
from ..operators import queue as qu
from ..operators import tagging as tg
from ..operators.topk import first_per_group
from ..schema import RAW_ARTICLE
from .dedup_job import PREFIX_DIGITS

QUEUED = T.StructType([T.StructField("article_id", T.StringType()), T.StructField("published_at", T.TimestampType()),
                       T.StructField("run_day", T.DateType()), *RAW_ARTICLE.fields])
CALLS = T.StructType([T.StructField("date_key", T.StringType()), T.StructField("calls_used", T.IntegerType())])
SEEN = T.StructType([T.StructField("article_id", T.StringType()), T.StructField("prefix", T.StringType())])
_BATCH = T.StructField("batch", T.LongType())
_MARK = T.StructType([T.StructField("rows", T.LongType())])


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(T.StructType([*schema.fields, _BATCH])).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], T.StructType([*schema.fields, _BATCH]))


def committed(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None,
              before: int | None = None) -> DataFrame:
    """Rows of a table from committed batches (those before one, if given).  Batches are
    folders, so the marks prune what is listed."""
    marks = _read(spark, f"{root}/commits", _MARK).select("batch")
    if before is not None:
        marks = marks.where(F.col("batch") < before)
    rows = spark.read.parquet(f"{root}/{table}") if schema is None else _read(spark, f"{root}/{table}", schema)
    return rows.join(F.broadcast(marks), "batch", "left_semi")      # one short row per run


def parse_articles(raw: DataFrame) -> DataFrame:
    """Raw articles with ``article_id`` (hash of the URL), parsed publish time and run day;
    those without a URL are dropped (they are dead letters of the landing)."""
    names = [f.name for f in RAW_ARTICLE.fields]
    rows = raw.where(F.coalesce("url", F.lit("")) != "").select(
        *[F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names])
    rows = rows.withColumn("published_at", tg.parse_published(F.col("published")))
    return rows.withColumn("article_id", qu.url_hash(F.col("url"))).withColumn(
        "run_day", F.to_date("published_at")).select(*QUEUED.names)


def article_writer(root: str, tagger: Callable[[DataFrame], DataFrame], countries: DataFrame, sectors: Sequence[str],
                   budget: int = DAILY_EXTRACTION_BUDGET, stop_after: str | None = None):
    """``foreachBatch`` function over raw articles.  ``tagger`` gives (article_id, tags) of
    rows (article_id, raw_text).  ``stop_after`` names a table behind which the run fails (for tests)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _read(spark, f"{root}/commits", _MARK).where(F.col("batch") == batch_id).limit(1).count():
            return

        def put(df: DataFrame, table: str) -> DataFrame:
            path = f"{root}/{table}/batch={batch_id}"
            df.write.mode("overwrite").parquet(path)
            if table == stop_after:
                raise RuntimeError(f"stopped after {table}")
            return spark.read.schema(df.schema).parquet(path)

        # unseen articles, first arrival per URL: both by article_id in one go, so texts are
        # shuffled once
        parsed = parse_articles(batch)
        prefix = F.substring("article_id", 1, PREFIX_DIGITS)
        prefixes = [r[0] for r in parsed.select(prefix).distinct().collect()]   # at most 16 ** PREFIX_DIGITS
        seen = committed(spark, root, "seen", SEEN, batch_id).where(F.col("prefix").isin(prefixes))
        firsts = first_per_group(parsed, ["article_id"], ["published_at", "title", "raw_text"],
                                 [c for c in QUEUED.names if c != "article_id"]).select(*QUEUED.names)
        new = put(qu.unseen(firsts, seen, "article_id"), "arrived")
        # the backlog goes first, within each day's budget; decided without the texts
        last = committed(spark, root, "commits", _MARK, batch_id).agg(F.max("batch")).first()[0]
        backlog = committed(spark, root, "queue", QUEUED, batch_id).where(F.col("batch") == F.lit(last)).drop("batch")
        rows = qu.candidates(backlog.drop("raw_text"), new.drop("raw_text"), "article_id").withColumn(
            "queued_at", F.col("published_at"))
        used = committed(spark, root, "calls", CALLS, batch_id).groupBy("date_key").agg(
            F.sum("calls_used").cast("int").alias("calls_used"))
        sliced = put(qu.budget_slice(rows, used, budget).select(
            *[c for c in QUEUED.names if c != "raw_text"], "prio", "processed"), "sliced")
        # texts are tagged once; everything else reads the payloads.  Unseen articles are not in
        # the backlog, whose articles were all seen.
        due = sliced.where("processed").drop("processed", "prio")
        texts = backlog.select(*QUEUED.names).unionByName(new.select(*QUEUED.names))
        ids = F.broadcast(due.select("article_id"))             # at most the budget of each day
        payloads = put(tagger(texts.join(ids, "article_id", "left_semi").select("article_id", "raw_text")).select(
            "article_id", tg.tag_json(F.col("tags")).alias("payload")), "payloads")
        tagged = due.join(payloads, "article_id")
        checked = put(tg.validate(tagged, "payload", "article_id", countries, sectors), "checked")
        ok, dead = tg.split_ok_dead(checked)
        star = tg.to_star_rows(ok, "article_id")
        about = ok.select("article_id", F.date_format("published_at", "yyyy-MM-dd").alias("date_key"),
                          F.col("source").alias("source_id"), F.col("url").alias("source_url"), "title",
                          F.col("published_at").alias("published"))
        put(star["fact_article"].join(about, "article_id"), "fact_article")
        put(star["bridge_article_country"], "bridge_article_country")
        put(star["bridge_article_sector"], "bridge_article_sector")
        put(ok.where("source <> ''").select(F.col("source").alias("source_id")).distinct(), "dim_source")
        put(dead.select("article_id", "url", "payload", "error"), "dead_letter")
        put(texts.join(ids, "article_id", "left_anti"), "queue")
        put(qu.daily_calls(sliced).select(*CALLS.names), "calls")
        put(new.select("article_id", prefix.alias("prefix")), "seen")
        put(sliced.agg(F.count(F.lit(1)).alias("rows")), "commits")
    return run
