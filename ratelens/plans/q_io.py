"""Registered queries of streaming jobs (L01-L06) and sources / sinks (S09,
S11, K03, K06-K08), each written to and read back from the shared scratch
folder."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panel as pn
from ..operators import queue as qu
from ..schema import empty
from ..sinks import tables as sink
from ..sources import driver
from ..sources import tpch_star as ts
from ..streaming import pipeline as sp
from . import oracle as O
from .correlation import correlation_batch
from .q_articles import _used
from .registry import finish, register
from .star import Star

RETENTION_DAYS = 7


def _events_stream(spark: SparkSession, sf: str) -> DataFrame:
    # the landed folder holds one file per table; a glob selects the events files
    return sp.landed_stream(spark, f"{sf.rstrip('/')}/events*.parquet", sp.EVENTS_SCHEMA)


@register("l01_stream_dedup", lambda: O.with_ctes(
    "SELECT sha256(source_url) AS url_hash, article_id FROM s_articles", "s_articles"))
def l01(spark: SparkSession, sf: str) -> DataFrame:
    """Continuous ingest with URL dedup (bounded watermark state)."""
    arts = ts.articles_from_events(_events_stream(spark, sf)).withColumn(
        "url_hash", qu.url_hash(F.col("source_url")))
    out, ckpt = sp.scratch(spark, "l01")
    sp.run_available_now(sp.dedup_within_watermark(arts.select("url_hash", "article_id", "published"),
                                                   ["url_hash"], "published"), out, ckpt)
    return finish(spark.read.parquet(out).select("url_hash", "article_id"))


@register("l02_file_discovery", "SELECT CAST(2 AS BIGINT) AS runs, count(*) AS n_rows FROM events")
def l02(spark: SparkSession, sf: str) -> DataFrame:
    """Two scheduled runs over the same landed folder and checkpoint: the
    second discovers no new file, so every event lands exactly once."""
    out, ckpt = sp.scratch(spark, "l02")
    for _ in range(2):
        sp.run_available_now(_events_stream(spark, sf).select("event_id", "ts"), out, ckpt)
    n = spark.read.parquet(out).agg(F.count(F.lit(1)).alias("n_rows"))
    return finish(n.select(F.lit(2).alias("runs"), "n_rows"))


@register("l03_budget_stream", lambda: O.with_ctes("""
SELECT article_id, run_day, slot_all <= remaining AS processed FROM s_slice""", "s_slice"))
def l03(spark: SparkSession, sf: str) -> DataFrame:
    """Work queue with a daily budget that holds over micro-batches: calls made before
    the run are in the budget table, each batch takes what is left of a day."""
    out, ckpt = sp.scratch(spark, "l03")

    def candidates(batch: DataFrame) -> DataFrame:
        return ts.articles_from_events(batch).select(
            "article_id", "source_url", F.to_date("published").alias("run_day"),
            F.col("published").alias("queued_at"), F.lit(0).alias("prio"))
    before = _used(candidates(driver.read(spark, sf, "events", *sp.EVENTS_SCHEMA.names)))
    sp.record_calls(before.select("date_key", F.col("calls_used").cast("int").alias("calls_used")), out, -1)
    sp.run_foreach_batch(_events_stream(spark, sf), sp.budget_writer(out, candidates), ckpt)
    return finish(spark.read.parquet(f"{out}/rows").select("article_id", "run_day", "processed"))


@register("l04_idempotent_batches", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1""")
def l04(spark: SparkSession, sf: str) -> DataFrame:
    """At-least-once delivery made idempotent: the batch writer is invoked a
    second time for the same batch id (a replay) and the result is
    unchanged."""
    out, ckpt = sp.scratch(spark, "l04")
    writer = sp.idempotent_writer(out, lambda b: b.select("event_id", F.to_date("ts").alias("day")))

    def twice(batch: DataFrame, batch_id: int) -> None:
        writer(batch, batch_id)
        writer(batch, batch_id)  # replay after a simulated failure
    sp.run_foreach_batch(_events_stream(spark, sf), twice, ckpt)
    back = spark.read.parquet(out)
    return finish(back.groupBy("day").agg(F.count(F.lit(1)).alias("n")))


@register("l06_daily_window_stream", """
SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n
FROM events GROUP BY 1, 2""")
def l06(spark: SparkSession, sf: str) -> DataFrame:
    """Event-time day buckets per event type in update mode: each micro-batch
    writes the days it changed; readers take the latest value per day."""
    out, ckpt = sp.scratch(spark, "l06")
    agg = sp.daily_buckets(_events_stream(spark, sf), "ts", ["event_type"], delay="1 day")
    sp.run_update_batches(agg, out, ckpt)
    return finish(sp.latest_rows(spark, out, ["day", "event_type"]))


@register("l05_ordered_refresh", lambda: O.with_ctes(
    O.correlate_sql("s_leads") + "\nSELECT country_code, sector_id, rate_basis, target_variable, "
    "CAST(lag AS BIGINT) AS lag, control_set FROM result", "s_leads"))
def l05(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly refresh in order: ingest (macro, market facts written as
    snapshots) then analysis reading those snapshots, results appended."""
    star = Star(spark, sf)
    root = sp.scratch(spark, "l05")[0]
    macro = sink.write_snapshot(star.fact_macro_indicator, f"{root}/fact_macro_indicator")
    price = sink.write_snapshot(star.fact_commodity_price, f"{root}/fact_commodity_price")
    val = sink.write_snapshot(star.fact_equity_valuation, f"{root}/fact_equity_valuation")
    landed = star.with_facts(spark.read.parquet(macro),
                             pn.combine_market(spark.read.parquet(price), spark.read.parquet(val)))
    from ..operators import correlate as co
    res = co.result_rows(correlation_batch(landed), "refresh", "2024-03-03 08:00:00")
    sink.append_results(res, f"{root}/fact_correlation_result")
    back = spark.read.parquet(f"{root}/fact_correlation_result")
    return finish(back.select("country_code", "sector_id", "rate_basis", "target_variable", "lag",
                              "control_set"))


@register("k03_raw_landing", lambda: O.with_ctes(
    "SELECT strftime(day, '%Y%m%d') AS run_ts, count(*) AS n FROM s_articles GROUP BY 1",
    "s_articles"))
def k03(spark: SparkSession, sf: str) -> DataFrame:
    """Raw landing: one JSON folder per run (here: per publication day)."""
    f = Star(spark, sf).fact_article
    path = sp.scratch(spark, "k03")[0]
    raw = f.select(F.col("source_url").alias("url"), "title",
                   F.date_format("published", "yyyy-MM-dd'T'HH:mm:ss").alias("published"),
                   F.col("source_id").alias("source"), F.col("article_category").alias("category"),
                   F.lit("").alias("raw_text"),
                   F.date_format("published", "yyyyMMdd").alias("run_ts"))
    sink.write_raw_batch(raw, path)
    back = spark.read.schema("url string, run_ts string").json(path)
    return finish(back.groupBy("run_ts").agg(F.count(F.lit(1)).alias("n")))


@register("k06_csv_export", lambda: O.with_ctes(
    "SELECT title, article_category, " + O.r6("sentiment_score", "sentiment_score")
    + ", source_url FROM s_articles WHERE article_category = 'monetary_policy'", "s_articles"))
def k06(spark: SparkSession, sf: str) -> DataFrame:
    """CSV export of exactly the filtered frame, read back."""
    f = Star(spark, sf).fact_article.where(F.col("article_category") == "monetary_policy")
    path = sp.scratch(spark, "k06")[0]
    wrote = sink.export_csv(f.select("title", "article_category", "sentiment_score", "source_url"),
                            path)
    if not wrote:
        return finish(empty(spark, "fact_article").select("title", "article_category",
                                                          "sentiment_score", "source_url"))
    back = (spark.read.option("header", True)
            .schema("title string, article_category string, sentiment_score double, source_url string")
            .csv(path))
    return finish(back)


@register("k07_month_partitioned", lambda: O.with_ctes(
    "SELECT strftime(published, '%Y-%m') AS published_month, article_category, count(*) AS n "
    "FROM s_articles GROUP BY 1, 2", "s_articles"))
def k07(spark: SparkSession, sf: str) -> DataFrame:
    f = Star(spark, sf).fact_article
    path = sp.scratch(spark, "k07")[0]
    for _ in range(2):      # a retried run leaves one copy
        sink.write_month_partitioned(f.select("article_id", "article_category", "published"), path, "20240303")
    back = spark.read.parquet(path)
    return finish(back.groupBy("published_month", "article_category")
                  .agg(F.count(F.lit(1)).alias("n")))


@register("k08_retention", lambda: O.with_ctes(f"""
SELECT day, count(*) AS n FROM s_articles
WHERE published >= (SELECT max(published) FROM s_articles) - INTERVAL {RETENTION_DAYS} DAY
GROUP BY 1""", "s_articles"))
def k08(spark: SparkSession, sf: str) -> DataFrame:
    """Rolling retention of the raw cache, landed by day: expired days are never listed,
    the day of the bound is cut by time."""
    f = Star(spark, sf).fact_article.select("article_id", "published", F.to_date("published").alias("day"))
    path = sp.scratch(spark, "k08")[0]
    f.write.partitionBy("day").parquet(path)
    near = sink.kept_partitions(spark.read.parquet(path), "day", RETENTION_DAYS)
    kept = sink.retention_keep(near, "published", RETENTION_DAYS)
    return finish(kept.groupBy("day").agg(F.count(F.lit(1)).alias("n")))


@register("s09_param_sql", """
SELECT o_orderpriority, count(*) AS n, """ + O.r6("avg(o_totalprice)", "avg_price") + """
FROM orders WHERE o_orderstatus = 'F' AND o_orderdate >= DATE '1997-01-01' GROUP BY 1""")
def s09(spark: SparkSession, sf: str) -> DataFrame:
    """Ad-hoc SQL over the tables with named parameters (no string
    interpolation of values)."""
    driver.register_views(spark, sf, ["orders"])
    df = spark.sql("SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS avg_price "
                   "FROM orders WHERE o_orderstatus = :status AND o_orderdate >= CAST(:since AS DATE) "
                   "GROUP BY o_orderpriority",
                   args={"status": "F", "since": "1997-01-01"})
    return finish(df)


@register("s11_seed_dimensions", lambda: O.with_ctes(
    "SELECT country_code, country_name, region FROM s_dim_country", "s_dim_country"))
def s11(spark: SparkSession, sf: str) -> DataFrame:
    """Seed the country dimension: upsert into the (empty) table, twice --
    idempotent."""
    star = Star(spark, sf)
    t = empty(spark, "dim_country")
    once = sink.upsert(t, star.dim_country, ["country_code"])
    twice = sink.upsert(once, star.dim_country, ["country_code"])
    return finish(twice)


@register("l03_queue_carryover", lambda: O.with_ctes("""
, ranked AS (SELECT article_id, day, row_number() OVER (ORDER BY published, article_id) AS rn
             FROM s_articles),
ndays AS (SELECT count(DISTINCT day) AS d FROM s_articles)
SELECT article_id FROM ranked, ndays WHERE rn <= 15 * d""", "s_articles"))
def l03b(spark: SparkSession, sf: str) -> DataFrame:
    """Work queue with a daily budget carried across runs: a day's events are landed,
    then a run streams what is new, processes the oldest queued articles first
    within its budget and queues the rest."""
    from ..streaming import queue_job as qj
    ev = driver.read(spark, sf, "events", *sp.EVENTS_SCHEMA.names)
    by_day = sp.scratch(spark, "l03-days")[0]
    ev.withColumn("day", F.to_date("ts")).write.partitionBy("day").parquet(by_day)
    archive = spark.read.parquet(by_day)
    landed_dir, root, ckpt = sp.scratch(spark, "l03-landed")[0], *sp.scratch(spark, "l03-state")
    first, last = archive.agg(F.min("day"), F.max("day")).first()
    for k in range((last - first).days + 1 if first else 0):
        day = first + timedelta(days=k)
        archive.where(F.col("day") == F.lit(day)).select(*sp.EVENTS_SCHEMA.names).write.parquet(f"{landed_dir}/day={day}")
        stream = sp.landed_stream(spark, f"{landed_dir}/day=*", sp.EVENTS_SCHEMA)
        arts = ts.articles_from_events(stream).select("article_id", "source_url", "published")
        sp.run_foreach_batch(arts, qj.queue_writer(root), ckpt)
    return finish(spark.read.parquet(f"{root}/processed").select("article_id"))


@register("l01_exact_dedup_state", lambda: O.with_ctes(
    "SELECT sha256(source_url) AS url_hash, article_id FROM s_articles", "s_articles"))
def l01b(spark: SparkSession, sf: str) -> DataFrame:
    """Exact cross-run URL dedup: two deliveries are landed, each with some articles
    twice, and streamed one per micro-batch; a batch looks its keys up in its own
    part of the seen table, so the second delivery adds nothing."""
    from ..streaming import dedup_job as dj
    ev = driver.read(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    landed_dir = sp.scratch(spark, "l01-landed")[0]
    root, ckpt = sp.scratch(spark, "l01-state")
    for copy in ("a", "b"):  # a delivery, then a run over what is new
        ev.unionByName(ev.where(F.col("event_id") % 3 == 0)).write.parquet(f"{landed_dir}/copy={copy}")
        stream = sp.landed_stream(spark, f"{landed_dir}/copy=*", sp.EVENTS_SCHEMA)
        arts = ts.articles_from_events(stream).select(
            qu.url_hash(F.col("source_url")).alias("url_hash"), "article_id", "published")
        sp.run_foreach_batch(arts, dj.exact_dedup_writer(root, "url_hash", ["published", "article_id"],
                                                         ["url_hash", "article_id"]), ckpt)
    return finish(spark.read.parquet(f"{root}/out").select("url_hash", "article_id"))
