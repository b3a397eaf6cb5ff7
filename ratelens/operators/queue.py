"""News pipeline bookkeeping: dedup state, work queue with a daily budget,
source health (S01, J05-J07, U02, T04, G20-G22, G29, K04, W10, W11, F01)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import DAILY_EXTRACTION_BUDGET, STALE_AFTER_CONSECUTIVE_EMPTY
from .topk import first_per_group, top_k_per_group


def url_hash(url: Column) -> Column:
    """SHA-256 hex of the URL (content-derived id, retry-safe)."""
    return F.sha2(url, 256)


def active_sources(catalogue: DataFrame) -> DataFrame:
    """The catalogue's active sources."""
    return catalogue.where(F.col("status") == "active")


def unseen(incoming: DataFrame, seen: DataFrame, key: str = "url_hash") -> DataFrame:
    """Incoming rows whose key is not in the seen-state table."""
    return incoming.join(seen.select(key), key, "left_anti")


def seen_state(articles: DataFrame, key: str = "url_hash", run: str = "run_day") -> DataFrame:
    """Dedup state as a keyed table: key -> first run that saw it."""
    return articles.groupBy(key).agg(F.min(run).alias("first_seen"))


def not_in_backlog(new: DataFrame, backlog: DataFrame, key: str = "source_url") -> DataFrame:
    """New articles not already queued (anti join on the URL)."""
    return new.join(backlog.select(key), key, "left_anti")


def delete_keys(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the given key set (null keys never
    match, as with SQL IN)."""
    return table.join(keys.select(key).where(F.col(key).isNotNull()), key, "left_anti")


def candidates(backlog: DataFrame, new: DataFrame, key: str = "source_url") -> DataFrame:
    """Backlog first (priority 0), then new articles not in the backlog
    (priority 1)."""
    return (backlog.withColumn("prio", F.lit(0))
            .unionByName(not_in_backlog(new, backlog, key).withColumn("prio", F.lit(1))))


def budget_slice(cands: DataFrame, used: DataFrame | None = None,
                 budget: int = DAILY_EXTRACTION_BUDGET, day: str = "run_day",
                 order: Sequence[str] = ("prio", "queued_at", "article_id")) -> DataFrame:
    """Per run day, the first ``budget - used`` candidates in FIFO order
    are processed, the rest stay queued.  Adds ``processed`` (bool) and
    ``slot`` (1-based position when processed).

    Per-day top-k with a salted first phase, so a day holding a large share
    of the backlog is never sorted in one task.  Its rows, at most ``budget`` a day, are
    broadcast to mark the candidates, which are not shuffled for it."""
    remaining = F.greatest(F.lit(budget) - F.coalesce(F.col("calls_used"), F.lit(0)), F.lit(0))
    c = cands
    if used is not None:
        c = c.join(used.select(F.col("date_key").alias("_d"), "calls_used"),
                   F.date_format(F.col(day), "yyyy-MM-dd") == F.col("_d"), "left").drop("_d")
    else:
        c = c.withColumn("calls_used", F.lit(0))
    c = c.withColumn("_remaining", remaining)
    top = top_k_per_group(c, [day], [F.col(x).asc() for x in order], budget, unique="article_id",
                          rank_col="slot")
    done = top.where(F.col("slot") <= F.col("_remaining")).select("article_id", "slot")
    return (c.join(F.broadcast(done), "article_id", "left")
            .withColumn("processed", F.col("slot").isNotNull())
            .drop("_remaining"))


def daily_calls(sliced: DataFrame, day: str = "run_day") -> DataFrame:
    """Model calls per day = processed attempts, successes and failures
    alike."""
    return (sliced.where("processed").groupBy(F.date_format(day, "yyyy-MM-dd").alias("date_key"))
            .agg(F.count(F.lit(1)).cast("int").alias("calls_used")))


def run_summary(sliced: DataFrame, failed: Column, day: str = "run_day") -> DataFrame:
    """Processed / failed / queued per run day in one conditional
    aggregate."""
    p = F.col("processed")
    return sliced.groupBy(F.col(day).alias("run_day")).agg(
        F.count(F.when(p & ~failed, 1)).alias("processed"),
        F.count(F.when(p & failed, 1)).alias("failed"),
        F.count(F.when(~p, 1)).alias("queued"))


def first_arrival(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """First row per key by arrival order (deterministic, unlike
    dropDuplicates)."""
    return first_per_group(df, [key], list(order), list(cols))


def source_counts(catalogue: DataFrame, articles: DataFrame, is_new: Column) -> DataFrame:
    """Per source: entries, new entries, health (a source with no entry
    is unhealthy).  The catalogue is the preserved side so silent sources show
    zeros."""
    per = articles.groupBy("source_id").agg(F.count(F.lit(1)).alias("entries"),
                                            F.count(F.when(is_new, 1)).alias("new_entries"))
    return (catalogue.select("source_id").join(per, "source_id", "left")
            .select("source_id", F.coalesce("entries", F.lit(0)).alias("entries"),
                    F.coalesce("new_entries", F.lit(0)).alias("new_entries"),
                    (F.coalesce("entries", F.lit(0)) > 0).alias("healthy")))


def feed_coverage(catalogue: DataFrame, articles: DataFrame, days: int = 7) -> DataFrame:
    """Share of catalogue sources with at least one item in the last
    ``days`` days (relative to the newest item)."""
    newest = articles.agg(F.max(F.to_date("published"))).scalar()  # scalar subquery
    recent = (articles.where(F.to_date("published") > F.date_sub(newest, days))
              .select("source_id").distinct().withColumn("_hit", F.lit(1)))
    cat = catalogue.select("source_id").join(recent, "source_id", "left")
    return cat.agg(F.count(F.lit(1)).alias("n_sources"),
                   F.count("_hit").alias("n_recent"),
                   (F.count("_hit") / F.count(F.lit(1))).alias("coverage"))


def stale_streaks(daily: DataFrame, source: str = "source_id", day: str = "day",
                  entries: str = "entries",
                  threshold: int = STALE_AFTER_CONSECUTIVE_EMPTY) -> DataFrame:
    """Consecutive empty fetches per source (gaps-and-islands: an island
    id is the running count of non-empty fetches).  Returns per source the
    longest streak, the current streak and ``stale`` (current >= threshold)."""
    run = (Window.partitionBy(source).orderBy(day)
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    d = daily.withColumn("_island", F.sum(F.when(F.col(entries) > 0, 1).otherwise(0)).over(run))
    wi = Window.partitionBy(source, "_island").orderBy(day)
    d = d.withColumn("streak", F.sum(F.when(F.col(entries) > 0, 0).otherwise(1)).over(
        wi.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = F.max_by("streak", day)
    return d.groupBy(source).agg(F.max("streak").alias("longest_streak"),
                                 last.alias("current_streak")) \
        .withColumn("stale", F.col("current_streak") >= threshold)
