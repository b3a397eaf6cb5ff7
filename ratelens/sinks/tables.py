"""Sinks over Parquet / JSON / CSV directories.

Parquet tables are directories.  A table being rewritten is never overwritten
in place: every rewrite goes to a fresh snapshot directory and the caller
swaps its pointer (the returned path), so readers of the old snapshot and
retried jobs are never broken by a half-written overwrite.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import conform


def unique_suffix() -> str:
    return uuid.uuid4().hex[:12]


def dedupe_on_key(incoming: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep one row per key, deterministically: the last by ``order`` (e.g. an
    arrival timestamp), then by the full row as a total tiebreak.  A
    ``max_by`` aggregate, so duplicates of a hot key are combined map-side
    instead of being sorted in one task."""
    rest = [c for c in incoming.columns if c not in keys]
    if not rest:
        return incoming.dropDuplicates(list(keys))
    tiebreak = [c for c in order] + [c for c in rest if c not in order]
    pick = F.max_by(F.struct(*[F.col(c) for c in rest]),
                    F.struct(*[F.col(c) for c in tiebreak]))
    return incoming.groupBy(*keys).agg(pick.alias("_v")).select(
        *keys, *[F.col(f"_v.{c}").alias(c) for c in rest]).select(*incoming.columns)


def upsert(target: DataFrame, incoming: DataFrame, keys: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Rows of ``target`` whose key is not in ``incoming``, plus the
    (key-deduplicated) incoming rows.  Key-only tables (every column a key)
    simply insert the absent keys.  An empty incoming batch returns the
    target unchanged.  Null keys never match (same as SQL IN)."""
    keys = list(keys)
    inc = dedupe_on_key(incoming, keys, order) if set(incoming.columns) - set(keys) else \
        incoming.dropDuplicates(keys)
    kept = target.join(inc.select(*keys), keys, "left_anti")
    return kept.unionByName(inc.select(*target.columns))


def write_snapshot(df: DataFrame, root: str, table: str | None = None,
                   partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` (cast to the registry type of ``table`` if given, K09) as
    a new snapshot directory under ``root`` and return its path."""
    out = conform(df, table) if table else df
    path = f"{root.rstrip('/')}/snapshot-{unique_suffix()}"
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def append_results(results: DataFrame, path: str) -> None:
    """Add a run's results in partitions of its own (date and time of the
    run).  Only those partitions are replaced, so a retried run leaves one copy
    and other runs stay."""
    run = F.concat(F.lit("r"), F.date_format("computed_at", "yyyyMMddHHmmss"))
    (results.withColumn("run_key", run).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("run_date", "run_key").parquet(path))


def write_raw_batch(articles: DataFrame, path: str, run_ts_col: str = "run_ts") -> None:
    """Raw landing of a run's articles as JSON lines, one folder per run; a
    retried run replaces its own folder."""
    (articles.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(run_ts_col).json(path))


def write_dead_letter(rows: DataFrame, path: str, run_key: str) -> None:
    """Failed records (article + error) as JSON lines in the folder of the run;
    a retried run replaces its own folder, other runs stay."""
    rows.write.mode("overwrite").json(f"{path.rstrip('/')}/run_key={run_key}")


#: Formats of times in exports, for the writer and for readers of them.
CSV_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
             "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def export_csv(df: DataFrame, path: str) -> bool:
    """CSV export of exactly the given frame.  Returns False ('no data')
    when the frame is empty, without writing.  Times keep their microseconds."""
    if df.isEmpty():
        return False
    df.write.mode("errorifexists").option("header", True).options(**CSV_TIMES).csv(path)
    return True


def write_month_partitioned(articles: DataFrame, path: str, run_key: str, ts: str = "published") -> None:
    """Article fact partitioned by publication month, and within a month by the
    run that wrote it; reads that filter on ``published_month`` prune partitions.  A
    retried run replaces its own partitions, other runs of the month stay."""
    (articles.withColumn("published_month", F.date_format(ts, "yyyy-MM")).withColumn("run_key", F.lit(f"r{run_key}"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("published_month", "run_key").parquet(path))


def kept_partitions(table: DataFrame, column: str, days: int) -> DataFrame:
    """K08 on a table partitioned by a date: the partitions within ``days`` of the
    newest one.  The bound is one scalar of the partition values, so the scan lists
    the kept partitions only; expired folders can be dropped whole."""
    newest = table.agg(F.max(column)).first()[0]
    if newest is None:
        return table
    return table.where(F.col(column) >= F.date_sub(F.lit(newest), days))


def retention_keep(df: DataFrame, ts: str, days: int, now: str | None = None) -> DataFrame:
    """Rows within ``days`` of ``now`` (default: the newest ``ts`` in the
    data, as a scalar subquery -- evaluated once, no join)."""
    newest = F.to_timestamp(F.lit(now)) if now is not None else df.agg(F.max(ts)).scalar()
    return df.where(F.col(ts) >= newest - F.expr(f"INTERVAL {days} DAYS"))
