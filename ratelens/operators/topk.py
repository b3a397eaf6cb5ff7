"""Top-k per group that survives a hot group.

``row_number() over (partition by key order by ...) <= k`` is planned with a
group limit before the exchange: every task keeps only its own top k of each
group, so the window behind the exchange sees at most k rows per (task, group)
however large a group is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                    unique: str | None = None, salt_buckets: int = 1, rank_col: str = "rank") -> DataFrame:
    """The first ``k`` rows of every group by ``order`` (make it total: include
    a unique id last).  With ``salt_buckets`` over 1 a group is first cut by a
    hash of ``unique`` and each part keeps its own top k -- of use only when
    even k rows per task and group are many."""
    if salt_buckets > 1:
        salted = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", F.pmod(F.xxhash64(F.col(unique)), F.lit(salt_buckets)))
              .withColumn("_r1", F.row_number().over(salted)).where(F.col("_r1") <= k).drop("_r1", "_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    value_cols: Sequence[str], last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``, then by the other values -- as
    the ``min`` / ``max`` of a struct, which combines map-side, instead of a window.
    Every column is in the struct once, so a text that is also ordered by is
    shuffled once."""
    names = [*dict.fromkeys([*order, *value_cols])]
    s = (F.max if last else F.min)(F.struct(*[F.col(c) for c in names]))
    return df.groupBy(*keys).agg(s.alias("_v")).select(*keys, *[F.col(f"_v.{c}").alias(c)
                                                                 for c in value_cols])
