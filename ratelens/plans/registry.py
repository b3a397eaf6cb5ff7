"""Registry of named queries (driver contract) and their oracle SQL.

Each entry maps ``<inventory id>_<slug>`` to a callable ``(spark, sf_dir) ->
DataFrame``.  ``finish`` normalises output types so two engines agree:
doubles rounded half-up to 6 decimals by ``round_half_up`` (and -0.0
folded into 0.0), integral columns as BIGINT.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import OUT_DECIMALS
from ..functions.scalar import round_half_up

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _session_contract(spark: SparkSession) -> None:
    """Queries assume a UTC session time zone (day and month buckets, parsed
    instants) and a checkpoint folder; set them on whatever session runs the
    query."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)


def register(name: str, oracle: str | Callable[[], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            _session_contract(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle() if callable(oracle) else oracle
        return fn
    return deco


def finish(df: DataFrame, decimals: int = OUT_DECIMALS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = round_half_up(c.cast("double"), decimals)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            c = c.cast("bigint")
        cols.append(c.alias(f.name))
    return df.select(cols)
