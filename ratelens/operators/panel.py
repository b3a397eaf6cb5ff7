"""Monthly panel per (country, sector) pair.

The panel of a pair has one row per month in which the country has at least
one non-null indicator change; market changes of the sector are left-joined on
the month (macro side preserved).  All pairs are built in one plan: the pair
list is configuration and is joined once to the wide macro table.

Partitioning: every window below is partitioned by the pair, so the lead /
time-index window and the moment aggregate downstream share one exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..constants import COUNTRY_INDICATORS, LAGS, TARGETS

PAIR = ["country_code", "sector_id"]


def macro_wide(macro_fact: DataFrame, indicators: Sequence[str] = COUNTRY_INDICATORS) -> DataFrame:
    """Long changes -> one row per (country, month), one column per
    indicator.  Null changes are dropped *before* the pivot, so a month whose
    changes are all null has no row (positional lags skip it) and an indicator
    that is all null is an all-null column.  The value list is given, so the
    pivot needs no extra job to discover it.  Global rows never enter."""
    src = macro_fact.where(F.col("country_code").isNotNull()
                           & F.col("value_change").isNotNull()
                           & F.col("indicator_id").isin(*indicators))
    return (src.groupBy("country_code", "month")
            .pivot("indicator_id", list(indicators))
            .agg(F.max("value_change")))  # one row per key: record_id is unique


def combine_market(price_fact: DataFrame, valuation_fact: DataFrame) -> DataFrame:
    """Stored price and valuation facts -> one (sector, month) frame with
    both changes (full outer join on the key)."""
    return (price_fact.select("sector_id", "month", "price_change")
            .join(valuation_fact.select("sector_id", "month", "valuation_change"),
                  ["sector_id", "month"], "full"))


def build_panel(wide: DataFrame, market: DataFrame, pairs: DataFrame) -> DataFrame:
    """J04 + J03 + W04: one panel for every configured pair.

    pairs ⋈ wide on country (fan-out), ⟕ market changes on (sector, month);
    ``time_index`` numbers the pair's months 0..n-1.  ``market`` holds both
    targets per (sector, month) (``series.market_changes``) -- or use
    ``combine_market`` for separately stored price / valuation facts.
    """
    mk = market.select("sector_id", "month",
                       F.col("price_change").alias(TARGETS["commodity_price"]),
                       F.col("valuation_change").alias(TARGETS["equity_valuation"]))
    panel = (pairs.select(*PAIR).join(wide, "country_code")
             .join(mk, ["sector_id", "month"], "left"))
    w = Window.partitionBy(*PAIR).orderBy("month")
    return panel.withColumn("time_index", (F.row_number().over(w) - 1).cast("double"))


def month_window(panel: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Restrict the panel to months in [start, end] (``yyyy-MM`` or a
    date).  Apply it before the leads, so targets beyond the end are null."""
    out = panel
    if start:
        out = out.where(F.col("month") >= F.trunc(F.to_date(F.lit(_as_date(start))), "MM"))
    if end:
        out = out.where(F.col("month") <= F.trunc(F.to_date(F.lit(_as_date(end))), "MM"))
    return out


def _as_date(s: str) -> str:
    return f"{s}-01" if len(s) == 7 else s


def with_leads(panel: DataFrame, lags: Sequence[int] = LAGS,
               targets: Sequence[str] = tuple(TARGETS.values())) -> DataFrame:
    """Positional lead of each target by every lag within the pair
    (month t's rate change vs the target ``lag`` panel rows later).
    Also attaches the pair's panel coverage (G06) and size as
    whole-partition window aggregates on the same partitioning."""
    w = Window.partitionBy(*PAIR).orderBy("month")
    whole = Window.partitionBy(*PAIR)
    cols = [F.lead(t, k).over(w).alias(f"{t}__lead{k}") for t in targets for k in lags]
    return panel.select("*", *cols,
                        F.count(F.lit(1)).over(whole).alias("panel_n"),
                        F.min("month").over(whole).alias("panel_start"),
                        F.max("month").over(whole).alias("panel_end"))


def latest_row(panel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The latest panel row per pair, NaN -> null (F16)."""
    s = F.max_by(F.struct(*[F.col(c) for c in columns]), F.col("month"))
    out = panel.groupBy(*PAIR).agg(s.alias("_l"))
    return out.select(*PAIR, *[F.nanvl(F.col(f"_l.{c}"), F.lit(None).cast("double")).alias(c)
                               for c in columns])
