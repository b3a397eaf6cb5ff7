"""Time-series operators over long series tables.

A series is identified by its key columns (e.g. ``country_code, indicator_id``)
and ordered by a ``month`` DateType column.  Every window here is partitioned by
the series key, so the work spreads over the series; a single series is one
group of at most a few thousand monthly rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import RATE_INDICATORS


def _w(keys: Sequence[str], order: str = "month"):
    return Window.partitionBy(*keys).orderBy(order)


def with_change(df: DataFrame, keys: Sequence[str], value: str = "value",
                out: str = "value_change", order: str = "month") -> DataFrame:
    """First difference to the previous row of the same series
    (positional, not calendar: a gap month is skipped over)."""
    return df.withColumn(out, F.col(value) - F.lag(value).over(_w(keys, order)))


def with_pct_change(df: DataFrame, keys: Sequence[str], value: str, out: str,
                    order: str = "month") -> DataFrame:
    """Percent change x100 to the previous row of the series.
    A zero base gives null (not infinity)."""
    prev = F.lag(value).over(_w(keys, order))
    return df.withColumn(out, (F.try_divide(F.col(value), prev) - 1) * 100)


def derive_real_rate(levels: DataFrame, nominal: str = RATE_INDICATORS["nominal"],
                     inflation: str = "cpi_inflation",
                     out: str = RATE_INDICATORS["real"]) -> DataFrame:
    """Real rate = policy rate - inflation for every (country, month)
    where both exist.  Global (null-country) rows never take part.

    One conditional aggregation per (country, month) replaces the wide pivot +
    self-join: rows are combined map-side before the exchange.
    """
    both = (levels.where(F.col("country_code").isNotNull()
                         & F.col("indicator_id").isin(nominal, inflation))
            .groupBy("country_code", "month")
            .agg(F.max(F.when(F.col("indicator_id") == nominal, F.col("value"))).alias("n"),
                 F.max(F.when(F.col("indicator_id") == inflation, F.col("value"))).alias("i")))
    return (both.where(F.col("n").isNotNull() & F.col("i").isNotNull())
            .select("country_code", "month", F.lit(out).alias("indicator_id"),
                    (F.col("n") - F.col("i")).alias("value"),
                    F.lit(False).alias("is_interpolated")))


def date_key_month(month: Column) -> Column:
    """render a month as ``yyyy-MM``."""
    return F.date_format(month, "yyyy-MM")


def record_id(indicator: Column, country: Column, date_key: Column) -> Column:
    """natural key ``indicator|country-or-GLOBAL|date_key``."""
    return F.concat_ws("|", indicator, F.coalesce(country, F.lit("GLOBAL")), date_key)


def union_series(*frames: DataFrame) -> DataFrame:
    """Union of heterogeneous series frames by name; a missing
    ``is_interpolated`` defaults to false."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if "is_interpolated" in out.columns:
        out = out.withColumn("is_interpolated", F.coalesce("is_interpolated", F.lit(False)))
    return out


def with_real_rate(levels: DataFrame, nominal: str = RATE_INDICATORS["nominal"],
                   inflation: str = "cpi_inflation",
                   out: str = RATE_INDICATORS["real"]) -> DataFrame:
    """J09 in a single pass over the levels: the two inputs are found with a
    window over (country, month), and the nominal row emits the derived row
    next to itself.  Unlike ``derive_real_rate`` + union, the (expensive)
    levels plan is consumed once, so it is computed once."""
    ind, val = F.col("indicator_id"), F.col("value")
    w = Window.partitionBy("country_code", "month")
    n = F.max(F.when(ind == nominal, val)).over(w)
    i = F.max(F.when(ind == inflation, val)).over(w)
    cols = ["country_code", "month", "indicator_id", "value", "is_interpolated"]
    src = levels if "is_interpolated" in levels.columns else levels.withColumn(
        "is_interpolated", F.lit(False))
    both = src.select(*cols, n.alias("_n"), i.alias("_i"))
    emit_real = ((ind == nominal) & F.col("country_code").isNotNull()
                 & F.col("_n").isNotNull() & F.col("_i").isNotNull())
    own = F.struct(*[F.col(c) for c in cols])
    real = F.struct(F.col("country_code"), F.col("month"), F.lit(out).alias("indicator_id"),
                    (F.col("_n") - F.col("_i")).alias("value"), F.lit(False).alias("is_interpolated"))
    return (both.select(F.explode(F.array_compact(F.array(own, F.when(emit_real, real))))
                        .alias("r"))
            .select(*[F.col(f"r.{c}").alias(c) for c in cols]))


def macro_fact(levels: DataFrame) -> DataFrame:
    """Q07 core: landed macro levels -> fact_macro_indicator rows.

    levels: (country_code, month, indicator_id, value[, is_interpolated]).
    Adds the derived real rate (J09), first differences per series (W01),
    ``date_key`` and ``record_id`` (F13).
    """
    allrows = union_series(with_real_rate(levels))
    changed = with_change(allrows, ["country_code", "indicator_id"])
    dk = date_key_month(F.col("month"))
    return changed.select(
        record_id(F.col("indicator_id"), F.col("country_code"), dk).alias("record_id"),
        dk.alias("date_key"), "month", "country_code", "indicator_id", "value",
        "value_change", "is_interpolated")


def commodity_fact(levels: DataFrame) -> DataFrame:
    """Q08 (prices): (sector_id, month, price_index) -> fact_commodity_price."""
    dk = date_key_month(F.col("month"))
    return (with_pct_change(levels, ["sector_id"], "price_index", "price_change")
            .select(F.concat_ws("|", "sector_id", dk).alias("price_id"), dk.alias("date_key"),
                    "month", "sector_id", "price_index", "price_change",
                    F.lit(None).cast("double").alias("production_volume_change")))


def equity_fact(levels: DataFrame, instrument_type: str = "sector_etf") -> DataFrame:
    """Q08 (valuations): (sector_id, month, valuation_index) -> fact_equity_valuation."""
    dk = date_key_month(F.col("month"))
    return (with_pct_change(levels, ["sector_id"], "valuation_index", "valuation_change")
            .select(F.concat_ws("|", "sector_id", dk).alias("valuation_id"),
                    dk.alias("date_key"), "month", "sector_id",
                    F.lit(instrument_type).alias("instrument_type"),
                    "valuation_index", "valuation_change"))


def market_changes(levels: DataFrame) -> DataFrame:
    """Both market targets from one (sector, month) frame holding
    ``price_index`` and ``valuation_index``: percent changes over the same
    window, so one scan / one exchange serves both."""
    before = _w(["sector_id"]).rowsBetween(Window.unboundedPreceding, -1)
    out = levels
    for v, o in (("price_index", "price_change"), ("valuation_index", "valuation_change")):
        prev = F.last(F.col(v), ignorenulls=True).over(before)  # previous row of that series
        out = out.withColumn(o, (F.try_divide(F.col(v), prev) - 1) * 100)
    return out


def last_per_month(history: DataFrame, keys: Sequence[str], ts: str, value: str,
                   tiebreak: str | None = None, out: str | None = None) -> DataFrame:
    """One value per (keys, month): the last non-null observation of
    the month by timestamp (ties broken by ``tiebreak``).  ``max_by`` is a
    plain aggregate, so it combines map-side like any other."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return (history.where(F.col(value).isNotNull())
            .groupBy(*keys, F.trunc(ts, "MM").alias("month"))
            .agg(F.max_by(F.col(value), order).alias(out or value)))


def last_december(annual: DataFrame) -> Column:
    """The last month that annual levels speak for, as a scalar."""
    return F.make_date(annual.agg(F.max("year")).scalar(), F.lit(12), F.lit(1))


def annual_to_monthly(annual: DataFrame, through: str | Column,
                      keys: Sequence[str] = ("country_code", "indicator_id")) -> DataFrame:
    """J08 + W08: as-of (backward) expansion of annual values to months.

    Each month from January of the series' first year through ``through``
    takes the value of the latest year <= its year; every produced row is
    flagged interpolated.  Implemented as a calendar explode per series plus a
    forward fill (``last(..., ignorenulls)``) -- an equi-join on (series, year)
    instead of a non-equi join.
    """
    keys = list(keys)
    through_col = F.to_date(F.lit(through)) if isinstance(through, str) else through
    # a series that starts after ``through`` has no months
    bounds = annual.groupBy(*keys).agg(F.min("year").alias("y0")).where(
        F.make_date(F.col("y0"), F.lit(1), F.lit(1)) <= F.trunc(through_col, "MM"))
    calendar = bounds.select(*keys, F.explode(F.sequence(
        F.make_date(F.col("y0"), F.lit(1), F.lit(1)), F.trunc(through_col, "MM"),
        F.expr("interval 1 month"))).alias("month"))
    yearly = annual.select(*keys, F.make_date(F.col("year"), F.lit(1), F.lit(1)).alias("month"),
                           F.col("value").alias("v"))
    w = (Window.partitionBy(*keys).orderBy("month")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (calendar.join(yearly, keys + ["month"], "left")
            .select(*keys, "month", F.last("v", ignorenulls=True).over(w).alias("value"))
            .where(F.col("value").isNotNull())
            .withColumn("is_interpolated", F.lit(True)))


def forward_fill(df: DataFrame, keys: Sequence[str], value: str, order: str = "month",
                 flag: str = "is_interpolated") -> DataFrame:
    """Fill null values from the last non-null of the series and flag the
    filled rows."""
    w = (Window.partitionBy(*keys).orderBy(order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = F.last(F.col(value), ignorenulls=True).over(w)
    return df.select(*[c for c in df.columns if c not in (value, flag)],
                     filled.alias(value),
                     (F.col(value).isNull() & filled.isNotNull()).alias(flag))


def missing_series(expected_keys: DataFrame, loaded: DataFrame,
                   keys: Sequence[str] = ("indicator_id", "country_code")) -> DataFrame:
    """(indicator, country) combinations expected but absent from the
    loaded data -- the skip report."""
    keys = list(keys)
    return expected_keys.select(*keys).distinct().join(
        loaded.select(*keys).distinct(), keys, "left_anti")
