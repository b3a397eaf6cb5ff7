"""Registered queries of series ingestion (Q07, Q08, W01, W02, W08, J08, J09,
G04, G05/S07, S06, U01, F05-F08, F13, F14, P12, K01, L07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import INDICATORS
from ..operators import series as se
from ..sinks import tables as sink
from ..sources import landed
from ..sources import tpch_star as ts
from . import oracle as O
from .registry import finish, register
from .star import Star

MF = ["record_id", "date_key", "country_code", "indicator_id", "value", "value_change",
      "is_interpolated"]


def _mf_sql(where: str = "") -> str:
    return O.with_ctes(
        "SELECT record_id, date_key, country_code, indicator_id, " + O.r6("value", "value")
        + ", " + O.r6("value_change", "value_change") + ", is_interpolated FROM s_macro_fact "
        + where, "s_macro_fact")


@register("q07_macro_ingest", _mf_sql)
def q07(spark: SparkSession, sf: str) -> DataFrame:
    return finish(Star(spark, sf).fact_macro_indicator.select(*MF))


@register("w01_first_difference", lambda: O.with_ctes(
    "SELECT country_code, indicator_id, month, " + O.r6("value_change", "value_change")
    + " FROM s_macro_fact", "s_macro_fact"))
def w01(spark: SparkSession, sf: str) -> DataFrame:
    m = se.with_change(Star(spark, sf).macro_levels, ["country_code", "indicator_id"])
    real = se.with_change(se.derive_real_rate(Star(spark, sf).macro_levels),
                          ["country_code", "indicator_id"])
    return finish(m.unionByName(real).select("country_code", "indicator_id", "month",
                                             "value_change"))


@register("j09_real_rate", lambda: O.with_ctes(
    "SELECT country_code, month, " + O.r6("value", "value") + ", " + O.r6("value_change", "value_change")
    + " FROM s_macro_fact WHERE indicator_id = 'real_interest_rate'", "s_macro_fact"))
def j09(spark: SparkSession, sf: str) -> DataFrame:
    real = se.with_change(se.derive_real_rate(Star(spark, sf).macro_levels),
                          ["country_code", "indicator_id"])
    return finish(real.select("country_code", "month", "value", "value_change"))


@register("g04_level_pivot", lambda: O.with_ctes("""
SELECT country_code, month, """ + ", ".join(
    O.r6(f"max(CASE WHEN indicator_id = '{i}' THEN value END)", i)
    for i in ["policy_rate", "cpi_inflation"]) + """
FROM s_macro_levels WHERE country_code IS NOT NULL GROUP BY 1, 2""", "s_macro_levels"))
def g04(spark: SparkSession, sf: str) -> DataFrame:
    """Levels pivoted on (country, month); global (null-country) rows vanish."""
    lv = Star(spark, sf).macro_levels.where(F.col("country_code").isNotNull())
    return finish(lv.groupBy("country_code", "month")
                  .pivot("indicator_id", ["policy_rate", "cpi_inflation"]).agg(F.max("value")))


@register("f13_record_id", lambda: O.with_ctes(
    "SELECT record_id, indicator_id, country_code, date_key FROM s_macro_fact", "s_macro_fact"))
def f13(spark: SparkSession, sf: str) -> DataFrame:
    return finish(Star(spark, sf).fact_macro_indicator.select("record_id", "indicator_id",
                                                              "country_code", "date_key"))


@register("w02_price_change", lambda: O.with_ctes(
    "SELECT price_id, date_key, sector_id, " + O.r6("price_index", "price_index") + ", "
    + O.r6("price_change", "price_change") + " FROM s_commodity_fact", "s_commodity_fact"))
def w02(spark: SparkSession, sf: str) -> DataFrame:
    f = Star(spark, sf).fact_commodity_price
    return finish(f.select("price_id", "date_key", "sector_id", "price_index", "price_change"))


@register("q08_market_ingest", lambda: O.with_ctes(
    "SELECT valuation_id, date_key, sector_id, instrument_type, "
    + O.r6("valuation_index", "valuation_index") + ", "
    + O.r6("valuation_change", "valuation_change") + " FROM s_equity_fact", "s_equity_fact"))
def q08(spark: SparkSession, sf: str) -> DataFrame:
    f = Star(spark, sf).fact_equity_valuation
    return finish(f.select("valuation_id", "date_key", "sector_id", "instrument_type",
                           "valuation_index", "valuation_change"))


O.cte("s_instruments", [], f"""
SELECT lower(p.p_type) AS sector_id, l.l_shipdate AS ts,
       l.l_orderkey * 10 + l.l_linenumber AS instrument_id,
       {O.ratio(O.cents('l.l_extendedprice'), O.cents('l.l_quantity'))} AS close
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")


@register("g05_last_per_month", lambda: O.with_ctes(f"""
SELECT sector_id, month, {O.r6('close', 'close')} FROM (
  SELECT sector_id, {O.month('ts')} AS month, close,
         row_number() OVER (PARTITION BY sector_id, {O.month('ts')}
                            ORDER BY ts DESC, instrument_id DESC) AS rn
  FROM s_instruments WHERE close IS NOT NULL) t WHERE rn = 1""", "s_instruments"))
def g05(spark: SparkSession, sf: str) -> DataFrame:
    """One close per (sector, month): the last non-null by time,
    instrument id as tiebreak."""
    h = ts.instrument_history(spark, sf)
    return finish(se.last_per_month(h, ["sector_id"], "ts", "close", tiebreak="instrument_id"))


def _sheet_sectors(spark: SparkSession, sf: str) -> list[str]:
    """The sheet's columns are the sector dimension (a few configured names)."""
    return [r["sector_id"] for r in ts.dim_sector(spark, sf).select("sector_id").orderBy("sector_id").collect()]


def _sheet(spark: SparkSession, sf: str) -> DataFrame:
    """The monthly price sheet in its landed wide shape: one ``yyyyMmm``
    period column and one column per commodity (here: per sector)."""
    lv = ts.commodity_levels(spark, sf)
    sectors = _sheet_sectors(spark, sf)
    wide = lv.groupBy("month").pivot("sector_id", sectors).agg(F.max("price_index"))
    cols = {s: s.capitalize() for s in sectors}
    return wide.select(F.date_format("month", "yyyy'M'MM").alias("period"),
                       *[F.col(s).alias(c) for s, c in cols.items()])


@register("s06_sheet_unpivot", lambda: O.with_ctes(
    "SELECT sector_id, strftime(month, '%Y-%m') AS date_key, month, "
    + O.r6("price_index", "price_index") + " FROM s_sector_month WHERE price_index IS NOT NULL",
    "s_sector_month"))
def s06(spark: SparkSession, sf: str) -> DataFrame:
    mapping = {s: s.capitalize() for s in _sheet_sectors(spark, sf)} | {"unlisted": "NotInSheet"}
    return finish(landed.sheet_to_long(_sheet(spark, sf), mapping))


@register("f08_period_code", lambda: O.with_ctes("""
SELECT strftime(month, '%Y') || 'M' || strftime(month, '%m') AS period,
       strftime(month, '%Y-%m') AS date_key FROM (SELECT DISTINCT month FROM s_sector_month) t""",
    "s_sector_month"))
def f08(spark: SparkSession, sf: str) -> DataFrame:
    sh = _sheet(spark, sf)
    return finish(sh.select("period", landed.period_to_key(F.col("period")).alias("date_key")))


O.cte("s_annual", [], f"""
SELECT {O.cc('c.c_nationkey')} AS country_code, 'gdp_growth' AS indicator_id,
       year(o.o_orderdate) AS year,
       {O.ratio(f"sum({O.cents('o.o_totalprice')})", 'count(o.o_totalprice) * 100000')} AS value
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2, 3""")

O.cte("s_annual_monthly", ["s_annual"], f"""
SELECT cal.country_code, cal.indicator_id, cal.month, a.value, true AS is_interpolated
FROM (SELECT country_code, indicator_id,
             unnest(generate_series(make_date(min(year), 1, 1), (SELECT make_date(max(year), 12, 1) FROM s_annual),
                                    INTERVAL 1 MONTH))::DATE AS month
      FROM s_annual GROUP BY 1, 2) cal
ASOF LEFT JOIN (SELECT *, make_date(year, 1, 1) AS ystart FROM s_annual) a
  ON cal.country_code = a.country_code AND cal.indicator_id = a.indicator_id
 AND cal.month >= a.ystart""")


@register("j08_annual_asof", lambda: O.with_ctes(
    "SELECT country_code, indicator_id, month, " + O.r6("value", "value")
    + ", is_interpolated FROM s_annual_monthly WHERE value IS NOT NULL", "s_annual_monthly"))
def j08(spark: SparkSession, sf: str) -> DataFrame:
    a = ts.annual_levels(spark, sf)
    return finish(se.annual_to_monthly(a, se.last_december(a)).select(
        "country_code", "indicator_id", "month", "value", "is_interpolated"))


@register("u01_union_series", lambda: O.with_ctes(
    "SELECT country_code, indicator_id, month, " + O.r6("value", "value") + """, is_interpolated
FROM (SELECT country_code, indicator_id, month, value, is_interpolated FROM s_macro_levels
      UNION ALL SELECT country_code, indicator_id, month, value, is_interpolated FROM s_real_rate
      UNION ALL SELECT country_code, 'gdp_growth_annual', month, value, is_interpolated
                FROM s_annual_monthly WHERE value IS NOT NULL) u""",
    "s_macro_levels", "s_real_rate", "s_annual_monthly"))
def u01(spark: SparkSession, sf: str) -> DataFrame:
    star = Star(spark, sf)
    levels = ts.annual_levels(spark, sf)
    annual = (se.annual_to_monthly(levels, se.last_december(levels))
              .withColumn("indicator_id", F.lit("gdp_growth_annual")))
    monthly = star.macro_levels.drop("is_interpolated")  # flag defaults in the union
    u = se.union_series(monthly, se.derive_real_rate(star.macro_levels), annual)
    return finish(u.select("country_code", "indicator_id", "month", "value", "is_interpolated"))


O.cte("s_policy_grid", ["s_macro_levels"], """
SELECT g.country_code, g.month, l.value
FROM (SELECT country_code, unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH))::DATE
             AS month
      FROM s_macro_levels WHERE indicator_id = 'policy_rate' GROUP BY 1) g
LEFT JOIN s_macro_levels l ON l.indicator_id = 'policy_rate' AND l.country_code = g.country_code
 AND l.month = g.month""")


@register("w08_forward_fill", lambda: O.with_ctes(
    "SELECT country_code, month, " + O.r6("filled", "value") + """,
       (value IS NULL AND filled IS NOT NULL) AS is_interpolated
FROM (SELECT *, last_value(value IGNORE NULLS) OVER (PARTITION BY country_code ORDER BY month
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS filled FROM s_policy_grid) t""",
    "s_policy_grid"))
def w08(spark: SparkSession, sf: str) -> DataFrame:
    """Policy rate on a complete monthly calendar per country; months with
    no observation take the last value and are flagged interpolated."""
    lv = Star(spark, sf).macro_levels.where(F.col("indicator_id") == "policy_rate")
    cal = (lv.groupBy("country_code").agg(F.min("month").alias("a"), F.max("month").alias("b"))
           .select("country_code", F.explode(F.sequence("a", "b", F.expr("interval 1 month")))
                   .alias("month")))
    grid = cal.join(lv.select("country_code", "month", "value"), ["country_code", "month"], "left")
    return finish(se.forward_fill(grid, ["country_code"], "value")
                  .select("country_code", "month", "value", "is_interpolated"))


@register("p12_missing_series", lambda: O.with_ctes(f"""
SELECT e.indicator_id, e.country_code FROM
  (SELECT country_code, unnest([{O.sql_list([i[0] for i in INDICATORS])}]) AS indicator_id
   FROM s_dim_country) e
WHERE NOT EXISTS (SELECT 1 FROM s_macro_fact m WHERE m.indicator_id = e.indicator_id
                  AND m.country_code = e.country_code)""", "s_dim_country", "s_macro_fact"))
def p12(spark: SparkSession, sf: str) -> DataFrame:
    """Skip report: every (indicator, country) expected but not loaded."""
    star = Star(spark, sf)
    expected = star.dim_country.select(
        "country_code", F.explode(F.array(*[F.lit(i[0]) for i in INDICATORS])).alias("indicator_id"))
    return finish(se.missing_series(expected, star.fact_macro_indicator))


def _upsert_inputs(star: Star):
    target = star.fact_macro_indicator.select(*MF)
    glob = target.where(F.col("country_code").isNull())
    restated = glob.withColumn("value", F.col("value") * 2)
    extra = glob.withColumn("indicator_id", F.concat(F.col("indicator_id"), F.lit("_v2"))) \
        .withColumn("record_id", F.concat(F.col("record_id"), F.lit("_v2")))
    incoming = restated.unionByName(restated).unionByName(extra)
    return target, incoming


@register("k01_upsert", lambda: O.with_ctes(f"""
, inc AS (
  SELECT record_id, date_key, country_code, indicator_id, value * 2 AS value, value_change,
         is_interpolated FROM s_macro_fact WHERE country_code IS NULL
  UNION ALL
  SELECT record_id || '_v2', date_key, country_code, indicator_id || '_v2', value, value_change,
         is_interpolated FROM s_macro_fact WHERE country_code IS NULL)
SELECT record_id, date_key, country_code, indicator_id, {O.r6('value', 'value')},
       {O.r6('value_change', 'value_change')}, is_interpolated
FROM (SELECT * FROM s_macro_fact m WHERE record_id NOT IN (SELECT record_id FROM inc)
      UNION ALL SELECT * FROM inc) u""".replace("SELECT * FROM s_macro_fact m",
    "SELECT record_id, date_key, country_code, indicator_id, value, value_change, "
    "is_interpolated FROM s_macro_fact m"), "s_macro_fact"))
def k01(spark: SparkSession, sf: str) -> DataFrame:
    """Upsert on record_id of a restated batch (with duplicate rows) plus new
    rows into the macro fact."""
    target, incoming = _upsert_inputs(Star(spark, sf))
    return finish(sink.upsert(target, incoming, ["record_id"]))


HWM_CUT = "2000-01-01"


@register("l07_incremental_pull", lambda: O.with_ctes(f"""
, stored AS (SELECT * FROM s_macro_fact WHERE month < DATE '{HWM_CUT}'),
hwm AS (SELECT indicator_id, coalesce(country_code, 'GLOBAL') AS ck, max(month) AS hw
        FROM stored GROUP BY 1, 2)
SELECT s.record_id, s.indicator_id, s.country_code, s.month
FROM s_macro_fact s LEFT JOIN hwm h ON h.indicator_id = s.indicator_id
 AND h.ck = coalesce(s.country_code, 'GLOBAL')
WHERE h.hw IS NULL OR s.month > h.hw""", "s_macro_fact"))
def l07(spark: SparkSession, sf: str) -> DataFrame:
    """Incremental pull: the source rows newer than each series' high-water
    mark in the stored table (here: the table as of an earlier cut)."""
    f = Star(spark, sf).fact_macro_indicator
    stored = f.where(F.col("month") < F.to_date(F.lit(HWM_CUT)))
    key = F.coalesce(F.col("country_code"), F.lit("GLOBAL"))
    hwm = stored.groupBy("indicator_id", key.alias("ck")).agg(F.max("month").alias("hw"))
    new = (f.withColumn("ck", key).join(hwm, ["indicator_id", "ck"], "left")
           .where(F.col("hw").isNull() | (F.col("month") > F.col("hw"))))
    return finish(new.select("record_id", "indicator_id", "country_code", "month"))


@register("f05_date_prefix", """
SELECT strftime(ts, '%Y-%m-%d') AS date_key, strftime(ts, '%Y-%m') AS month_key, count(*) AS n
FROM events GROUP BY 1, 2""")
def f05(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.driver import read
    ev = read(spark, sf, "events", "ts")
    return finish(ev.groupBy(F.date_format("ts", "yyyy-MM-dd").alias("date_key"),
                             F.date_format(F.trunc("ts", "MM"), "yyyy-MM").alias("month_key"))
                  .agg(F.count(F.lit(1)).alias("n")))


@register("f07_month_arithmetic", lambda: O.with_ctes(
    "SELECT record_id, CAST(month - INTERVAL 1 MONTH AS DATE) AS prev_month, "
    "CAST(month + INTERVAL 1 MONTH AS DATE) AS next_month FROM s_macro_fact", "s_macro_fact"))
def f07(spark: SparkSession, sf: str) -> DataFrame:
    f = Star(spark, sf).fact_macro_indicator
    return finish(f.select("record_id", F.add_months("month", -1).alias("prev_month"),
                           F.add_months("month", 1).alias("next_month")))


@register("f14_sentinel_parse", lambda: O.with_ctes(f"""
SELECT record_id, {O.r6("TRY_CAST(nullif(raw, '.') AS DOUBLE)", 'value')} FROM (
  SELECT record_id, CASE WHEN month(month) = 7 THEN '.' ELSE CAST(value AS VARCHAR) END AS raw
  FROM s_macro_fact WHERE country_code IS NULL) t""", "s_macro_fact"))
def f14(spark: SparkSession, sf: str) -> DataFrame:
    """Global series landed as strings with the '.' missing-value sentinel
    (every July), parsed back."""
    f = Star(spark, sf).fact_macro_indicator.where(F.col("country_code").isNull())
    raw = F.when(F.month("month") == 7, F.lit(".")).otherwise(F.col("value").cast("string"))
    return finish(f.select("record_id", landed.parse_sentinel(raw).alias("value")))
