"""Landed inputs of the star schema, derived from the driver's TPC-H-like tables.

The analysed application pulls macro, price and news data from web services.
Here the same shapes are derived, deterministically and at scale, from the
driver tables (mapping documented in FIXTURES.md section 4):

* countries  = nations, sectors = part types, sources = document sources
* country-level monthly macro series = aggregates of orders x customer x lineitem
  per (customer nation, order month)
* global monthly series              = aggregates of lineitem per ship month
* commodity price / equity valuation = aggregates of lineitem x part per
  (part type, ship month)
* annual series                      = average order price per (nation, year)
* articles and their tag bridges     = events

Every base series is a single division of exact integer (or DECIMAL) sums, so
its double value is the same in any engine and under any partitioning --
later rankings see identical inputs.

Scale notes: for the macro series lineitem is pre-aggregated to one row per
order before it meets orders -- the aggregate's output is already partitioned
by orderkey, so the join reuses it and carries ~4x fewer rows.  For the
market series lineitem is joined to part first (see ``_sector_month``).  All
groupBys have map-side partial aggregation, so a hot nation or part type (one
key holding a third of the rows) is combined before the exchange and never
lands on one task as raw rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MECHANISM_IDS, POLICY_SUBTYPES, SOURCE_TYPES
from ..functions.scalar import round_half_up
from .driver import read

# Fixture mapping constant: order of sectors used when assigning one sector per
# event (the six part types of the driver data, lower-cased and sorted).
FIXTURE_SECTORS = ["economy", "large", "medium", "promo", "small", "standard"]
N_SOURCES = 20


def country_code(nationkey: Column) -> Column:
    """``N`` and the key, padded to two digits at least."""
    key = nationkey.cast("string")
    return F.concat(F.lit("N"), F.when(F.length(key) < 2, F.concat(F.lit("0"), key)).otherwise(key))


def month_of(ts: Column) -> Column:
    return F.trunc(ts, "MM")


# ---------------------------------------------------------------- dimensions
def dim_country(spark: SparkSession, sf: str) -> DataFrame:
    nation = read(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf, "region", "r_regionkey", "r_name")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
            .select(country_code(F.col("n_nationkey")).alias("country_code"),
                    F.col("n_name").alias("country_name"),
                    F.col("r_name").alias("region")))


def dim_sector(spark: SparkSession, sf: str) -> DataFrame:
    part = read(spark, sf, "part", "p_type")
    return (part.select(F.lower("p_type").alias("sector_id")).distinct()
            .select("sector_id",
                    F.initcap(F.col("sector_id")).alias("sector_name"),
                    F.when(F.col("sector_id") == "promo", "semiconductor")
                     .otherwise("metal").alias("sector_category")))


def dim_source(spark: SparkSession, sf: str) -> DataFrame:
    docs = read(spark, sf, "documents", "source")
    idx = F.regexp_extract("source", r"(\d+)$", 1).cast("int")
    types = F.array(*[F.lit(t) for t in SOURCE_TYPES])
    return (docs.distinct()
            .select(F.col("source").alias("source_id"),
                    F.concat(F.lit("Source "), idx.cast("string")).alias("source_name"),
                    F.element_at(types, (idx % len(SOURCE_TYPES)) + 1).alias("source_type"),
                    F.lit(None).cast("string").alias("home_country_code")))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Configured (country, sector) analysis pairs: every nation x part type.

    The pair list is configuration (its size is #countries x #sectors, not a
    function of the fact data); the sector dimension is gathered into one
    array and exploded per country.
    """
    sectors = dim_sector(spark, sf).agg(F.sort_array(F.collect_set("sector_id"))).scalar()
    return dim_country(spark, sf).select("country_code", F.explode(sectors).alias("sector_id"))


# ------------------------------------------------------------- macro series
def cents(c: Column) -> Column:
    """A 2-decimal money / rate column as exact integer hundredths."""
    return F.round(c * 100).cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """One IEEE division of two exact integers: bit-identical in any engine."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def _order_level(spark: SparkSession, sf: str) -> DataFrame:
    """orders x customer x (lineitem pre-aggregated per order, exact integer
    sums)."""
    li = read(spark, sf, "lineitem", "l_orderkey", "l_discount", "l_tax",
              "l_extendedprice", "l_quantity", "l_returnflag")
    per_order = li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(cents(F.col("l_discount"))).alias("s_disc"), F.count("l_discount").alias("c_disc"),
        F.sum(cents(F.col("l_tax"))).alias("s_tax"), F.count("l_tax").alias("c_tax"),
        F.sum(F.when(F.col("l_quantity").isNotNull(), cents(F.col("l_extendedprice"))))
        .alias("s_ep"),
        F.sum(F.when(F.col("l_extendedprice").isNotNull(), cents(F.col("l_quantity"))))
        .alias("s_qty_ep"),
        F.sum(cents(F.col("l_quantity"))).alias("s_qty"),
        F.count("l_quantity").alias("c_qty"),
        F.sum((F.col("l_returnflag") == "R").cast("int")).alias("s_ret"),
        F.count("l_returnflag").alias("c_ret"),
    )
    orders = read(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
                  "o_totalprice", "o_orderdate")
    customer = read(spark, sf, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    oc = orders.join(customer, orders.o_custkey == customer.c_custkey)
    return oc.join(per_order, oc.o_orderkey == per_order.l_orderkey)


def macro_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Landed monthly macro levels, long format:
    (country_code, month, indicator_id, value, is_interpolated).

    Country-level series come first, global (country_code null) series after.
    The derived real rate is *not* here: it is computed by the J09 operator.
    Each level is one division of exact integer sums, so its double value does
    not depend on partitioning or summation order.
    """
    j = _order_level(spark, sf)
    n = F.col("n_lines")

    def wsum(c: Column) -> Column:  # sum over the joined line rows
        return F.sum(c * n)

    def wcnt(c: Column) -> Column:
        return F.sum(F.when(c.isNotNull(), n))

    agg = j.groupBy(country_code(F.col("c_nationkey")).alias("country_code"),
                    month_of(F.col("o_orderdate")).alias("month")).agg(
        ratio(F.sum("s_disc"), F.sum("c_disc")).alias("policy_rate"),
        ratio(F.sum("s_tax"), F.sum("c_tax")).alias("cpi_inflation"),
        ratio(wsum(cents(F.col("o_totalprice"))), wcnt(F.col("o_totalprice")) * 100000)
        .alias("gdp_growth"),
        ratio(wsum((F.col("o_orderstatus") == "F").cast("bigint")) * 100,
              wcnt(F.col("o_orderstatus"))).alias("unemployment_rate"),
        ratio(wsum(cents(F.col("c_acctbal"))), wcnt(F.col("c_acctbal")) * 10000)
        .alias("trade_balance"),
        ratio(F.sum("s_ep"), F.sum("s_qty_ep")).alias("reer"),
        ratio(F.sum("s_qty"), F.sum("c_qty") * 100).alias("fdi_net_inflow"),
        ratio(F.sum("s_ret") * 100, F.sum("c_ret")).alias("gov_debt_pct_gdp"),
    )
    names = ["policy_rate", "cpi_inflation", "gdp_growth", "unemployment_rate",
             "trade_balance", "reer", "fdi_net_inflow", "gov_debt_pct_gdp"]
    country = agg.unpivot(["country_code", "month"], names, "indicator_id", "value")

    li = read(spark, sf, "lineitem", "l_shipdate", "l_quantity", "l_tax", "l_discount")
    glob = (li.groupBy(month_of(F.col("l_shipdate")).alias("month")).agg(
        ratio(F.sum(cents(F.col("l_quantity"))), F.count("l_quantity") * 100).alias("usd_index"),
        ratio(F.sum(cents(F.col("l_tax"))), F.count("l_tax")).alias("treasury_yield_10y"),
        ratio(F.sum(cents(F.col("l_discount"))), F.count("l_discount"))
        .alias("fed_funds_rate_global"))
        .withColumn("country_code", F.lit(None).cast("string"))
        .unpivot(["country_code", "month"], ["usd_index", "treasury_yield_10y",
                                            "fed_funds_rate_global"], "indicator_id", "value"))
    return (country.unionByName(glob)
            .where(F.col("value").isNotNull())
            .select("country_code", "month", "indicator_id", "value",
                    F.lit(False).alias("is_interpolated")))


def annual_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Annual series per country (shape of the annual development indicators):
    (country_code, indicator_id, year, value)."""
    orders = read(spark, sf, "orders", "o_custkey", "o_totalprice", "o_orderdate")
    customer = read(spark, sf, "customer", "c_custkey", "c_nationkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .groupBy(country_code(F.col("c_nationkey")).alias("country_code"),
                     F.year("o_orderdate").alias("year"))
            .agg(ratio(F.sum(cents(F.col("o_totalprice"))), F.count("o_totalprice") * 100000)
                 .alias("value"))
            .select("country_code", F.lit("gdp_growth").alias("indicator_id"), "year", "value"))


# ------------------------------------------------------------ market series
def _sector_month(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem x part -> (sector, month): join first, then aggregate.

    Lineitem is not clustered by part, so pre-aggregating by (part, month)
    would add a shuffle the part join cannot reuse.  Joined first, lineitem
    moves at most once (by partkey; not at all when AQE broadcasts part) and
    the (sector, month) aggregate combines map-side into a tiny result."""
    li = read(spark, sf, "lineitem", "l_partkey", "l_shipdate", "l_extendedprice",
              "l_quantity", "l_discount")
    part = read(spark, sf, "part", "p_partkey", "p_type")
    j = li.join(part, li.l_partkey == part.p_partkey)
    # revenue in exact 1e-4 units: cents x (100 - discount cents); BIGINT sums
    # stay on the fast fixed-width path (DECIMAL(38) would use BigDecimal)
    revenue = cents(F.col("l_extendedprice")) * (F.lit(100) - cents(F.col("l_discount")))
    ep = F.when(F.col("l_quantity").isNotNull(), cents(F.col("l_extendedprice")))
    qty = F.when(F.col("l_extendedprice").isNotNull(), cents(F.col("l_quantity")))
    return (j.groupBy(F.lower("p_type").alias("sector_id"), month_of(F.col("l_shipdate")).alias("month"))
            .agg(ratio(F.sum(ep), F.sum(qty)).alias("price_index"),
                 ratio(F.sum(revenue), F.lit(10000)).alias("valuation_index")))


def market_levels(spark: SparkSession, sf: str) -> DataFrame:
    """(sector_id, month, price_index, valuation_index) from one aggregate."""
    return _sector_month(spark, sf)


def commodity_levels(spark: SparkSession, sf: str) -> DataFrame:
    """(sector_id, month, price_index) -- landed monthly spot prices."""
    return _sector_month(spark, sf).select("sector_id", "month", "price_index") \
        .where(F.col("price_index").isNotNull())


def equity_levels(spark: SparkSession, sf: str) -> DataFrame:
    """(sector_id, month, valuation_index) -- landed monthly closes."""
    return _sector_month(spark, sf).select("sector_id", "month", "valuation_index") \
        .where(F.col("valuation_index").isNotNull())


def instrument_history(spark: SparkSession, sf: str) -> DataFrame:
    """Intra-month instrument closes (shape of a price history download):
    (sector_id, ts, instrument_id, close).  One row per lineitem."""
    li = read(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
              "l_shipdate", "l_extendedprice", "l_quantity")
    part = read(spark, sf, "part", "p_partkey", "p_type")
    return (li.join(part, li.l_partkey == part.p_partkey)
            .select(F.lower("p_type").alias("sector_id"),
                    F.col("l_shipdate").alias("ts"),
                    (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("instrument_id"),
                    ratio(cents(F.col("l_extendedprice")),
                          cents(F.col("l_quantity"))).alias("close")))


# ------------------------------------------------------------------ articles
def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """fact_article rows derived from events (one article per event)."""
    ev = read(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    return articles_from_events(ev)


def articles_from_events(ev: DataFrame) -> DataFrame:
    """The event -> article mapping; works on batch and streaming frames."""
    k = _k(F.col("props"))
    policy = F.col("event_type").isin("signup", "purchase")
    category = F.when(policy, "monetary_policy").otherwise("commodity_stocks")
    stance = (F.when(F.col("event_type") == "purchase", "contractionary")
              .when(F.col("event_type") == "signup", "expansionary").otherwise("neutral"))
    subtypes = F.array(*[F.lit(s) for s in POLICY_SUBTYPES])
    subtype = F.when(policy, F.element_at(subtypes, (k % 4) + 1)).otherwise(F.lit(""))
    mech = F.concat_ws(",",
                       F.when(k % 4 == 0, F.lit(MECHANISM_IDS[0])),
                       F.when(k % 3 == 1, F.lit(MECHANISM_IDS[1])),
                       F.when(k % 5 == 2, F.lit(MECHANISM_IDS[2])),
                       F.when(k % 7 == 3, F.lit(MECHANISM_IDS[3])))
    return ev.select(
        F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("article_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_key"),
        F.concat(F.lit("src"), (F.col("user_id") % N_SOURCES).cast("string")).alias("source_id"),
        category.alias("article_category"),
        subtype.alias("policy_subtype"),
        round_half_up((F.col("value") - 50) / 500, 4).alias("sentiment_score"),
        F.when(policy, F.lit("policy_outlook")).otherwise(F.lit("sector_producers"))
         .alias("sentiment_target"),
        F.concat(F.lit("https://news"), (F.col("user_id") % N_SOURCES).cast("string"),
                 F.lit(".example.com/a/"), F.col("event_id").cast("string")).alias("source_url"),
        F.concat(F.initcap("event_type"), F.lit(" report "), F.col("event_id").cast("string"))
         .alias("title"),
        F.col("ts").alias("published"),
        mech.alias("mech"),
        stance.alias("policy_stance"),
    )


def article_country(spark: SparkSession, sf: str) -> DataFrame:
    """bridge_article_country: home country of the user, plus a second country
    for every third event."""
    ev = read(spark, sf, "events", "event_id", "user_id")
    aid = F.concat(F.lit("a"), F.col("event_id").cast("string"))
    first = country_code(F.col("user_id") % 25)
    second = F.when(F.col("event_id") % 3 == 0, country_code((F.col("user_id") * 7 + 3) % 25))
    return (ev.select(aid.alias("article_id"),
                      F.array_compact(F.array(first, second)).alias("cc"))
            .select("article_id", F.explode(F.array_distinct("cc")).alias("country_code")))


def article_sector(spark: SparkSession, sf: str) -> DataFrame:
    """bridge_article_sector: one sector for commodity articles."""
    ev = read(spark, sf, "events", "event_id", "event_type")
    secs = F.array(*[F.lit(s) for s in FIXTURE_SECTORS])
    return (ev.where(~F.col("event_type").isin("signup", "purchase"))
            .select(F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("article_id"),
                    F.element_at(secs, (F.col("event_id") % len(FIXTURE_SECTORS)).cast("int") + 1)
                    .alias("sector_id")))


def daily_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Day-grain policy-rate series per country, derived from events, used as
    the classifier label source when articles cover a single month:
    (country_code, period, value)."""
    ev = read(spark, sf, "events", "ts", "user_id", "value")
    return (ev.groupBy(country_code(F.col("user_id") % 25).alias("country_code"),
                       F.to_date("ts").alias("period"))
            .agg(ratio(F.sum(cents(F.col("value"))), F.count("value") * 1000).alias("value")))
