"""The star schema over a driver data folder, as lazily composed DataFrames.

``Star(spark, sf_dir)`` exposes the engine's tables (fact_macro_indicator,
fact_commodity_price, ...) built by the ingest operators from the landed
inputs of ``sources.tpch_star``.  Nothing is computed until an action runs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panel as pn
from ..operators import series as se
from ..sources import tpch_star as ts


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf = sf_dir

    # dimensions
    @cached_property
    def dim_country(self) -> DataFrame:
        return ts.dim_country(self.spark, self.sf)

    @cached_property
    def dim_sector(self) -> DataFrame:
        return ts.dim_sector(self.spark, self.sf)

    @cached_property
    def dim_source(self) -> DataFrame:
        return ts.dim_source(self.spark, self.sf)

    @cached_property
    def pairs(self) -> DataFrame:
        return ts.pairs(self.spark, self.sf)

    # landed inputs
    @cached_property
    def macro_levels(self) -> DataFrame:
        return ts.macro_levels(self.spark, self.sf)

    @cached_property
    def commodity_levels(self) -> DataFrame:
        return ts.commodity_levels(self.spark, self.sf)

    @cached_property
    def equity_levels(self) -> DataFrame:
        return ts.equity_levels(self.spark, self.sf)

    # facts (Q07 / Q08)
    @cached_property
    def fact_macro_indicator(self) -> DataFrame:
        return se.macro_fact(self.macro_levels)

    @cached_property
    def fact_commodity_price(self) -> DataFrame:
        return se.commodity_fact(self.commodity_levels)

    @cached_property
    def fact_equity_valuation(self) -> DataFrame:
        return se.equity_fact(self.equity_levels)

    # articles
    @cached_property
    def fact_article(self) -> DataFrame:
        return ts.articles(self.spark, self.sf)

    @cached_property
    def bridge_article_country(self) -> DataFrame:
        return ts.article_country(self.spark, self.sf)

    @cached_property
    def bridge_article_sector(self) -> DataFrame:
        return ts.article_sector(self.spark, self.sf)

    # panel
    @cached_property
    def fact_macro_country(self) -> DataFrame:
        # the panel only uses country series: filtering the levels first lets
        # Catalyst drop the global-series scan (windows partition by country)
        return se.macro_fact(self.macro_levels.where(F.col("country_code").isNotNull()))

    @cached_property
    def macro_wide(self) -> DataFrame:
        return pn.macro_wide(self.fact_macro_country)

    def with_facts(self, macro: DataFrame, market: DataFrame) -> "Star":
        """A star whose panel reads the given landed facts."""
        other = Star(self.spark, self.sf)
        other.__dict__["fact_macro_indicator"] = macro
        other.__dict__["fact_macro_country"] = macro.where(F.col("country_code").isNotNull())
        other.__dict__["market"] = market
        return other

    @cached_property
    def market(self) -> DataFrame:
        """Both market targets per (sector, month) from one aggregate."""
        return se.market_changes(ts.market_levels(self.spark, self.sf))

    @cached_property
    def panel(self) -> DataFrame:
        return pn.build_panel(self.macro_wide, self.market, self.pairs)
