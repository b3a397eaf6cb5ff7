"""Reference data the operators depend on.

Everything here is small, fixed configuration.  Operators receive these values
as parameters (with these as defaults) so the same plans scale to any number of
countries, sectors, indicators or controls.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values that must equal the analysed application's for identical
# results.  Stated plainly and in their natural order.
# ---------------------------------------------------------------------------
RATE_INDICATORS = {"nominal": "policy_rate", "real": "real_interest_rate"}
RATE_BASES = ["nominal", "real"]
TARGETS = {
    "equity_valuation": "equity_valuation_change",
    "commodity_price": "commodity_price_change",
}
TARGET_NAMES = ["equity_valuation", "commodity_price"]
CANDIDATE_CONTROLS = [
    "fdi_net_inflow",
    "cpi_inflation",
    "gdp_growth",
    "unemployment_rate",
    "trade_balance",
    "reer",
    "gov_debt_pct_gdp",
]
LAGS = [0, 1, 2, 3]
MIN_OBS = 8
MIN_TRAIN_ROWS = 20
DAILY_EXTRACTION_BUDGET = 15
ARTICLE_LIMIT_DEFAULT = 50
ARTICLE_LIMIT_MAX = 200
RAW_RETENTION_DAYS = 30
STALE_AFTER_CONSECUTIVE_EMPTY = 5
FEED_TOP_N = 8
SIGNIFICANCE = 0.05
# strength bands on |r|: below 0.2 very weak, below 0.3 weak, below 0.5 moderate, else strong
STRENGTH_BANDS = [(0.2, "very weak"), (0.3, "weak"), (0.5, "moderate")]
STRENGTH_TOP = "strong"

COUNTRY_INDICATORS = [
    "policy_rate",
    "real_interest_rate",
    "fdi_net_inflow",
    "cpi_inflation",
    "gdp_growth",
    "unemployment_rate",
    "trade_balance",
    "reer",
    "gov_debt_pct_gdp",
]
GLOBAL_INDICATORS = ["fed_funds_rate_global", "usd_index", "treasury_yield_10y"]

# (indicator_id, indicator_name, unit, source_name, is_derived)
INDICATORS = [
    ("policy_rate", "Policy interest rate", "%", "BIS", False),
    ("real_interest_rate", "Real interest rate (policy_rate - cpi_inflation)", "%", "derived", True),
    ("fdi_net_inflow", "FDI net inflows", "% of GDP", "World Bank", False),
    ("cpi_inflation", "CPI inflation", "%", "World Bank WDI", False),
    ("gdp_growth", "GDP growth", "%", "World Bank WDI", False),
    ("unemployment_rate", "Unemployment rate", "%", "World Bank WDI", False),
    ("trade_balance", "Trade balance (net exports)", "% of GDP", "World Bank WDI", False),
    ("reer", "Real effective exchange rate", "index", "BIS", False),
    ("gov_debt_pct_gdp", "Government debt", "% of GDP", "World Bank WDI / IMF GFS", False),
    ("fed_funds_rate_global", "US Federal Funds Rate (global benchmark)", "%", "FRED", False),
    ("usd_index", "Trade-weighted US Dollar Index", "index", "FRED", False),
    ("treasury_yield_10y", "US 10-year Treasury yield", "%", "FRED", False),
]

# Tag vocabularies
ARTICLE_CATEGORIES = ["monetary_policy", "commodity_stocks"]
POLICY_SUBTYPES = ["interest_rate", "market_regulation", "export_control", "capital_controls"]
MECHANISM_IDS = ["cost_of_carry", "usd_value", "investment_substitution", "extraction_incentives"]
POLICY_STANCES = ["contractionary", "expansionary", "neutral"]
SOURCE_TYPES = ["central_bank", "mining_news", "semiconductor_news", "commodity_markets", "general_financial"]

# ---------------------------------------------------------------------------
# Our own defaults (not from the analysed application)
# ---------------------------------------------------------------------------
# rank keys are rounded so that differences below numerical noise become
# deterministic ties broken by the documented secondary keys
RANK_DECIMALS = 9
# output rounding used by registered queries so that two engines agree
OUT_DECIMALS = 6
