"""Composite correlation queries.

Q01 ``correlation_batch``: every configured pair x basis x target, best lag,
empirically chosen control -- one distributed plan for all pairs.
Q02 ``correlation``: the same restricted to a month window (and optionally to
pairs / a basis / a target / an explicit control), plus the latest changes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import CANDIDATE_CONTROLS, RATE_INDICATORS, TARGETS
from ..operators import correlate as co
from ..operators import panel as pn
from .star import Star


def correlation_batch(star: Star, controls: Sequence[str] | None = None,
                      pairs: DataFrame | None = None) -> DataFrame:
    """Q01: one result row per (pair, basis, target) that has a lag with at
    least MIN_OBS joint observations."""
    panel = star.panel
    if pairs is not None:
        panel = panel.join(pairs.select(*pn.PAIR), pn.PAIR, "left_semi")
    return co.correlate(pn.with_leads(panel), controls=controls)


def check_pair(star: Star, country: str | None, sector: str | None) -> None:
    """A country or sector that no dimension has, or a pair that is not
    configured, is an error (each a lookup of at most one row)."""
    def known(df: DataFrame, **values: str | None) -> bool:
        for column, value in values.items():
            df = df.where(F.col(column) == F.lit(value))
        return df.limit(1).count() > 0

    if country is not None and not known(star.dim_country, country_code=country):
        raise ValueError(f"Invalid country: {country!r}")
    if sector is not None and not known(star.dim_sector, sector_id=sector):
        raise ValueError(f"Invalid sector: {sector!r}")
    if country is not None and sector is not None and not known(star.pairs, country_code=country, sector_id=sector):
        raise ValueError(f"Invalid pair: {country!r}, {sector!r}")


def correlation(star: Star, country: str | None = None, sector: str | None = None,
                rate_basis: str | None = None, target: str | None = None,
                control: str | None = None, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """Q02: correlation over a month window with optional filters and an
    optional explicit control, plus the latest rate / target change of the
    windowed panel (W09)."""
    if control is not None and control not in CANDIDATE_CONTROLS:
        raise ValueError(f"Invalid control: {control!r}")
    if rate_basis is not None and rate_basis not in RATE_INDICATORS:
        raise ValueError(f"Invalid rate_basis: {rate_basis!r}")
    if target is not None and target not in TARGETS:
        raise ValueError(f"Invalid target: {target!r}")
    check_pair(star, country, sector)
    panel = star.panel
    if country is not None:
        panel = panel.where(F.col("country_code") == country)
    if sector is not None:
        panel = panel.where(F.col("sector_id") == sector)
    panel = pn.month_window(panel, start, end)
    bases = [rate_basis] if rate_basis else list(RATE_INDICATORS)
    targets = [target] if target else list(TARGETS)
    best = co.correlate(pn.with_leads(panel), controls=[control] if control else None,
                        bases=bases, targets=targets)
    cols = sorted({RATE_INDICATORS[b] for b in bases} | {TARGETS[t] for t in targets})
    latest = pn.latest_row(panel, cols)
    rate_latest = co._pick(F.when(F.col("rate_basis") == "nominal", 1).otherwise(2),
                           [F.col(RATE_INDICATORS["nominal"]) if RATE_INDICATORS["nominal"] in cols
                            else F.lit(None).cast("double"),
                            F.col(RATE_INDICATORS["real"]) if RATE_INDICATORS["real"] in cols
                            else F.lit(None).cast("double")])
    tgt_latest = co._pick(F.when(F.col("target_variable") == "equity_valuation", 1).otherwise(2),
                          [F.col(TARGETS["equity_valuation"]) if TARGETS["equity_valuation"] in cols
                           else F.lit(None).cast("double"),
                           F.col(TARGETS["commodity_price"]) if TARGETS["commodity_price"] in cols
                           else F.lit(None).cast("double")])
    return (best.join(latest, pn.PAIR, "left")
            .select(*best.columns, rate_latest.alias("rate_change_latest"),
                    tgt_latest.alias("target_change_latest")))
