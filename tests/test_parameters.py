"""Unknown parameter values are errors, known ones are not."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from ratelens.plans.correlation import check_pair, correlation


def test_unknown_country_sector_and_pair(spark):
    star = SimpleNamespace(
        dim_country=spark.createDataFrame([("N01",), ("N02",)], "country_code string"),
        dim_sector=spark.createDataFrame([("promo",), ("large",)], "sector_id string"),
        pairs=spark.createDataFrame([("N01", "promo"), ("N02", "large")], "country_code string, sector_id string"))
    check_pair(star, None, None)
    check_pair(star, "N01", None)
    check_pair(star, "N01", "promo")
    for country, sector, what in (("N99", None, "country"), ("", None, "country"), (None, "gold", "sector"),
                                  ("N01", "large", "pair")):
        with pytest.raises(ValueError, match=what):
            check_pair(star, country, sector)
        with pytest.raises(ValueError, match=what):
            correlation(star, country=country, sector=sector)
    for bad in ({"control": "moon"}, {"rate_basis": "x"}, {"target": "x"}):
        with pytest.raises(ValueError):
            correlation(star, **bad)
