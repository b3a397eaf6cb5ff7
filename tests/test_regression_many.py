"""Regression on any controls against numpy, and exports by scope."""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pytest

from ratelens.operators import regression as rg
from ratelens.plans.export import export, export_rows


def _frame(spark, k: int, n: int = 60, seed: int = 3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, k + 1)) * np.arange(1, k + 2) + 5
    y = x @ rng.normal(size=k + 1) + rng.normal(size=n) + 2
    names = ["x"] + [f"z{i + 1}" for i in range(k)]
    rows = [("a", *map(float, r), float(v)) for r, v in zip(x, y)]
    return names, x, y, spark.createDataFrame(rows, ["g", *names, "y"])


@pytest.mark.parametrize("k", [1, 2, 7])
def test_any_controls_against_numpy(spark, k):
    names, x, y, df = _frame(spark, k)
    design = np.column_stack([np.ones(len(y)), x])
    inverse = np.linalg.inv(design.T @ design)
    beta = inverse @ design.T @ y
    rest = y - design @ beta
    dof = len(y) - k - 2
    se = np.sqrt(rest @ rest / dof * np.diag(inverse))
    r2 = 1 - rest @ rest / ((y - y.mean()) @ (y - y.mean()))
    got = {r["term"]: r for r in rg.ols_many(df, names, ["g"]).collect()}
    for i, name in enumerate(["intercept", *names]):
        r = got[name]
        assert r["n"] == len(y)
        np.testing.assert_allclose([r["coef"], r["se"], r["T"], r["r2"]], [beta[i], se[i], beta[i] / se[i], r2], rtol=1e-8)
        assert r["adj_r2"] == pytest.approx(1 - (1 - r2) * (len(y) - 1) / dof)
    # partial r by residuals on the controls
    z = np.column_stack([np.ones(len(y)), x[:, 1:]])
    def clean(v):
        return v - z @ np.linalg.lstsq(z, v, rcond=None)[0]
    want = np.corrcoef(clean(x[:, 0]), clean(y))[0, 1]
    assert got["x"]["partial_r"] == pytest.approx(want, rel=1e-8)
    one = rg.multi_control(df, k, ["g"]).collect()[0]
    assert one["partial_r"] == pytest.approx(want, rel=1e-8)
    assert one["r_squared"] == pytest.approx(r2, rel=1e-8)
    assert one["partial_p"] == pytest.approx(got["x"]["pval"], rel=1e-6)


def test_singular_constant_and_short_groups(spark):
    rows = [("twin", float(i), 2.0 * i + 1, float(i * i % 7)) for i in range(20)]
    rows += [("flat", float(i), 4.0, float(i * i % 7)) for i in range(20)]
    rows += [("short", 1.0, 2.0, 3.0), ("short", 2.0, 1.0, 3.5), ("short", None, 1.0, 3.5)]
    df = spark.createDataFrame(rows, ["g", "x", "z1", "y"])
    got = rg.ols_many(df, ["x", "z1"], ["g"]).collect()
    assert {r["g"] for r in got} == {"twin", "flat"}
    assert all(r["coef"] is None and r["se"] is None and r["r2"] is None for r in got)
    assert all(r["partial_r"] is None for r in rg.multi_control(df, 1, ["g"]).collect())
    assert rg.ols_many(df.limit(0), ["x", "z1"], ["g"]).count() == 0


def test_time_term(spark):
    import datetime as dt
    rows = [("a", dt.date(2020 + i // 12, i % 12 + 1, 1), float((i * 7) % 5), 0.5 * i + (i * 7) % 5 + ((i * 11) % 3) * 0.1)
            for i in range(40)]
    df = rg.with_time(spark.createDataFrame(rows, "g string, month date, x double, y double"))
    got = {r["term"]: r["coef"] for r in rg.ols_many(df, ["x", "t"], ["g"], names={"t": "time"}).collect()}
    assert got["t"] == pytest.approx(0.5, abs=0.01) and got["x"] == pytest.approx(1.0, abs=0.05)


RESULTS = ("result_id string, country_code string, sector_id string, rate_basis string, target_variable string, "
           "control_set string, date_range_start date, date_range_end date, lag int, pearson_r double, "
           "partial_r double, p_value double, r_squared double, computed_at timestamp_ntz")


def test_export_scopes_and_filters(spark, tmp_path):
    import datetime as dt
    star = SimpleNamespace(
        dim_country=spark.createDataFrame([("N01",), ("N02",)], "country_code string"),
        dim_sector=spark.createDataFrame([("promo",)], "sector_id string"),
        pairs=spark.createDataFrame([("N01", "promo")], "country_code string, sector_id string"),
        fact_article=spark.createDataFrame(
            [("a1", 't, "q"', "commodity_stocks", 0.25, "u1", dt.datetime(2024, 1, 5, 1, 2, 3, 456789)),
             ("a2", "", "commodity_stocks", None, "u2", dt.datetime(2024, 2, 5))],
            "article_id string, title string, article_category string, sentiment_score double, source_url string, "
            "published timestamp_ntz"),
        bridge_article_country=spark.createDataFrame([("a1", "N01"), ("a1", "N02"), ("a2", "N01")],
                                                     "article_id string, country_code string"),
        bridge_article_sector=spark.createDataFrame([("a1", "promo")], "article_id string, sector_id string"))

    def result(rid, basis, day, control=""):
        return (rid, "N01", "promo", basis, "t", control, None, None, 1, 0.1 + 0.2, None, 0.5, 0.25, dt.datetime(2024, 1, day))
    history = spark.createDataFrame([result("r1", "real", 1), result("r2", "real", 2, "cpi,gdp"), result("r0", "real", 2),
                                     result("r3", "nominal", 1)], RESULTS)
    back = export(spark, star, str(tmp_path / "r"), "correlation", history=history, country="N01", sector="promo",
                  rate_basis="real").collect()
    assert [(r["result_id"], r["control_set"], r["pearson_r"], r["partial_r"]) for r in back] == [("r2", "cpi,gdp", 0.1 + 0.2, None)]
    assert export_rows(star, "correlation", history=history).count() == 2
    got = export(spark, star, str(tmp_path / "a"), "articles", country="N01", end="2024-01-31").collect()
    assert [(r["title"], r["published"]) for r in got] == [('t, "q"', dt.datetime(2024, 1, 5, 1, 2, 3, 456789))]
    assert export_rows(star, "articles").count() == 2 and export_rows(star, "articles", sector="promo").count() == 1
    assert export(spark, star, str(tmp_path / "none"), "articles", start="2025-01-01") is None
    for bad in ({"scope": "x"}, {"scope": "articles", "country": "N99"}, {"scope": "correlation"},
                {"scope": "correlation", "history": history, "rate_basis": "x"}):
        with pytest.raises(ValueError):
            export_rows(star, **bad)
