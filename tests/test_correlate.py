"""The distributed sweep (Q01 core) against a brute-force per-pair loop on
small random panels with gaps, nulls, a short pair and a constant control."""

from __future__ import annotations

import math
from datetime import date

import numpy as np
import pandas as pd

from ratelens.constants import CANDIDATE_CONTROLS, LAGS, MIN_OBS, RATE_INDICATORS, TARGETS
from ratelens.operators import correlate as co
from ratelens.operators import panel as pn

COLS = ["policy_rate", "real_interest_rate"] + CANDIDATE_CONTROLS + list(TARGETS.values())


def _panels(seed: int = 3) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    frames = []
    for p, n in enumerate([40, 25, 12, 7, 30]):
        months = [date(2000 + (m // 12), m % 12 + 1, 1) for m in range(n)]
        data = {c: rng.normal(size=n) for c in COLS}
        data["equity_valuation_change"] = 0.4 * data["policy_rate"] + rng.normal(size=n)
        df = pd.DataFrame(data)
        mask = rng.random(size=(n, len(COLS))) < 0.08
        df = df.mask(mask)
        if p == 1:
            df["reer"] = 1.5  # constant control
        df.insert(0, "month", months)
        df.insert(0, "sector_id", f"s{p % 2}")
        df.insert(0, "country_code", f"C{p}")
        df["time_index"] = np.arange(n, dtype=float)
        frames.append(df)
    return pd.concat(frames, ignore_index=True)


def _partial(data: np.ndarray) -> float:
    cov = np.cov(data, rowvar=False)
    if np.any(np.diag(cov) <= 0):
        return float("nan")
    p = np.linalg.inv(cov)
    return float(-p[0, 1] / math.sqrt(p[0, 0] * p[1, 1]))


def _brute(panel: pd.DataFrame) -> dict:
    out = {}
    for (cc, sec), g in panel.groupby(["country_code", "sector_id"]):
        g = g.sort_values("month").reset_index(drop=True)
        if len(g) < MIN_OBS:
            continue
        for basis, xcol in RATE_INDICATORS.items():
            for target, ycol in TARGETS.items():
                best = None
                for lag in LAGS:
                    d = g.assign(ys=g[ycol].shift(-lag))
                    sub = d.dropna(subset=[xcol, "ys"])
                    if len(sub) < MIN_OBS:
                        continue
                    r = float(np.corrcoef(sub[xcol], sub["ys"])[0, 1])
                    chosen, cbest = None, None
                    for pos, c in enumerate(CANDIDATE_CONTROLS):
                        cs = sub.dropna(subset=[c])
                        if len(cs) < MIN_OBS:
                            continue
                        pr = _partial(cs[[xcol, "ys", c]].to_numpy())
                        if not np.isfinite(pr):
                            continue
                        key = (-round(abs(pr), 9), -len(cs), pos)
                        if cbest is None or key < cbest:
                            chosen, cbest = c, key
                    if chosen:
                        cs = sub.dropna(subset=[chosen])
                        pr2 = _partial(cs[[xcol, "ys", chosen, "time_index"]].to_numpy())
                        design = np.column_stack([np.ones(len(cs)), cs[xcol], cs[chosen]])
                        beta, *_ = np.linalg.lstsq(design, cs["ys"], rcond=None)
                        resid = cs["ys"] - design @ beta
                        r2 = 1 - float(resid @ resid) / float(((cs["ys"] - cs["ys"].mean()) ** 2).sum())
                    else:
                        pr2, r2 = r, r * r
                    cand = dict(lag=lag, pearson_r=r, partial_r=pr2, r_squared=r2, n_obs=len(sub),
                                control_set=chosen or "")
                    if best is None or round(abs(r), 9) > round(abs(best["pearson_r"]), 9):
                        best = cand
                if best:
                    out[(cc, sec, basis, target)] = best
    return out


def test_sweep_matches_brute_force(spark):
    panel = _panels()
    sdf = spark.createDataFrame(panel)
    res = co.correlate(pn.with_leads(sdf)).toPandas()
    expect = _brute(panel)
    got = {(r.country_code, r.sector_id, r.rate_basis, r.target_variable): r
           for r in res.itertuples()}
    assert set(got) == set(expect)
    assert not any(k[0] == "C3" for k in got)  # 7-month pair is below the guard
    for k, e in expect.items():
        g = got[k]
        assert g.lag == e["lag"], k
        assert g.control_set == e["control_set"], k
        assert g.n_obs == e["n_obs"], k
        for f in ("pearson_r", "partial_r", "r_squared"):
            assert abs(getattr(g, f) - e[f]) < 1e-9, (k, f)
    # the constant control never wins
    assert "reer" not in set(res.loc[res.country_code == "C1", "control_set"])


def test_window_filter_cuts_leads(spark):
    panel = _panels()
    sdf = spark.createDataFrame(panel)
    win = pn.month_window(sdf, "2000-01", "2000-12")
    leads = pn.with_leads(win).where("country_code = 'C0'").orderBy("month").toPandas()
    assert len(leads) == 12
    # the lead-1 target of the last month in the window is null (beyond the end)
    assert pd.isna(leads["equity_valuation_change__lead1"].iloc[-1])


def test_explicit_control_override(spark):
    panel = _panels()
    sdf = spark.createDataFrame(panel)
    res = co.correlate(pn.with_leads(sdf), controls=["gdp_growth"]).toPandas()
    assert set(res["control_set"]) <= {"gdp_growth", ""}
    assert (res["control_set"] == "gdp_growth").any()
