"""DuckDB twins of the plans, used as the correctness oracle.

Each registered query has an independent ANSI-SQL formulation here that DuckDB
runs on the driver tables (views ``lineitem``, ``orders``, ...).  The SQL is
written from the semantics, not generated from the Spark plans: the star
fixtures, the sweep and the rankings are restated as CTEs.

``with_ctes(body, *names)`` prefixes a query with the named CTEs and their
dependencies in order.
"""

from __future__ import annotations

from ..constants import (CANDIDATE_CONTROLS, COUNTRY_INDICATORS, LAGS, MIN_OBS, RANK_DECIMALS,
                         RATE_BASES, RATE_INDICATORS, TARGET_NAMES, TARGETS)
from ..sources.tpch_star import FIXTURE_SECTORS

_CTES: dict[str, tuple[list[str], str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    _CTES[name] = (deps, sql)


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    parts = [f"{n} AS (\n{_CTES[n][1]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def cc(expr: str) -> str:
    return f"('N' || lpad(CAST({expr} AS VARCHAR), CAST(greatest(2, length(CAST({expr} AS VARCHAR))) AS INTEGER), '0'))"


def month(expr: str) -> str:
    return f"CAST(date_trunc('month', {expr}) AS DATE)"


def rnd(expr: str, decimals: int = 6) -> str:
    """Same half-up rounding as registry.round_half_up."""
    scale = float(10 ** decimals)
    return (f"(CASE WHEN abs({expr}) * {scale} < {float(2 ** 53)} "
            f"THEN CAST(floor(({expr}) * {scale} + 0.5) AS DOUBLE) / {scale} ELSE ({expr}) END + 0.0)")


def r6(expr: str, alias: str) -> str:
    return f"{rnd(expr)} AS {alias}"


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# ------------------------------------------------------------------ fixtures
cte("s_dim_country", [], f"""
SELECT {cc('n.n_nationkey')} AS country_code, n.n_name AS country_name, r.r_name AS region
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey""")

cte("s_pairs", ["s_dim_country"], f"""
SELECT c.country_code, s.sector_id FROM s_dim_country c,
  (SELECT DISTINCT lower(p_type) AS sector_id FROM part) s""")

def cents(expr: str) -> str:
    return f"CAST(round({expr} * 100) AS BIGINT)"


def ratio(num: str, den: str) -> str:
    return f"(CAST({num} AS DOUBLE) / CAST(nullif({den}, 0) AS DOUBLE))"


cte("s_macro_country", [], f"""
SELECT {cc('c.c_nationkey')} AS country_code, {month('o.o_orderdate')} AS month,
       {ratio(f"sum({cents('l.l_discount')})", 'count(l.l_discount)')} AS policy_rate,
       {ratio(f"sum({cents('l.l_tax')})", 'count(l.l_tax)')} AS cpi_inflation,
       {ratio(f"sum({cents('o.o_totalprice')})", 'count(o.o_totalprice) * 100000')} AS gdp_growth,
       {ratio("100 * sum(CASE WHEN o.o_orderstatus = 'F' THEN 1 ELSE 0 END)",
              'count(o.o_orderstatus)')} AS unemployment_rate,
       {ratio(f"sum({cents('c.c_acctbal')})", 'count(c.c_acctbal) * 10000')} AS trade_balance,
       {ratio(f"sum(CASE WHEN l.l_quantity IS NOT NULL THEN {cents('l.l_extendedprice')} END)",
              f"sum(CASE WHEN l.l_extendedprice IS NOT NULL THEN {cents('l.l_quantity')} END)")}
         AS reer,
       {ratio(f"sum({cents('l.l_quantity')})", 'count(l.l_quantity) * 100')} AS fdi_net_inflow,
       {ratio("100 * sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END)",
              'count(l.l_returnflag)')} AS gov_debt_pct_gdp
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY 1, 2""")

cte("s_macro_global", [], f"""
SELECT {month('l_shipdate')} AS month,
       {ratio(f"sum({cents('l_quantity')})", 'count(l_quantity) * 100')} AS usd_index,
       {ratio(f"sum({cents('l_tax')})", 'count(l_tax)')} AS treasury_yield_10y,
       {ratio(f"sum({cents('l_discount')})", 'count(l_discount)')} AS fed_funds_rate_global
FROM lineitem GROUP BY 1""")

_country_inds = ["policy_rate", "cpi_inflation", "gdp_growth", "unemployment_rate",
                 "trade_balance", "reer", "fdi_net_inflow", "gov_debt_pct_gdp"]
_global_inds = ["usd_index", "treasury_yield_10y", "fed_funds_rate_global"]
cte("s_macro_levels", ["s_macro_country", "s_macro_global"], "\nUNION ALL\n".join(
    [f"SELECT country_code, month, '{i}' AS indicator_id, {i} AS value, "
     f"false AS is_interpolated FROM s_macro_country WHERE {i} IS NOT NULL" for i in _country_inds]
    + [f"SELECT CAST(NULL AS VARCHAR) AS country_code, month, '{i}' AS indicator_id, "
       f"{i} AS value, false AS is_interpolated FROM s_macro_global "
       f"WHERE {i} IS NOT NULL" for i in _global_inds]))

cte("s_real_rate", ["s_macro_levels"], """
SELECT country_code, month, 'real_interest_rate' AS indicator_id, n - i AS value,
       false AS is_interpolated
FROM (SELECT country_code, month,
             max(CASE WHEN indicator_id = 'policy_rate' THEN value END) AS n,
             max(CASE WHEN indicator_id = 'cpi_inflation' THEN value END) AS i
      FROM s_macro_levels
      WHERE country_code IS NOT NULL AND indicator_id IN ('policy_rate', 'cpi_inflation')
      GROUP BY 1, 2) t
WHERE n IS NOT NULL AND i IS NOT NULL""")

cte("s_macro_fact", ["s_macro_levels", "s_real_rate"], """
SELECT indicator_id || '|' || coalesce(country_code, 'GLOBAL') || '|' || strftime(month, '%Y-%m')
         AS record_id,
       strftime(month, '%Y-%m') AS date_key, month, country_code, indicator_id, value,
       value - lag(value) OVER (PARTITION BY country_code, indicator_id ORDER BY month)
         AS value_change,
       is_interpolated
FROM (SELECT * FROM s_macro_levels UNION ALL SELECT * FROM s_real_rate) u""")

cte("s_sector_month", [], f"""
SELECT lower(p.p_type) AS sector_id, {month('l.l_shipdate')} AS month,
       {ratio(f"sum(CASE WHEN l.l_quantity IS NOT NULL THEN {cents('l.l_extendedprice')} END)",
              f"sum(CASE WHEN l.l_extendedprice IS NOT NULL THEN {cents('l.l_quantity')} END)")}
         AS price_index,
       {ratio(f"sum({cents('l.l_extendedprice')} * (100 - {cents('l.l_discount')}))", '10000')}
         AS valuation_index
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2""")

cte("s_commodity_fact", ["s_sector_month"], """
SELECT sector_id || '|' || strftime(month, '%Y-%m') AS price_id,
       strftime(month, '%Y-%m') AS date_key, month, sector_id, price_index,
       (price_index / nullif(lag(price_index) OVER (PARTITION BY sector_id ORDER BY month), 0)
        - 1) * 100 AS price_change,
       CAST(NULL AS DOUBLE) AS production_volume_change
FROM s_sector_month WHERE price_index IS NOT NULL""")

cte("s_equity_fact", ["s_sector_month"], """
SELECT sector_id || '|' || strftime(month, '%Y-%m') AS valuation_id,
       strftime(month, '%Y-%m') AS date_key, month, sector_id,
       'sector_etf' AS instrument_type, valuation_index,
       (valuation_index / nullif(lag(valuation_index) OVER (PARTITION BY sector_id ORDER BY month),
                                 0) - 1) * 100 AS valuation_change
FROM s_sector_month WHERE valuation_index IS NOT NULL""")

cte("s_wide", ["s_macro_fact"], "SELECT country_code, month,\n" + ",\n".join(
    f"  max(CASE WHEN indicator_id = '{i}' THEN value_change END) AS {i}"
    for i in COUNTRY_INDICATORS) + f"""
FROM s_macro_fact
WHERE country_code IS NOT NULL AND value_change IS NOT NULL
  AND indicator_id IN ({sql_list(COUNTRY_INDICATORS)})
GROUP BY 1, 2""")

cte("s_panel", ["s_pairs", "s_wide", "s_commodity_fact", "s_equity_fact"], """
SELECT p.country_code, p.sector_id, w.* EXCLUDE (country_code),
       cp.price_change AS commodity_price_change,
       ev.valuation_change AS equity_valuation_change,
       CAST(row_number() OVER (PARTITION BY p.country_code, p.sector_id ORDER BY w.month) - 1
            AS DOUBLE) AS time_index
FROM s_pairs p JOIN s_wide w ON p.country_code = w.country_code
LEFT JOIN s_commodity_fact cp ON cp.sector_id = p.sector_id AND cp.month = w.month
LEFT JOIN s_equity_fact ev ON ev.sector_id = p.sector_id AND ev.month = w.month""")


# ------------------------------------------------------- correlation sweep
def leads_sql(panel: str) -> str:
    leads = ",\n".join(
        f"  lead({TARGETS[t]}, {k}) OVER (PARTITION BY country_code, sector_id ORDER BY month)"
        f" AS {TARGETS[t]}__lead{k}" for t in TARGET_NAMES for k in LAGS)
    return f"""
SELECT *,
{leads},
  count(*) OVER (PARTITION BY country_code, sector_id) AS panel_n,
  min(month) OVER (PARTITION BY country_code, sector_id) AS panel_start,
  max(month) OVER (PARTITION BY country_code, sector_id) AS panel_end
FROM {panel}"""


def _cfg_values(bases, targets, lags, controls) -> str:
    rows = []
    for bi, b in enumerate(bases):
        for ti, t in enumerate(targets):
            for li, lag in enumerate(lags):
                for ci, c in enumerate([""] + list(controls)):
                    rows.append(f"('{b}', {bi + 1}, '{t}', {ti * len(lags) + li + 1}, {lag}, "
                                f"'{c}', {ci})")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) +
            ") t(rate_basis, bi, target_variable, yi, lag, control, control_pos)")


def _case(idx: str, cols: list[str]) -> str:
    if not cols:
        return "CAST(NULL AS DOUBLE)"
    return f"CASE {idx} " + " ".join(f"WHEN {i + 1} THEN {c}" for i, c in enumerate(cols)) + " END"


def _div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


def _sqrt0(x: str) -> str:
    return f"sqrt(greatest({x}, 0))"


def _corr(c: str, va: str, vb: str) -> str:
    return _div(c, _sqrt0(f"{va} * {vb}"))


def _partial(rxy: str, rxz: str, ryz: str) -> str:
    return _div(f"{rxy} - {rxz} * {ryz}", _sqrt0(f"(1 - {rxz} * {rxz}) * (1 - {ryz} * {ryz})"))


def pvalue_sql(r: str, df: str) -> str:
    """Two-sided p of a correlation with integer df, same finite series as
    functions.stats.r_pvalue, written with Gamma ratios."""
    c = f"greatest(0.0, least(1.0, 1 - ({r}) * ({r})))"
    s = f"abs({r})"
    even = (f"coalesce(list_sum(list_transform(range(0, CAST({df} AS BIGINT) // 2), "
            f"lambda k: pow({c}, k) * exp(lgamma(k + 0.5) - lgamma(0.5) - lgamma(k + 1)))), 0)")
    odd = (f"coalesce(list_sum(list_transform(range(0, (CAST({df} AS BIGINT) - 1) // 2), "
           f"lambda k: pow({c}, k) * exp(lgamma(k + 1) + lgamma(1.5) - lgamma(k + 1.5)))), 0)")
    a = (f"CASE WHEN CAST({df} AS BIGINT) % 2 = 0 THEN {s} * {even} "
         f"ELSE 2 / pi() * (asin(least({s}, 1.0)) + {s} * sqrt({c}) * {odd}) END")
    return (f"(CASE WHEN ({r}) IS NULL OR ({df}) IS NULL OR ({df}) <= 0 THEN CAST(NULL AS DOUBLE) "
            f"WHEN {c} <= 0 THEN 0.0 ELSE greatest(0.0, least(1.0, 1 - ({a}))) END)")


def correlate_sql(leads: str, controls: list[str] | None = None,
                  bases=RATE_BASES, targets=TARGET_NAMES, lags=LAGS,
                  min_obs: int = MIN_OBS) -> str:
    """SQL body (a SELECT over CTE ``leads``) of the correlation sweep."""
    search = controls is None
    use = list(CANDIDATE_CONTROLS) if search else list(controls[:1])
    x = _case("c.bi", [RATE_INDICATORS[b] for b in bases])
    y = _case("c.yi", [f"{TARGETS[t]}__lead{k}" for t in targets for k in lags])
    z = _case("c.control_pos", use)
    g = "country_code, sector_id, rate_basis, target_variable, lag"
    rk = f"round(abs(partial1), {RANK_DECIMALS})"
    cand = ("control_pos > 0" + (f" AND n >= {min_obs} AND partial1 IS NOT NULL" if search else ""))
    return f"""
, obs AS (
  SELECT l.country_code, l.sector_id, l.panel_start, l.panel_end, c.rate_basis,
         c.target_variable, CAST(c.lag AS BIGINT) AS lag, c.control, c.control_pos,
         {x} AS x, {y} AS y, {z} AS z, l.time_index AS t
  FROM {leads} l, ({_cfg_values(bases, targets, lags, use)}) c
  WHERE l.panel_n >= {min_obs}
), mom AS (
  SELECT {g}, control, control_pos, panel_start, panel_end, count(*) AS n,
         var_samp(x) AS vx, var_samp(y) AS vy, var_samp(z) AS vz, var_samp(t) AS vt,
         covar_samp(x, y) AS cxy, covar_samp(x, z) AS cxz, covar_samp(y, z) AS cyz,
         covar_samp(x, t) AS cxt, covar_samp(y, t) AS cyt, covar_samp(z, t) AS czt
  FROM obs
  WHERE x IS NOT NULL AND y IS NOT NULL AND (z IS NOT NULL OR control_pos = 0)
  GROUP BY ALL
), r1 AS (
  SELECT *, {_corr('cxy', 'vx', 'vy')} AS r_xy, {_corr('cxz', 'vx', 'vz')} AS r_xz,
         {_corr('cyz', 'vy', 'vz')} AS r_yz, {_corr('cxt', 'vx', 'vt')} AS r_xt,
         {_corr('cyt', 'vy', 'vt')} AS r_yt, {_corr('czt', 'vz', 'vt')} AS r_zt
  FROM mom
), r2 AS (
  SELECT *, {_partial('r_xy', 'r_xz', 'r_yz')} AS partial1,
         {_partial('r_xy', 'r_xt', 'r_yt')} AS xy_t, {_partial('r_xz', 'r_xt', 'r_zt')} AS xz_t,
         {_partial('r_yz', 'r_yt', 'r_zt')} AS yz_t,
         {_div('r_xy * r_xy + r_yz * r_yz - 2 * r_xy * r_yz * r_xz', '1 - r_xz * r_xz')} AS r2
  FROM r1
), r3 AS (
  SELECT *, {_partial('xy_t', 'xz_t', 'yz_t')} AS partial2, ({cand}) AS is_cand FROM r2
), picked AS (
  SELECT *,
    max(CASE WHEN control_pos = 0 THEN n END) OVER (PARTITION BY {g}) AS n_obs,
    max(CASE WHEN control_pos = 0 THEN r_xy END) OVER (PARTITION BY {g}) AS pearson_r,
    row_number() OVER (PARTITION BY {g} ORDER BY is_cand DESC, {rk} DESC NULLS LAST,
      CASE WHEN {rk} > 0 AND {rk} < 1 THEN -n ELSE 0 END ASC, control_pos ASC) AS rk
  FROM r3
), rows_ AS (
  SELECT {g}, panel_start, panel_end, n_obs,
    CASE WHEN is_cand THEN control ELSE '' END AS control_set, pearson_r,
    CASE WHEN is_cand THEN coalesce(partial2, pearson_r) ELSE pearson_r END AS partial_r,
    CASE WHEN is_cand THEN coalesce(r2, pearson_r * pearson_r) ELSE pearson_r * pearson_r END
      AS r_squared,
    CASE WHEN is_cand THEN n END AS n_control,
    CASE WHEN is_cand THEN partial1 END AS partial_r_select
  FROM picked WHERE rk = 1 AND n_obs >= {min_obs} AND pearson_r IS NOT NULL
), best AS (
  SELECT *, row_number() OVER (PARTITION BY country_code, sector_id, rate_basis, target_variable
                               ORDER BY round(abs(pearson_r), {RANK_DECIMALS}) DESC, lag ASC) AS lrk
  FROM rows_
), result AS (
  SELECT {g}, panel_start, panel_end, n_obs, control_set, pearson_r, partial_r,
         {pvalue_sql('pearson_r', 'n_obs - 2')} AS p_value, r_squared, n_control,
         partial_r_select, {pvalue_sql('partial_r_select', 'n_control - 3')} AS partial_p_select
  FROM best WHERE lrk = 1
)"""


CORR_OUT = ["country_code", "sector_id", "rate_basis", "target_variable", "CAST(lag AS BIGINT) AS lag",
            "panel_start", "panel_end", "CAST(n_obs AS BIGINT) AS n_obs", "control_set",
            r6("pearson_r", "pearson_r"), r6("partial_r", "partial_r"), r6("p_value", "p_value"),
            r6("r_squared", "r_squared")]

cte("s_leads", ["s_panel"], leads_sql("s_panel"))


def q01_sql() -> str:
    return with_ctes(correlate_sql("s_leads") + f"\nSELECT {', '.join(CORR_OUT)} FROM result",
                     "s_leads")
