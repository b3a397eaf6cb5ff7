"""Registered queries of the correlation family (G03-G12, G26-G28, J03, J04,
W03-W07, W09, W14, P04-P06, K02, T02, T03, Q01-Q02, F22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import COUNTRY_INDICATORS, MIN_OBS, RATE_INDICATORS, TARGETS
from ..functions import stats as st
from ..operators import correlate as co
from ..operators import panel as pn
from ..sinks import tables as sink
from ..session import scratch_path
from . import oracle as O
from .correlation import correlation, correlation_batch
from .registry import finish, register
from .star import Star

G = ["country_code", "sector_id", "rate_basis", "target_variable", "lag"]
KEYS4 = ["country_code", "sector_id", "rate_basis", "target_variable"]
TGT = [TARGETS["equity_valuation"], TARGETS["commodity_price"]]
WIN_START, WIN_END = "1996-01", "2000-12"
RUN_A = ("run-a", "2024-01-01 00:00:00")
RUN_B = ("run-b", "2024-02-01 00:00:00")


def _stats(spark, sf) -> DataFrame:
    star = Star(spark, sf)
    return co.moment_stats(co.sweep_moments(pn.with_leads(star.panel)))


def _sweep_sql(select: str) -> str:
    return O.with_ctes(O.correlate_sql("s_leads") + "\n" + select, "s_leads")


# ----------------------------------------------------------- panel building
@register("g03_pivot_changes", lambda: O.with_ctes(
    "SELECT country_code, month, " + ", ".join(O.r6(i, i) for i in COUNTRY_INDICATORS)
    + " FROM s_wide", "s_wide"))
def g03(spark: SparkSession, sf: str) -> DataFrame:
    return finish(Star(spark, sf).macro_wide)


@register("j03_panel", lambda: O.with_ctes(
    "SELECT country_code, sector_id, month, " + ", ".join(
        O.r6(i, i) for i in COUNTRY_INDICATORS + TGT) + ", time_index FROM s_panel", "s_panel"))
def j03(spark: SparkSession, sf: str) -> DataFrame:
    p = Star(spark, sf).panel
    return finish(p.select("country_code", "sector_id", "month", *COUNTRY_INDICATORS, *TGT,
                           "time_index"))


@register("j04_pair_fanout", lambda: O.with_ctes("""
SELECT country_code, sector_id, count(*) AS panel_n,
       count(commodity_price_change) AS n_price, count(equity_valuation_change) AS n_valuation
FROM s_panel GROUP BY 1, 2""", "s_panel"))
def j04(spark: SparkSession, sf: str) -> DataFrame:
    p = Star(spark, sf).panel
    return finish(p.groupBy("country_code", "sector_id").agg(
        F.count(F.lit(1)).alias("panel_n"), F.count(TGT[1]).alias("n_price"),
        F.count(TGT[0]).alias("n_valuation")))


@register("w04_time_index", lambda: O.with_ctes(
    "SELECT country_code, sector_id, month, time_index FROM s_panel", "s_panel"))
def w04(spark: SparkSession, sf: str) -> DataFrame:
    return finish(Star(spark, sf).panel.select("country_code", "sector_id", "month", "time_index"))


_LEAD_COLS = [f"{t}__lead{k}" for t in TGT for k in (1, 2, 3)]


@register("w03_lead", lambda: O.with_ctes(
    "SELECT country_code, sector_id, month, " + ", ".join(O.r6(c, c) for c in _LEAD_COLS)
    + " FROM s_leads", "s_leads"))
def w03(spark: SparkSession, sf: str) -> DataFrame:
    pl = pn.with_leads(Star(spark, sf).panel)
    return finish(pl.select("country_code", "sector_id", "month", *_LEAD_COLS))


@register("g06_coverage", lambda: O.with_ctes(f"""
, win AS (SELECT * FROM s_panel WHERE month BETWEEN DATE '{WIN_START}-01' AND DATE '{WIN_END}-01')
SELECT country_code, sector_id, min(month) AS date_range_start, max(month) AS date_range_end,
       count(*) AS panel_n FROM win GROUP BY 1, 2""", "s_panel"))
def g06(spark: SparkSession, sf: str) -> DataFrame:
    p = pn.month_window(Star(spark, sf).panel, WIN_START, WIN_END)
    return finish(p.groupBy("country_code", "sector_id").agg(
        F.min("month").alias("date_range_start"), F.max("month").alias("date_range_end"),
        F.count(F.lit(1)).alias("panel_n")))


@register("p04_month_window", lambda: O.with_ctes(f"""
SELECT country_code, sector_id, month, {O.r6('policy_rate', 'policy_rate')},
       {O.r6('commodity_price_change__lead1', 'commodity_price_change__lead1')}
FROM (SELECT *, lead(commodity_price_change, 1) OVER (PARTITION BY country_code, sector_id
                                                       ORDER BY month) AS commodity_price_change__lead1
      FROM s_panel WHERE month BETWEEN DATE '{WIN_START}-01' AND DATE '{WIN_END}-01') t""",
    "s_panel"))
def p04(spark: SparkSession, sf: str) -> DataFrame:
    p = pn.month_window(Star(spark, sf).panel, WIN_START, WIN_END)
    pl = pn.with_leads(p, lags=[1], targets=[TGT[1]])
    return finish(pl.select("country_code", "sector_id", "month", "policy_rate",
                            "commodity_price_change__lead1"))


@register("w09_latest_row", lambda: O.with_ctes("""
SELECT country_code, sector_id, """ + ", ".join(O.r6(c, c) for c in [
    "policy_rate", "real_interest_rate"] + TGT) + """
FROM (SELECT *, row_number() OVER (PARTITION BY country_code, sector_id ORDER BY month DESC) AS rn
      FROM s_panel) t WHERE rn = 1""", "s_panel"))
def w09(spark: SparkSession, sf: str) -> DataFrame:
    p = Star(spark, sf).panel
    return finish(pn.latest_row(p, ["policy_rate", "real_interest_rate"] + TGT))


# ------------------------------------------------------------- the sweep
@register("w14_lag_sweep", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "control, CAST(n AS BIGINT) AS n FROM mom"))
def w14(spark: SparkSession, sf: str) -> DataFrame:
    m = co.sweep_moments(pn.with_leads(Star(spark, sf).panel))
    return finish(m.select(*G, "control", "n"))


@register("p05_pairwise_deletion", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "CAST(n AS BIGINT) AS n_xy, " + O.r6("vx", "var_x") + ", " + O.r6("vy", "var_y")
    + " FROM mom WHERE control_pos = 0"))
def p05(spark: SparkSession, sf: str) -> DataFrame:
    m = co.sweep_moments(pn.with_leads(Star(spark, sf).panel), controls=[])
    return finish(m.select(*G, F.col("n").alias("n_xy"), F.col("vx").alias("var_x"),
                           F.col("vy").alias("var_y")))


@register("p06_min_obs_guard", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    f"control, CAST(n AS BIGINT) AS n FROM mom WHERE n >= {MIN_OBS}"))
def p06(spark: SparkSession, sf: str) -> DataFrame:
    m = co.sweep_moments(pn.with_leads(Star(spark, sf).panel))
    return finish(m.where(F.col("n") >= MIN_OBS).select(*G, "control", "n"))


@register("g07_pearson", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "CAST(n AS BIGINT) AS n, " + O.r6("r_xy", "pearson_r") + " FROM r3 WHERE control_pos = 0"))
def g07(spark: SparkSession, sf: str) -> DataFrame:
    s = _stats(spark, sf).where(F.col("control_pos") == 0)
    return finish(s.select(*G, "n", F.col("r_xy").alias("pearson_r")))


@register("g08_pvalue", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    + O.r6("r_xy", "pearson_r") + ", " + O.r6(O.pvalue_sql("r_xy", "n - 2"), "p_value")
    + " FROM r3 WHERE control_pos = 0"))
def g08(spark: SparkSession, sf: str) -> DataFrame:
    s = _stats(spark, sf).where(F.col("control_pos") == 0)
    return finish(s.select(*G, F.col("r_xy").alias("pearson_r"),
                           st.r_pvalue(F.col("r_xy"), F.col("n") - 2).alias("p_value")))


@register("g09_partial_r", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "control, CAST(n AS BIGINT) AS n, " + O.r6("partial1", "partial_r") + ", "
    + O.r6(O.pvalue_sql("partial1", "n - 3"), "partial_p") + " FROM r3 WHERE control_pos > 0"))
def g09(spark: SparkSession, sf: str) -> DataFrame:
    s = _stats(spark, sf).where(F.col("control_pos") > 0)
    return finish(s.select(*G, "control", "n", F.col("partial1").alias("partial_r"),
                           st.r_pvalue(F.col("partial1"), F.col("n") - 3).alias("partial_p")))


@register("g10_partial_r_trend", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "control, " + O.r6("partial2", "partial_r_trend") + " FROM r3 WHERE control_pos > 0"))
def g10(spark: SparkSession, sf: str) -> DataFrame:
    s = _stats(spark, sf).where(F.col("control_pos") > 0)
    return finish(s.select(*G, "control", F.col("partial2").alias("partial_r_trend")))


@register("g11_r_squared", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "control, " + O.r6("r2", "r_squared") + " FROM r3 WHERE control_pos > 0"))
def g11(spark: SparkSession, sf: str) -> DataFrame:
    s = _stats(spark, sf).where(F.col("control_pos") > 0)
    return finish(s.select(*G, "control", F.col("r2").alias("r_squared")))


@register("g12_fallback", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "control_set, " + O.r6("partial_r", "partial_r") + ", " + O.r6("r_squared", "r_squared")
    + ", (control_set = '' OR partial_r = pearson_r) AS used_fallback FROM rows_"))
def g12(spark: SparkSession, sf: str) -> DataFrame:
    """Per lag (before the lag choice): chosen control with the fallbacks
    partial := r and R^2 := r^2 applied."""
    star = Star(spark, sf)
    m = co.moment_stats(co.sweep_moments(pn.with_leads(star.panel)))
    picked = co.pick_control(m, True).where((F.col("n_obs") >= MIN_OBS)
                                            & F.col("pearson_r").isNotNull())
    has = F.col("is_cand")
    pr = F.when(has, F.coalesce("partial2", "pearson_r")).otherwise(F.col("pearson_r"))
    r2 = F.when(has, F.coalesce(F.col("r2"), F.col("pearson_r") ** 2)).otherwise(
        F.col("pearson_r") * F.col("pearson_r"))
    out = picked.select(*G, F.when(has, F.col("control")).otherwise(F.lit("")).alias("control_set"),
                        pr.alias("partial_r"), r2.alias("r_squared"), "pearson_r")
    return finish(out.select(*G, "control_set", "partial_r", "r_squared",
                             ((F.col("control_set") == "") | (F.col("partial_r") == F.col("pearson_r")))
                             .alias("used_fallback")))


@register("w06_best_control", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    "control_set, " + O.r6("partial_r_select", "partial_r_select")
    + " FROM rows_ WHERE control_set <> ''"))
def w06(spark: SparkSession, sf: str) -> DataFrame:
    m = _stats(spark, sf)
    picked = co.pick_control(m, True).where(F.col("is_cand") & (F.col("n_obs") >= MIN_OBS)
                                            & F.col("pearson_r").isNotNull())
    return finish(picked.select(*G, F.col("control").alias("control_set"),
                                F.col("partial1").alias("partial_r_select")))


@register("w07_best_lag", lambda: _sweep_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, CAST(lag AS BIGINT) AS lag, "
    + O.r6("pearson_r", "pearson_r") + " FROM result"))
def w07(spark: SparkSession, sf: str) -> DataFrame:
    b = correlation_batch(Star(spark, sf))
    return finish(b.select(*G, "pearson_r"))


# ------------------------------------------------------------- Q02
O.cte("s_panel_win", ["s_panel"],
      f"SELECT * FROM s_panel WHERE month BETWEEN DATE '{WIN_START}-01' AND DATE '{WIN_END}-01'")
O.cte("s_leads_win", ["s_panel_win"], O.leads_sql("s_panel_win"))


def _q02_sql() -> str:
    latest = """
, latest AS (
  SELECT country_code, sector_id, policy_rate, real_interest_rate, equity_valuation_change,
         commodity_price_change
  FROM (SELECT *, row_number() OVER (PARTITION BY country_code, sector_id ORDER BY month DESC) rn
        FROM s_panel_win) t WHERE rn = 1)"""
    sel = (f"SELECT {', '.join('r.' + c if not c.startswith('CAST') else c for c in ['country_code', 'sector_id', 'rate_basis', 'target_variable'])}, "
           "CAST(r.lag AS BIGINT) AS lag, r.panel_start, r.panel_end, CAST(r.n_obs AS BIGINT) AS n_obs, "
           "r.control_set, " + ", ".join(O.r6("r." + c, c) for c in
                                         ["pearson_r", "partial_r", "p_value", "r_squared"])
           + ", " + O.r6("CASE WHEN r.rate_basis = 'nominal' THEN l.policy_rate ELSE "
                         "l.real_interest_rate END", "rate_change_latest")
           + ", " + O.r6("CASE WHEN r.target_variable = 'equity_valuation' THEN "
                         "l.equity_valuation_change ELSE l.commodity_price_change END",
                         "target_change_latest")
           + " FROM result r LEFT JOIN latest l USING (country_code, sector_id)")
    return O.with_ctes(O.correlate_sql("s_leads_win", controls=["cpi_inflation"]) + latest
                       + "\n" + sel, "s_leads_win")


@register("q02_correlation_window", _q02_sql)
def q02(spark: SparkSession, sf: str) -> DataFrame:
    """Q02 over every pair: window 1996-01..2000-12 with the control pinned to
    cpi_inflation, plus the latest changes of the windowed panel."""
    r = correlation(Star(spark, sf), control="cpi_inflation", start=WIN_START, end=WIN_END)
    cols = ["country_code", "sector_id", "rate_basis", "target_variable", "lag", "panel_start",
            "panel_end", "n_obs", "control_set", "pearson_r", "partial_r", "p_value",
            "r_squared", "rate_change_latest", "target_change_latest"]
    return finish(r.select(*cols))


# ------------------------------------------------ result history (K02, W05..)
def _history(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs appended to a result table under the shared scratch folder:
    run A with the control pinned to cpi_inflation, run B with the search."""
    star = Star(spark, sf)
    a = co.result_rows(correlation_batch(star, controls=["cpi_inflation"]), *RUN_A)
    b = co.result_rows(correlation_batch(star), *RUN_B)
    path = scratch_path(spark, f"results-{sink.unique_suffix()}")
    sink.append_results(a, path)
    sink.append_results(b, path)
    return spark.read.parquet(path)


def _result_id_sql(run_id: str) -> str:
    return ("sha256('" + run_id + "' || '|' || country_code || '|' || sector_id || '|' || "
            "rate_basis || '|' || target_variable)")


def _runs_sql(select_from_hist: str) -> str:
    # two independent sweeps need distinct CTE names
    a = _rename(O.correlate_sql("s_leads", controls=["cpi_inflation"]), "a_")
    b = _rename(O.correlate_sql("s_leads"), "b_")
    hist = f"""
, hist AS (
  SELECT {_result_id_sql(RUN_A[0])} AS result_id, country_code, sector_id, rate_basis,
         target_variable, control_set, panel_start AS date_range_start,
         panel_end AS date_range_end, lag, pearson_r, partial_r, p_value, r_squared,
         TIMESTAMP '{RUN_A[1]}' AS computed_at FROM a_result
  UNION ALL
  SELECT {_result_id_sql(RUN_B[0])}, country_code, sector_id, rate_basis, target_variable,
         control_set, panel_start, panel_end, lag, pearson_r, partial_r, p_value, r_squared,
         TIMESTAMP '{RUN_B[1]}' FROM b_result)"""
    return O.with_ctes(a + b + hist + "\n" + select_from_hist, "s_leads")


_INNER = ["obs", "mom", "r1", "r2", "r3", "picked", "rows_", "best", "result"]


def _rename(sql: str, prefix: str) -> str:
    import re
    for name in _INNER:
        sql = re.sub(rf"\b{name}\b(?= AS \()", prefix + name, sql)
        sql = re.sub(rf"(FROM|JOIN) {name}\b", rf"\1 {prefix}{name}", sql)
    return sql


_HIST_COLS = ("result_id, country_code, sector_id, rate_basis, target_variable, control_set, "
              "date_range_start, date_range_end, CAST(lag AS BIGINT) AS lag, "
              f"{O.r6('pearson_r', 'pearson_r')}, {O.r6('r_squared', 'r_squared')}, computed_at")


@register("k02_append_results", lambda: _runs_sql(f"SELECT {_HIST_COLS} FROM hist"))
def k02(spark: SparkSession, sf: str) -> DataFrame:
    h = _history(spark, sf)
    return finish(h.select("result_id", "country_code", "sector_id", "rate_basis",
                           "target_variable", "control_set", "date_range_start",
                           "date_range_end", "lag", "pearson_r", "r_squared", "computed_at"))


@register("w05_latest_result", lambda: _runs_sql(f"""
SELECT {_HIST_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY country_code, sector_id,
  rate_basis, target_variable ORDER BY computed_at DESC) AS rn FROM hist) t WHERE rn = 1"""))
def w05(spark: SparkSession, sf: str) -> DataFrame:
    h = _history(spark, sf)
    w = Window.partitionBy(*KEYS4).orderBy(F.col("computed_at").desc(), "result_id")
    latest = h.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)
    return finish(latest.select("result_id", "country_code", "sector_id", "rate_basis",
                                "target_variable", "control_set", "date_range_start",
                                "date_range_end", "lag", "pearson_r", "r_squared", "computed_at"))


@register("t02_latest_for_filter", lambda: _runs_sql(f"""
SELECT country_code, sector_id, rate_basis, target_variable,
       arg_max(result_id, computed_at) AS result_id,
       {O.r6('arg_max(pearson_r, computed_at)', 'pearson_r')}, max(computed_at) AS computed_at
FROM hist GROUP BY 1, 2, 3, 4"""))
def t02(spark: SparkSession, sf: str) -> DataFrame:
    """Latest result per full result key (export lookup, filtered by every
    key and tie-broken by id -- never 'whichever target was written last')."""
    h = _history(spark, sf)
    latest = h.groupBy(*KEYS4).agg(
        F.max_by(F.struct("result_id", "pearson_r"), F.struct("computed_at", "result_id"))
        .alias("l"), F.max("computed_at").alias("computed_at"))
    return finish(latest.select(*KEYS4, "l.result_id", "l.pearson_r", "computed_at"))


@register("g28_strength_over_runs", lambda: _runs_sql(f"""
SELECT country_code, sector_id, rate_basis, target_variable, computed_at,
       {O.r6('pearson_r', 'pearson_r')},
       {O.r6("pearson_r - lag(pearson_r) OVER (PARTITION BY country_code, sector_id, rate_basis, target_variable ORDER BY computed_at)", 'delta_r')}
FROM hist"""))
def g28(spark: SparkSession, sf: str) -> DataFrame:
    h = _history(spark, sf)
    w = Window.partitionBy(*KEYS4).orderBy("computed_at")
    return finish(h.select(*KEYS4, "computed_at", "pearson_r",
                           (F.col("pearson_r") - F.lag("pearson_r").over(w)).alias("delta_r")))


@register("t03_order_by_r", lambda: O.q01_sql().replace(
    "FROM result", "FROM result ORDER BY pearson_r, country_code, sector_id, rate_basis, "
                   "target_variable"))
def t03(spark: SparkSession, sf: str) -> DataFrame:
    from .queries import CORR_COLS
    b = finish(correlation_batch(Star(spark, sf)).select(*CORR_COLS))
    return b.orderBy("pearson_r", "country_code", "sector_id", "rate_basis", "target_variable")


@register("g26_nominal_vs_real", lambda: O.with_ctes(O.correlate_sql("s_leads") + """
SELECT country_code, sector_id, target_variable,
  """ + O.r6("max(CASE WHEN rate_basis = 'nominal' THEN pearson_r END)", "r_nominal") + """,
  """ + O.r6("max(CASE WHEN rate_basis = 'real' THEN pearson_r END)", "r_real") + """,
  """ + O.r6("max(CASE WHEN rate_basis = 'nominal' THEN pearson_r END) - max(CASE WHEN rate_basis = 'real' THEN pearson_r END)", "divergence") + """
FROM result GROUP BY 1, 2, 3""", "s_leads"))
def g26(spark: SparkSession, sf: str) -> DataFrame:
    b = correlation_batch(Star(spark, sf))
    nom = F.max(F.when(F.col("rate_basis") == "nominal", F.col("pearson_r")))
    real = F.max(F.when(F.col("rate_basis") == "real", F.col("pearson_r")))
    return finish(b.groupBy("country_code", "sector_id", "target_variable").agg(
        nom.alias("r_nominal"), real.alias("r_real"), (nom - real).alias("divergence")))


REGIME_SPLIT = "1998-07-01"
O.cte("s_panel_regime", ["s_panel"], f"""
SELECT * EXCLUDE (sector_id, time_index),
       sector_id || '#' || CASE WHEN month < DATE '{REGIME_SPLIT}' THEN 'before' ELSE 'after' END
         AS sector_id,
       CAST(row_number() OVER (PARTITION BY country_code, sector_id,
            month < DATE '{REGIME_SPLIT}' ORDER BY month) - 1 AS DOUBLE) AS time_index
FROM s_panel""")
O.cte("s_leads_regime", ["s_panel_regime"], O.leads_sql("s_panel_regime"))


@register("g27_regime_comparison", lambda: O.with_ctes(O.correlate_sql("s_leads_regime") + """
SELECT country_code, split_part(sector_id, '#', 1) AS sector_id,
       split_part(sector_id, '#', 2) AS regime, rate_basis, target_variable,
       CAST(lag AS BIGINT) AS lag, CAST(n_obs AS BIGINT) AS n_obs,
       """ + O.r6("pearson_r", "pearson_r") + """, control_set,
       """ + O.r6("partial_r", "partial_r") + """ FROM result""", "s_leads_regime"))
def g27(spark: SparkSession, sf: str) -> DataFrame:
    """The same sweep before and after a split date: the regime becomes part
    of the pair key, so both regimes run in one plan."""
    p = Star(spark, sf).panel
    regime = F.when(F.col("month") < F.to_date(F.lit(REGIME_SPLIT)), "before").otherwise("after")
    p = p.withColumn("sector_id", F.concat_ws("#", "sector_id", regime))
    w = Window.partitionBy("country_code", "sector_id").orderBy("month")
    p = p.withColumn("time_index", (F.row_number().over(w) - 1).cast("double"))
    b = co.correlate(pn.with_leads(p))
    parts = F.split("sector_id", "#")
    return finish(b.select("country_code", parts[0].alias("sector_id"), parts[1].alias("regime"),
                           "rate_basis", "target_variable", "lag", "n_obs", "pearson_r",
                           "control_set", "partial_r"))


@register("f22_enum_mapping", lambda: O.with_ctes(O.correlate_sql("s_leads") + """
SELECT country_code, sector_id, rate_basis, target_variable,
  CASE rate_basis WHEN 'nominal' THEN 'policy_rate' ELSE 'real_interest_rate' END AS rate_column,
  CASE target_variable WHEN 'equity_valuation' THEN 'equity_valuation_change'
       ELSE 'commodity_price_change' END AS target_column FROM result""", "s_leads"))
def f22(spark: SparkSession, sf: str) -> DataFrame:
    b = correlation_batch(Star(spark, sf))
    rate = F.create_map(*[F.lit(x) for kv in RATE_INDICATORS.items() for x in kv])
    tgt = F.create_map(*[F.lit(x) for kv in TARGETS.items() for x in kv])
    return finish(b.select(*KEYS4, rate[F.col("rate_basis")].alias("rate_column"),
                           tgt[F.col("target_variable")].alias("target_column")))
