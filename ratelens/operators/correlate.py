"""Lagged correlation / partial correlation / regression sweep (Q01, Q02).

Design: correlation as sufficient statistics.  Every panel row is exploded
map-side into one observation per (rate basis, target, lag, control) -- the
sweep as data (W14) -- and one hash aggregate computes, per group, the count
and the sample (co)variances of x (rate change), y (led target), z (control
change) and t (time index) over exactly the rows where the group's variables
are all non-null (pairwise deletion, P05).  Pearson r, partial r with one or
two covariates, R^2 and p-values are then column expressions on that one row
(functions.stats).  The pseudo-control '' carries the uncontrolled moments
(rows where only x and y are non-null).

Plan shape: the panel is hash-partitioned by pair once (lead window); the
explode sits directly under the partial aggregate and the aggregate's keys
contain the pair, so the exploded rows never shuffle and the final aggregate
reuses the window's partitioning.  Rankings (W06, W07) run on the aggregated
rows, partitioned by pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import (CANDIDATE_CONTROLS, LAGS, MIN_OBS, RANK_DECIMALS, RATE_BASES,
                         RATE_INDICATORS, TARGET_NAMES, TARGETS)
from ..functions import stats as st
from .panel import PAIR

NONE = ""  # pseudo-control: uncontrolled moments
GROUP = PAIR + ["rate_basis", "target_variable", "lag"]


def _sweep_config(bases, targets, lags, controls) -> tuple[Column, Column]:
    """The sweep as an index: ``explode(sequence(0, N-1))`` and, from the
    index, a struct (basis, target, lag, control and their 1-based positions
    into the value lists).  Only the short name lists are literals."""
    cl = [NONE] + list(controls)
    nb, nt, nl, nc = len(bases), len(targets), len(lags), len(cl)
    i = "_sweep_i"
    ci = f"({i} % {nc})"
    li = f"(CAST({i} / {nc} AS INT) % {nl})"
    ti = f"(CAST({i} / {nc * nl} AS INT) % {nt})"
    bi = f"CAST({i} / {nc * nl * nt} AS INT)"

    def name(values, pos):
        arr = ", ".join(repr(v) if isinstance(v, int) else f"'{v}'" for v in values)
        return f"element_at(array({arr}), {pos} + 1)"

    cfg = F.expr(f"named_struct('rate_basis', {name(bases, bi)}, 'bi', {bi} + 1, "
                 f"'target_variable', {name(targets, ti)}, 'yi', {ti} * {nl} + {li} + 1, "
                 f"'lag', {name(list(lags), li)}, 'control', {name(cl, ci)}, "
                 f"'control_pos', {ci})")
    return F.explode(F.sequence(F.lit(0), F.lit(nb * nt * nl * nc - 1))).alias("_sweep_i"), cfg


def _pick(index: Column | str, values: list[Column] | list[str]) -> Column:
    """values[index - 1] as a CASE chain (null when out of range).  With a
    SQL index and column names it is built as one SQL expression."""
    if not values:
        return F.lit(None).cast("double")
    if isinstance(index, str):
        branches = " ".join(f"WHEN {k} THEN {v}" for k, v in enumerate(values, start=1))
        return F.expr(f"CASE {index} {branches} END")
    out = F.when(index == 1, values[0])
    for i, v in enumerate(values[1:], start=2):
        out = out.when(index == i, v)
    return out


def sweep_observations(panel_leads: DataFrame, bases: Sequence[str] = RATE_BASES,
                       targets: Sequence[str] = TARGET_NAMES, lags: Sequence[int] = LAGS,
                       controls: Sequence[str] = CANDIDATE_CONTROLS,
                       min_panel: int = MIN_OBS) -> DataFrame:
    """W14 + P05: the sweep as data.  One row per panel month and
    (basis, target, lag, control) with x, y, z, t, kept only where the
    group's variables are all present (control_pos 0 = no control)."""
    have = set(panel_leads.columns)

    def col_or_null(name: str) -> str:
        return f"`{name}`" if name in have else "CAST(NULL AS DOUBLE)"

    x = _pick("cfg.bi", [col_or_null(RATE_INDICATORS[b]) for b in bases])
    y = _pick("cfg.yi", [col_or_null(f"{TARGETS[t]}__lead{k}") for t in targets for k in lags])
    z = _pick("cfg.control_pos", [col_or_null(c) for c in controls])
    cfg = F.col("cfg")
    explode, cfg_struct = _sweep_config(bases, targets, lags, controls)
    obs = (panel_leads.where(F.col("panel_n") >= min_panel)
           .select("*", explode).withColumn("cfg", cfg_struct)
           .select(*PAIR, "panel_start", "panel_end",
                   cfg["rate_basis"].alias("rate_basis"),
                   cfg["target_variable"].alias("target_variable"),
                   cfg["lag"].alias("lag"), cfg["control"].alias("control"),
                   cfg["control_pos"].alias("control_pos"),
                   x.alias("x"), y.alias("y"), z.alias("z"),
                   F.col("time_index").alias("t"))
           .where(F.col("x").isNotNull() & F.col("y").isNotNull()
                  & (F.col("z").isNotNull() | (F.col("control_pos") == 0))))
    return obs


def sweep_moments(panel_leads: DataFrame, bases: Sequence[str] = RATE_BASES,
                  targets: Sequence[str] = TARGET_NAMES, lags: Sequence[int] = LAGS,
                  controls: Sequence[str] = CANDIDATE_CONTROLS,
                  min_panel: int = MIN_OBS) -> DataFrame:
    """Moments of the sweep: one row per (pair, basis, target, lag, control)
    with n and the sample (co)variances of x, y, z, t."""
    obs = sweep_observations(panel_leads, bases, targets, lags, controls, min_panel)
    keys = GROUP + ["control", "control_pos", "panel_start", "panel_end"]
    return obs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"),
        F.var_samp("z").alias("vz"), F.var_samp("t").alias("vt"),
        F.covar_samp("x", "y").alias("cxy"), F.covar_samp("x", "z").alias("cxz"),
        F.covar_samp("y", "z").alias("cyz"), F.covar_samp("x", "t").alias("cxt"),
        F.covar_samp("y", "t").alias("cyt"), F.covar_samp("z", "t").alias("czt"),
    )


def moment_stats(m: DataFrame) -> DataFrame:
    """G07, G09-G11 on moment rows: r, partial r given z, partial r given
    (z, t), R^2 of y ~ x + z.  Computed in stages over materialised columns so
    every formula references its inputs, not their expression trees.
    p-values are left to the caller (they are only needed on result rows)."""
    e = F.expr
    m = m.select("*",
                 e(st.corr_sql("cxy", "vx", "vy")).alias("r_xy"),
                 e(st.corr_sql("cxz", "vx", "vz")).alias("r_xz"),
                 e(st.corr_sql("cyz", "vy", "vz")).alias("r_yz"),
                 e(st.corr_sql("cxt", "vx", "vt")).alias("r_xt"),
                 e(st.corr_sql("cyt", "vy", "vt")).alias("r_yt"),
                 e(st.corr_sql("czt", "vz", "vt")).alias("r_zt"))
    m = m.select("*",
                 e(st.partial_sql("r_xy", "r_xz", "r_yz")).alias("partial1"),
                 e(st.partial_sql("r_xy", "r_xt", "r_yt")).alias("_xy_t"),
                 e(st.partial_sql("r_xz", "r_xt", "r_zt")).alias("_xz_t"),
                 e(st.partial_sql("r_yz", "r_yt", "r_zt")).alias("_yz_t"),
                 e(st.r2_sql("r_xy", "r_yz", "r_xz")).alias("r2"))
    return m.select(*[x for x in m.columns if not x.startswith("_")],
                    e(st.partial_sql("_xy_t", "_xz_t", "_yz_t")).alias("partial2"))


def _p_order(r: Column, n: Column, decimals: int) -> Column:
    """Secondary sort key equivalent to 'smaller p first' among rows whose
    rounded |r| ties: for fixed |r| in (0, 1) the p-value falls as n grows;
    at |r| = 0 or 1 all p-values are equal (1 or 0), so no preference."""
    k = st.rank_key(r, decimals)
    return F.when((k > 0) & (k < 1), -n).otherwise(F.lit(0))


def pick_control(m: DataFrame, search: bool, min_obs: int = MIN_OBS,
                 decimals: int = RANK_DECIMALS) -> DataFrame:
    """W06 in one window pass: per (pair, basis, target, lag) keep one row --
    the best candidate control (largest |partial r| given the control; ties ->
    smaller p, then candidate order) or, when there is none, the uncontrolled
    row -- with the uncontrolled statistics attached.

    ``search`` False: explicit override, the single control is taken as is
    (no minimum count), as long as it has any joint observation.
    """
    c = F.col
    cand = c("control_pos") > 0
    if search:
        cand = cand & (c("n") >= min_obs) & c("partial1").isNotNull()
    whole = Window.partitionBy(*GROUP)
    ordered = Window.partitionBy(*GROUP).orderBy(
        cand.desc(), st.rank_key(c("partial1"), decimals).desc_nulls_last(),
        _p_order(c("partial1"), c("n"), decimals).asc(), c("control_pos").asc())
    raw = c("control_pos") == 0
    return (m.select("*", cand.alias("is_cand"),
                     F.max(F.when(raw, c("n"))).over(whole).alias("n_obs"),
                     F.max(F.when(raw, c("r_xy"))).over(whole).alias("pearson_r"),
                     F.row_number().over(ordered).alias("_rk"))
            .where(c("_rk") == 1).drop("_rk"))


def best_lag(rows: DataFrame, decimals: int = RANK_DECIMALS) -> DataFrame:
    """Per (pair, basis, target) the lag with the largest |Pearson r|;
    ties -> smaller lag."""
    w = Window.partitionBy(*PAIR, "rate_basis", "target_variable").orderBy(
        st.rank_key(F.col("pearson_r"), decimals).desc(), F.col("lag").asc())
    return rows.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1).drop("_rk")


def correlate(panel_leads: DataFrame, controls: Sequence[str] | None = None,
              candidates: Sequence[str] = CANDIDATE_CONTROLS, min_obs: int = MIN_OBS,
              bases: Sequence[str] = RATE_BASES, targets: Sequence[str] = TARGET_NAMES,
              lags: Sequence[int] = LAGS) -> DataFrame:
    """Q01 core over a panel with leads (``panel.with_leads``).

    ``controls`` None -> empirical control search (W06) per lag; a list ->
    explicit override: its first element is used without the minimum-count
    check, an empty list means no control.  Returns one row per
    (pair, basis, target) with the best lag (W07) and its statistics:
    Pearson r and its p (rows with x, y present), partial r given the control
    and the time index and R^2 of y ~ x + control (rows with x, y, control
    present), with the fallbacks partial := r and R^2 := r^2 (G12).
    """
    use = list(candidates) if controls is None else list(controls[:1])
    m = moment_stats(sweep_moments(panel_leads, bases, targets, lags, use, min_obs))
    c = F.col
    picked = (pick_control(m, controls is None, min_obs)
              .where((c("n_obs") >= min_obs) & c("pearson_r").isNotNull()))
    has = c("is_cand")
    rows = picked.select(
        *GROUP, "panel_start", "panel_end", "n_obs",
        F.when(has, c("control")).otherwise(F.lit(NONE)).alias("control_set"),
        "pearson_r",
        F.when(has, F.coalesce(c("partial2"), c("pearson_r")))
         .otherwise(c("pearson_r")).alias("partial_r"),
        F.when(has, F.coalesce(c("r2"), c("pearson_r") * c("pearson_r")))
         .otherwise(c("pearson_r") * c("pearson_r")).alias("r_squared"),
        F.when(has, c("n")).alias("n_control"),
        F.when(has, c("partial1")).alias("partial_r_select"))
    best = best_lag(rows)
    return best.select(
        *GROUP, "panel_start", "panel_end", "n_obs", "control_set", "pearson_r",
        "partial_r", st.r_pvalue_sql("pearson_r", "n_obs - 2").alias("p_value"),
        "r_squared", "n_control", "partial_r_select",
        st.r_pvalue_sql("partial_r_select", "n_control - 3").alias("partial_p_select"))


def result_rows(best: DataFrame, run_id: str, computed_at: str) -> DataFrame:
    """K02 shape: fact_correlation_result rows with a content-derived id
    (sha2 of run id and keys, so a retried run writes the same ids)."""
    rid = F.sha2(F.concat_ws("|", F.lit(run_id), *[F.col(k).cast("string") for k in
                                                   PAIR + ["rate_basis", "target_variable"]]), 256)
    return best.select(
        rid.alias("result_id"), *PAIR, "rate_basis", "target_variable", "control_set",
        F.col("panel_start").alias("date_range_start"),
        F.col("panel_end").alias("date_range_end"),
        F.col("lag").cast("int").alias("lag"), "pearson_r", "partial_r", "p_value",
        "r_squared", F.to_timestamp_ntz(F.lit(computed_at)).alias("computed_at"),
        F.to_date(F.lit(computed_at[:10])).alias("run_date"))
