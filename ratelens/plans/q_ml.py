"""Registered queries of regression diagnostics and models (Q11, G13-G16,
G19, G24, G25, J12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import RATE_BASES, RATE_INDICATORS, TARGET_NAMES, TARGETS
from ..operators import correlate as co
from ..operators import panel as pn
from ..operators import regression as rg
from . import oracle as O
from .correlation import correlation_batch
from .q_articles import split_flag, stratified_split, training_rows
from .registry import finish, register
from .star import Star

CONTROL = "fdi_net_inflow"
MULTI = ["cpi_inflation", "gdp_growth"]
MK = ["country_code", "sector_id", "rate_basis", "target_variable", "lag"]


def _leads(spark: SparkSession, sf: str) -> DataFrame:
    return pn.with_leads(Star(spark, sf).panel)


def _mobs(spark: SparkSession, sf: str) -> DataFrame:
    return rg.model_observations(_leads(spark, sf), [CONTROL])


def _rate_name() -> F.Column:
    return F.when(F.col("rate_basis") == "nominal", F.lit(RATE_INDICATORS["nominal"])) \
        .otherwise(F.lit(RATE_INDICATORS["real"]))


def _coefs(spark: SparkSession, sf: str) -> DataFrame:
    return rg.ols_two(_mobs(spark, sf), _rate_name(), CONTROL)


_cfg = ", ".join(f"('{b}', {bi + 1}, '{t}', {ti + 1})" for bi, b in enumerate(RATE_BASES)
                 for ti, t in enumerate(TARGET_NAMES))
O.cte("s_mobs", ["s_leads"], f"""
SELECT * FROM (
  SELECT l.country_code, l.sector_id, l.month, c.rate_basis, c.target_variable, CAST(0 AS BIGINT) AS lag,
         CASE c.bi WHEN 1 THEN l.policy_rate WHEN 2 THEN l.real_interest_rate END AS x,
         CASE c.ti WHEN 1 THEN l.{TARGETS['equity_valuation']} WHEN 2 THEN l.{TARGETS['commodity_price']} END AS y,
         l.{CONTROL} AS z1
  FROM s_leads l, (VALUES {_cfg}) c(rate_basis, bi, target_variable, ti)
  WHERE l.panel_n >= 8) t
WHERE x IS NOT NULL AND y IS NOT NULL AND z1 IS NOT NULL""")

_g = "country_code, sector_id, rate_basis, target_variable, lag"


def _tq() -> str:
    z = rg.Z975
    g1 = (z ** 3 + z) / 4
    g2 = (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96
    g3 = (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384
    g4 = (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160
    v = "CAST(dof AS DOUBLE)"
    return f"({z!r} + {g1!r} / {v} + {g2!r} / ({v} * {v}) + {g3!r} / ({v} * {v} * {v}) + {g4!r} / ({v} * {v} * {v} * {v}))"


O.cte("s_ols", ["s_mobs"], f"""
WITH m AS (
  SELECT {_g}, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(z1) AS mz, var_samp(x) AS vx,
         var_samp(y) AS vy, var_samp(z1) AS vz, covar_samp(x, y) AS cxy,
         covar_samp(x, z1) AS cxz, covar_samp(z1, y) AS czy
  FROM s_mobs GROUP BY ALL),
m2 AS (SELECT *, vx * vz - cxz * cxz AS det FROM m),
m3 AS (SELECT *, (vz * cxy - cxz * czy) / nullif(det, 0) AS bx,
              (vx * czy - cxz * cxy) / nullif(det, 0) AS bz FROM m2),
m4 AS (SELECT *, my - bx * mx - bz * mz AS b0, (bx * cxy + bz * czy) / nullif(vy, 0) AS r2,
              n - 3 AS dof FROM m3),
m5 AS (SELECT *, 1 - (1 - r2) * (n - 1) / dof AS adj_r2,
              ((vy - bx * cxy - bz * czy) * (n - 1)) / nullif(dof, 0) AS s2 FROM m4 WHERE dof > 0),
terms AS (
  SELECT {_g}, n, dof, r2, adj_r2, 'intercept' AS term, 'Intercept' AS names, b0 AS coef,
         sqrt(greatest(s2 * (1 / n + (mx * mx * vz - 2 * mx * mz * cxz + mz * mz * vx)
                                     / nullif((n - 1) * det, 0)), 0)) AS se FROM m5
  UNION ALL
  SELECT {_g}, n, dof, r2, adj_r2, 'rate', CASE WHEN rate_basis = 'nominal' THEN 'policy_rate'
         ELSE 'real_interest_rate' END, bx, sqrt(greatest(s2 * vz / nullif((n - 1) * det, 0), 0)) FROM m5
  UNION ALL
  SELECT {_g}, n, dof, r2, adj_r2, 'control', '{CONTROL}', bz,
         sqrt(greatest(s2 * vx / nullif((n - 1) * det, 0), 0)) FROM m5)
SELECT *, coef / nullif(se, 0) AS t_stat, {_tq()} AS tcrit FROM terms""")


@register("g13_ols_coefficients", lambda: O.with_ctes(f"""
SELECT {_g}, CAST(n AS BIGINT) AS n, term, names, {O.r6('coef', 'coef')}, {O.r6('se', 'se')},
       {O.r6('t_stat', 'T')},
       {O.r6(O.pvalue_sql('t_stat / sqrt(t_stat * t_stat + dof)', 'dof'), 'pval')},
       {O.r6('r2', 'r2')}, {O.r6('adj_r2', 'adj_r2')}, {O.r6('coef - tcrit * se', 'ci_low')},
       {O.r6('coef + tcrit * se', 'ci_high')}
FROM s_ols""", "s_ols"))
def g13(spark: SparkSession, sf: str) -> DataFrame:
    """Q11 core: y ~ 1 + rate + fdi_net_inflow at lag 0 for every model."""
    return finish(_coefs(spark, sf))


@register("g14_coef_ranking", lambda: O.with_ctes(f"""
SELECT {_g}, names, {O.r6('coef', 'coef')}, CAST(sign(coef) AS DOUBLE) AS sign,
       row_number() OVER (PARTITION BY {_g} ORDER BY abs(coef) DESC, names) AS rank
FROM s_ols WHERE term <> 'intercept'""", "s_ols"))
def g14(spark: SparkSession, sf: str) -> DataFrame:
    return finish(rg.coefficient_ranking(_coefs(spark, sf)))


@register("g15_corr_matrix", lambda: O.with_ctes(f"""
, m AS (SELECT {_g}, var_samp(x) AS v_x, var_samp(z1) AS v_z1, var_samp(y) AS v_y,
               covar_samp(x, z1) AS c_x_z1, covar_samp(x, y) AS c_x_y, covar_samp(z1, y) AS c_z1_y
        FROM s_mobs GROUP BY ALL),
e AS (
  SELECT {_g}, 'x' AS var_i, 'x' AS var_j, CASE WHEN v_x > 0 THEN 1.0 END AS r FROM m UNION ALL
  SELECT {_g}, 'x', 'z1', c_x_z1 / nullif(sqrt(greatest(v_x * v_z1, 0)), 0) FROM m UNION ALL
  SELECT {_g}, 'x', 'y', c_x_y / nullif(sqrt(greatest(v_x * v_y, 0)), 0) FROM m UNION ALL
  SELECT {_g}, 'z1', 'x', c_x_z1 / nullif(sqrt(greatest(v_z1 * v_x, 0)), 0) FROM m UNION ALL
  SELECT {_g}, 'z1', 'z1', CASE WHEN v_z1 > 0 THEN 1.0 END FROM m UNION ALL
  SELECT {_g}, 'z1', 'y', c_z1_y / nullif(sqrt(greatest(v_z1 * v_y, 0)), 0) FROM m UNION ALL
  SELECT {_g}, 'y', 'x', c_x_y / nullif(sqrt(greatest(v_y * v_x, 0)), 0) FROM m UNION ALL
  SELECT {_g}, 'y', 'z1', c_z1_y / nullif(sqrt(greatest(v_y * v_z1, 0)), 0) FROM m UNION ALL
  SELECT {_g}, 'y', 'y', CASE WHEN v_y > 0 THEN 1.0 END FROM m)
SELECT {_g}, var_i, var_j, {O.r6('r', 'r')} FROM e""", "s_mobs"))
def g15(spark: SparkSession, sf: str) -> DataFrame:
    return finish(rg.correlation_matrix(_mobs(spark, sf)))


@register("g16_residuals", lambda: O.with_ctes(f"""
, w AS (SELECT {_g}, max(CASE WHEN term = 'intercept' THEN coef END) AS b0,
               max(CASE WHEN term = 'rate' THEN coef END) AS bx,
               max(CASE WHEN term = 'control' THEN coef END) AS bz FROM s_ols GROUP BY ALL)
SELECT o.country_code, o.sector_id, o.rate_basis, o.target_variable, o.lag, o.month,
       {O.r6('w.b0 + w.bx * o.x + w.bz * o.z1', 'fitted')},
       {O.r6('o.y - (w.b0 + w.bx * o.x + w.bz * o.z1)', 'residual')}
FROM s_mobs o JOIN w USING (country_code, sector_id, rate_basis, target_variable, lag)""",
    "s_mobs", "s_ols"))
def g16(spark: SparkSession, sf: str) -> DataFrame:
    mobs = _mobs(spark, sf)
    return finish(rg.residuals(mobs, rg.ols_two(mobs, _rate_name(), CONTROL)))


@register("g24_spearman", lambda: O.with_ctes(O.correlate_sql("s_leads") + f"""
, rk AS (
  SELECT {_g},
    rank() OVER (PARTITION BY {_g} ORDER BY x)
      + (count(*) OVER (PARTITION BY {_g}, x) - 1) / 2.0 AS rx,
    rank() OVER (PARTITION BY {_g} ORDER BY y)
      + (count(*) OVER (PARTITION BY {_g}, y) - 1) / 2.0 AS ry
  FROM obs WHERE control_pos = 0 AND x IS NOT NULL AND y IS NOT NULL),
sm AS (SELECT {_g}, count(*) AS n, covar_samp(rx, ry) / nullif(sqrt(greatest(var_samp(rx) * var_samp(ry), 0)), 0) AS rs
       FROM rk GROUP BY ALL)
SELECT {_g}, CAST(n AS BIGINT) AS n, {O.r6('rs', 'spearman_r')},
       {O.r6(O.pvalue_sql('rs', 'n - 2'), 'p_value')},
       {O.r6("CASE WHEN n > 3 THEN tanh(atanh(least(greatest(rs, -0.999999999999), 0.999999999999)) - 1.959963984540054 / sqrt(n - 3)) END", 'ci_low')},
       {O.r6("CASE WHEN n > 3 THEN tanh(atanh(least(greatest(rs, -0.999999999999), 0.999999999999)) + 1.959963984540054 / sqrt(n - 3)) END", 'ci_high')}
FROM sm""", "s_leads"))
def g24(spark: SparkSession, sf: str) -> DataFrame:
    obs = co.sweep_observations(_leads(spark, sf), controls=[]).select(*co.GROUP, "x", "y")
    return finish(rg.spearman(obs))


def _p(a, b, c):
    return f"(({a}) - ({b}) * ({c})) / nullif(sqrt(greatest((1 - ({b}) * ({b})) * (1 - ({c}) * ({c})), 0)), 0)"


_LAGS_CFG = ", ".join(f"('{b}', {bi + 1}, '{t}', {ti + 1}, {k})" for bi, b in enumerate(RATE_BASES)
                      for ti, t in enumerate(TARGET_NAMES) for k in range(4))


@register("g25_multi_control", lambda: O.with_ctes(f"""
, mo AS (
  SELECT * FROM (
    SELECT l.country_code, l.sector_id, c.rate_basis, c.target_variable, CAST(c.lag AS BIGINT) AS lag,
           CASE c.bi WHEN 1 THEN l.policy_rate WHEN 2 THEN l.real_interest_rate END AS x,
           CASE c.ti * 10 + c.lag
             WHEN 10 THEN l.equity_valuation_change__lead0 WHEN 11 THEN l.equity_valuation_change__lead1
             WHEN 12 THEN l.equity_valuation_change__lead2 WHEN 13 THEN l.equity_valuation_change__lead3
             WHEN 20 THEN l.commodity_price_change__lead0 WHEN 21 THEN l.commodity_price_change__lead1
             WHEN 22 THEN l.commodity_price_change__lead2 WHEN 23 THEN l.commodity_price_change__lead3
           END AS y, l.{MULTI[0]} AS z1, l.{MULTI[1]} AS z2
    FROM s_leads l, (VALUES {_LAGS_CFG}) c(rate_basis, bi, target_variable, ti, lag)
    WHERE l.panel_n >= 8) t
  WHERE x IS NOT NULL AND y IS NOT NULL AND z1 IS NOT NULL AND z2 IS NOT NULL),
mm AS (
  SELECT {_g}, count(*) AS n,
    covar_samp(x, y) / nullif(sqrt(greatest(var_samp(x) * var_samp(y), 0)), 0) AS rxy,
    covar_samp(x, z1) / nullif(sqrt(greatest(var_samp(x) * var_samp(z1), 0)), 0) AS rx1,
    covar_samp(x, z2) / nullif(sqrt(greatest(var_samp(x) * var_samp(z2), 0)), 0) AS rx2,
    covar_samp(y, z1) / nullif(sqrt(greatest(var_samp(y) * var_samp(z1), 0)), 0) AS ry1,
    covar_samp(y, z2) / nullif(sqrt(greatest(var_samp(y) * var_samp(z2), 0)), 0) AS ry2,
    covar_samp(z1, z2) / nullif(sqrt(greatest(var_samp(z1) * var_samp(z2), 0)), 0) AS r12
  FROM mo GROUP BY ALL),
p1 AS (SELECT *, {_p('rxy', 'rx2', 'ry2')} AS xy_2, {_p('rx1', 'rx2', 'r12')} AS x1_2,
              {_p('ry1', 'ry2', 'r12')} AS y1_2 FROM mm),
p2 AS (SELECT *, {_p('xy_2', 'x1_2', 'y1_2')} AS pr FROM p1)
SELECT {_g}, CAST(n AS BIGINT) AS n, {O.r6('pr', 'partial_r')},
       {O.r6('1 - (1 - ry2 * ry2) * (1 - y1_2 * y1_2) * (1 - pr * pr)', 'r_squared')},
       {O.r6(O.pvalue_sql('pr', 'n - 4'), 'partial_p')}
FROM p2""", "s_leads"))
def g25(spark: SparkSession, sf: str) -> DataFrame:
    """Partial r given two controls at once (cpi_inflation, gdp_growth) and
    R^2 of y ~ rate + both, every lag: general-k solver on moments."""
    obs = rg.model_observations(_leads(spark, sf), MULTI, lags=(0, 1, 2, 3))
    return finish(rg.multi_control(obs, len(MULTI), MK).select(
        *MK, "n", "partial_r", "r_squared", "partial_p"))


O.cte("s_test", ["s_train"], """
SELECT *, CASE WHEN pct_contractionary > pct_expansionary THEN 1 ELSE 0 END AS predicted
FROM s_train WHERE NOT ((CAST('0x' || substr(sha256('split-1' || '|' || country_code || '|'
      || strftime(period, '%Y-%m-%d')), 1, 8) AS UBIGINT) % 10000) < 7000)""")


@register("g19_classification_report", lambda: O.with_ctes(f"""
, cm AS (SELECT contractionary_actual AS a, predicted AS p, count(*) AS cnt FROM s_test GROUP BY 1, 2),
cls AS (SELECT a AS cls FROM cm UNION SELECT p FROM cm),
per AS (SELECT cls,
          coalesce(sum(CASE WHEN a = cls AND p = cls THEN cnt END), 0) AS tp,
          coalesce(sum(CASE WHEN a <> cls AND p = cls THEN cnt END), 0) AS fp,
          coalesce(sum(CASE WHEN a = cls AND p <> cls THEN cnt END), 0) AS fn
        FROM cls, cm GROUP BY 1)
SELECT CAST(cls AS BIGINT) AS cls, CAST(tp + fn AS BIGINT) AS support, CAST(tp AS BIGINT) AS tp,
  CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn,
  {O.r6('CAST(tp AS DOUBLE) / nullif(tp + fp, 0)', 'precision')},
  {O.r6('CAST(tp AS DOUBLE) / nullif(tp + fn, 0)', 'recall')},
  {O.r6('CAST(sum(tp) OVER () AS DOUBLE) / sum(tp + fn) OVER ()', 'accuracy')},
  {O.r6('coalesce(2 * (CAST(tp AS DOUBLE) / nullif(tp + fp, 0)) * (CAST(tp AS DOUBLE) / nullif(tp + fn, 0)) / nullif((CAST(tp AS DOUBLE) / nullif(tp + fp, 0)) + (CAST(tp AS DOUBLE) / nullif(tp + fn, 0)), 0), 0.0)', 'f1')}
FROM per""", "s_test"))
def g19(spark: SparkSession, sf: str) -> DataFrame:
    """Report of the rule baseline (more contractionary than expansionary
    articles -> a rise) on the held-out split."""
    t = training_rows(spark, sf)
    key = F.concat_ws("|", "country_code", F.date_format("period", "yyyy-MM-dd"))
    test = t.where(~split_flag(key)).withColumn(
        "predicted", F.when(F.col("pct_contractionary") > F.col("pct_expansionary"), 1).otherwise(0))
    rep = rg.classification_report(test, "contractionary_actual", "predicted")
    return finish(rep.select("cls", "support", "tp", "fp", "fn", "precision", "recall", "accuracy",
                             "f1"))


@register("j12_lag_lookup", lambda: O.with_ctes(O.correlate_sql("s_leads") + f"""
, models AS (SELECT country_code, sector_id, unnest([{O.sql_list(RATE_BASES)}]) AS rate_basis
             FROM s_pairs),
m2 AS (SELECT *, unnest([{O.sql_list(TARGET_NAMES)}]) AS target_variable FROM models)
SELECT m.country_code, m.sector_id, m.rate_basis, m.target_variable,
       CAST(coalesce(r.lag, 0) AS BIGINT) AS lag
FROM m2 m LEFT JOIN result r USING (country_code, sector_id, rate_basis, target_variable)""",
    "s_leads"))
def j12(spark: SparkSession, sf: str) -> DataFrame:
    star = Star(spark, sf)
    models = star.pairs.select(
            "country_code", "sector_id",
            F.explode(F.array(*[F.struct(F.lit(b).alias("rate_basis"), F.lit(t).alias("target_variable"))
                                for b in RATE_BASES for t in TARGET_NAMES])).alias("m")) \
        .select("country_code", "sector_id", "m.rate_basis", "m.target_variable")
    res = correlation_batch(star)
    return finish(rg.lag_lookup(models, res).select("country_code", "sector_id", "rate_basis",
                                                    "target_variable", "lag"))


# ------------------------------------------------------------ models (rows-only)
from ..constants import CANDIDATE_CONTROLS  # noqa: E402
from ..operators import models as md  # noqa: E402

LASSO_FEATURES = ["x"] + [f"z{i + 1}" for i in range(len(CANDIDATE_CONTROLS))]


def _lasso(spark: SparkSession, sf: str) -> DataFrame:
    """Lasso per pair, rate basis and target over the rate and all candidate
    controls, at the lag chosen by the batch result (J12)."""
    star = Star(spark, sf)
    leads = pn.with_leads(star.panel)
    obs = rg.model_observations(leads, CANDIDATE_CONTROLS, lags=(0, 1, 2, 3),
                                bases=RATE_BASES, targets=TARGET_NAMES)
    models = star.pairs.select(
        "country_code", "sector_id",
        F.explode(F.array(*[F.struct(F.lit(b).alias("rate_basis"), F.lit(t).alias("target_variable"))
                            for b in RATE_BASES for t in TARGET_NAMES])).alias("m")) \
        .select("country_code", "sector_id", "m.rate_basis", "m.target_variable")
    lags = rg.lag_lookup(models, correlation_batch(star))
    obs = obs.join(lags, MK, "left_semi")
    fit = md.lasso_cv(obs, MK, LASSO_FEATURES, "y")
    names = F.create_map(*[x for i, f in enumerate(LASSO_FEATURES) for x in
                           (F.lit(f), F.lit("policy_rate" if i == 0 else CANDIDATE_CONTROLS[i - 1]))])
    return fit.withColumn("feature", names[F.col("feature")])


@register("g17_lasso_cv")
def g17(spark: SparkSession, sf: str) -> DataFrame:
    return finish(_lasso(spark, sf))


@register("q12_lasso_controls")
def q12(spark: SparkSession, sf: str) -> DataFrame:
    """Controls that survive the Lasso (non-zero standardised coefficient)."""
    f = _lasso(spark, sf)
    # a coefficient counts as surviving above 1e-9 (solver noise is far below)
    return finish(f.where(F.abs("coef") > 1e-9).select(*MK, "feature", "coef"))


def _classifier(spark: SparkSession, sf: str):
    t = training_rows(spark, sf)
    key = F.concat_ws("|", "country_code", F.date_format("period", "yyyy-MM-dd"))
    t = stratified_split(t.withColumn("_key", key), "_key", "contractionary_actual").drop("_key")
    feats = ["pct_contractionary", "pct_expansionary", "avg_sentiment"]
    return md.direction_classifier(t.where("is_train"), t.where(~F.col("is_train")), feats,
                                   "contractionary_actual")


@register("g18_direction_classifier")
def g18(spark: SparkSession, sf: str) -> DataFrame:
    pred = _classifier(spark, sf)
    if pred is None:
        return finish(training_rows(spark, sf).limit(0))
    return finish(pred.select("country_code", "period", "contractionary_actual", "prediction"))


@register("q13_direction_classifier")
def q13(spark: SparkSession, sf: str) -> DataFrame:
    """Stance features -> next-period rate rise: logistic model on the train
    split, classification report on the held-out split."""
    pred = _classifier(spark, sf)
    if pred is None:
        return finish(training_rows(spark, sf).limit(0))
    return finish(rg.classification_report(pred, "contractionary_actual", "prediction"))
