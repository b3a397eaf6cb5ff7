"""Regression diagnostics and models over the sweep.

Everything that can be is computed from per-group moments (one aggregate,
combined map-side), any list of controls included: the sweep operator works
inside the moment row, without Python workers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import MIN_OBS, RATE_BASES, RATE_INDICATORS, TARGET_NAMES, TARGETS
from ..functions import stats as st
from .correlate import GROUP, _pick, _sweep_config
from .panel import PAIR

MODEL = PAIR + ["rate_basis", "target_variable"]
Z975 = 1.959963984540054


def t_quantile_975(df: Column) -> Column:
    """Two-sided 95% Student-t critical value by the Cornish-Fisher
    expansion in 1/df (absolute error below 1e-6 for df >= 10)."""
    z = Z975
    g1 = (z ** 3 + z) / 4
    g2 = (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96
    g3 = (3 * z ** 7 + 19 * z ** 5 + 17 * z ** 3 - 15 * z) / 384
    g4 = (79 * z ** 9 + 776 * z ** 7 + 1482 * z ** 5 - 1920 * z ** 3 - 945 * z) / 92160
    v = df.cast("double")
    return F.lit(z) + g1 / v + g2 / (v * v) + g3 / (v * v * v) + g4 / (v * v * v * v)


def t_pvalue(t: Column, dof: Column) -> Column:
    """Two-sided p of a t statistic with integer df, via the correlation
    form r = t / sqrt(t^2 + df)."""
    return st.r_pvalue(t / F.sqrt(t * t + dof), dof)


def model_observations(panel_leads: DataFrame, controls: Sequence[str], lags: Sequence[int] = (0,),
                       bases: Sequence[str] = RATE_BASES,
                       targets: Sequence[str] = TARGET_NAMES) -> DataFrame:
    """Rows (model keys, lag, month, x, y, z1..zk) where all are present
    (complete cases), for every basis x target x lag: the sweep as data with
    a fixed control list."""
    have = set(panel_leads.columns)

    def col(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None).cast("double")

    def name_sql(name: str) -> str:
        return f"`{name}`" if name in have else "CAST(NULL AS DOUBLE)"

    cfg = F.col("cfg")
    x = _pick("cfg.bi", [name_sql(RATE_INDICATORS[b]) for b in bases])
    y = _pick("cfg.yi", [name_sql(f"{TARGETS[t]}__lead{k}") for t in targets for k in lags])
    zs = [col(c).alias(f"z{i + 1}") for i, c in enumerate(controls)]
    explode, cfg_struct = _sweep_config(bases, targets, lags, [])
    obs = (panel_leads.where(F.col("panel_n") >= MIN_OBS)
           .select("*", explode).withColumn("cfg", cfg_struct)
           .select(*PAIR, "month", cfg["rate_basis"].alias("rate_basis"),
                   cfg["target_variable"].alias("target_variable"), cfg["lag"].alias("lag"),
                   x.alias("x"), y.alias("y"), *zs))
    cond = F.col("x").isNotNull() & F.col("y").isNotNull()
    for i in range(len(controls)):
        cond = cond & F.col(f"z{i + 1}").isNotNull()
    return obs.where(cond)


def ols_two(obs: DataFrame, rate_name: Column | str = "rate", control_name: str = "control") -> DataFrame:
    """OLS y ~ 1 + x + z1 per model from moments: coefficient table with
    se, T, p (df n-3), R^2, adjusted R^2 and 95% CI -- long format, one row
    per term (Intercept, rate, control)."""
    keys = MODEL + ["lag"]
    m = obs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mx"), F.avg("y").alias("my"),
        F.avg("z1").alias("mz"), F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"),
        F.var_samp("z1").alias("vz"), F.covar_samp("x", "y").alias("cxy"),
        F.covar_samp("x", "z1").alias("cxz"), F.covar_samp("z1", "y").alias("czy"))
    c = F.col
    m = m.select("*", (c("vx") * c("vz") - c("cxz") * c("cxz")).alias("det"))
    m = m.select("*", st.safe_div(c("vz") * c("cxy") - c("cxz") * c("czy"), c("det")).alias("bx"),
                 st.safe_div(c("vx") * c("czy") - c("cxz") * c("cxy"), c("det")).alias("bz"))
    m = m.select("*", (c("my") - c("bx") * c("mx") - c("bz") * c("mz")).alias("b0"),
                 st.safe_div(c("bx") * c("cxy") + c("bz") * c("czy"), c("vy")).alias("r2"),
                 (c("n") - 3).alias("dof"))
    m = m.select("*", (1 - (1 - c("r2")) * (c("n") - 1) / c("dof")).alias("adj_r2"),
                 st.safe_div((c("vy") - c("bx") * c("cxy") - c("bz") * c("czy")) * (c("n") - 1),
                             c("dof")).alias("s2"))
    nm1 = c("n") - 1
    se_x = st.safe_sqrt(st.safe_div(c("s2") * c("vz"), nm1 * c("det")))
    se_z = st.safe_sqrt(st.safe_div(c("s2") * c("vx"), nm1 * c("det")))
    se_0 = st.safe_sqrt(c("s2") * (1 / c("n") + st.safe_div(
        c("mx") * c("mx") * c("vz") - 2 * c("mx") * c("mz") * c("cxz") + c("mz") * c("mz") * c("vx"),
        nm1 * c("det"))))
    rate = F.lit(rate_name) if isinstance(rate_name, str) else rate_name
    terms = F.array(
        F.struct(F.lit("intercept").alias("term"), F.lit("Intercept").alias("names"),
                 c("b0").alias("coef"), se_0.alias("se")),
        F.struct(F.lit("rate").alias("term"), rate.alias("names"), c("bx").alias("coef"),
                 se_x.alias("se")),
        F.struct(F.lit("control").alias("term"), F.lit(control_name).alias("names"),
                 c("bz").alias("coef"), se_z.alias("se")))
    long = m.where(c("dof") > 0).select(*keys, "n", "r2", "adj_r2", "dof",
                                       F.explode(terms).alias("tm"))
    tcrit = t_quantile_975(c("dof"))
    tstat = st.safe_div(c("tm.coef"), c("tm.se"))
    return long.select(*keys, "n", c("tm.term").alias("term"), c("tm.names").alias("names"),
                       c("tm.coef").alias("coef"),
                       c("tm.se").alias("se"), tstat.alias("T"), t_pvalue(tstat, c("dof")).alias("pval"),
                       "r2", "adj_r2", (c("tm.coef") - tcrit * c("tm.se")).alias("ci_low"),
                       (c("tm.coef") + tcrit * c("tm.se")).alias("ci_high"))


def coefficient_ranking(coefs: DataFrame) -> DataFrame:
    """Rank non-intercept terms per model by |coef|, keeping the sign."""
    w = Window.partitionBy(*MODEL, "lag").orderBy(F.abs("coef").desc(), F.col("names"))
    return (coefs.where(F.col("term") != "intercept")
            .select(*MODEL, "lag", "names", "coef", F.signum("coef").alias("sign"),
                    F.row_number().over(w).alias("rank")))


def correlation_matrix(obs: DataFrame, names: Sequence[str] = ("x", "z1", "y")) -> DataFrame:
    """Long correlation matrix (var_i, var_j, r) of the model inputs and
    target over complete cases, from one moment aggregate per model."""
    keys = MODEL + ["lag"]
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]
    m = obs.groupBy(*keys).agg(*[F.var_samp(n).alias(f"v_{n}") for n in names],
                               *[F.covar_samp(a, b).alias(f"c_{a}__{b}") for a, b in pairs])
    items = []
    for a in names:
        for b in names:
            if a == b:
                r = F.when(F.col(f"v_{a}") > 0, F.lit(1.0))
            else:
                key = f"c_{a}__{b}" if (a, b) in pairs else f"c_{b}__{a}"
                r = st.corr(F.col(key), F.col(f"v_{a}"), F.col(f"v_{b}"))
            items.append(F.struct(F.lit(a).alias("var_i"), F.lit(b).alias("var_j"), r.alias("r")))
    return m.select(*keys, F.explode(F.array(*items)).alias("e")).select(
        *keys, "e.var_i", "e.var_j", "e.r")


def residuals(obs: DataFrame, coefs: DataFrame) -> DataFrame:
    """Fitted values and residuals per observation: the three
    coefficients of each model joined back on the model keys."""
    keys = MODEL + ["lag"]
    wide = coefs.groupBy(*keys).agg(
        F.max(F.when(F.col("term") == "intercept", F.col("coef"))).alias("b0"),
        F.max(F.when(F.col("term") == "control", F.col("coef"))).alias("bz"),
        F.max(F.when(F.col("term") == "rate", F.col("coef"))).alias("bx"))
    j = obs.join(wide, keys)
    fitted = F.col("b0") + F.col("bx") * F.col("x") + F.col("bz") * F.col("z1")
    return j.select(*keys, "month", fitted.alias("fitted"), (F.col("y") - fitted).alias("residual"))


def spearman(obs: DataFrame, keys: Sequence[str] = GROUP) -> DataFrame:
    """Spearman r (average ranks for ties) per group, with its p-value
    and a Fisher-z 95% confidence interval."""
    keys = list(keys)

    def avg_rank(v: str) -> Column:
        w = Window.partitionBy(*keys).orderBy(v)
        ties = w.rangeBetween(Window.currentRow, Window.currentRow)  # same partitioning
        return F.rank().over(w) + (F.count(F.lit(1)).over(ties) - 1) / 2.0

    ranked = obs.select(*keys, avg_rank("x").alias("rx"), avg_rank("y").alias("ry"))
    m = ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.var_samp("rx").alias("vx"),
                                  F.var_samp("ry").alias("vy"),
                                  F.covar_samp("rx", "ry").alias("cxy"))
    r = st.corr(F.col("cxy"), F.col("vx"), F.col("vy"))
    m = m.select(*keys, "n", r.alias("spearman_r"))
    lo, hi = st.fisher_ci(F.col("spearman_r"), F.col("n"))
    return m.select("*", st.r_pvalue(F.col("spearman_r"), F.col("n") - 2).alias("p_value"),
                    lo.alias("ci_low"), hi.alias("ci_high"))


def covariance_moments(obs: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """n and the full sample covariance matrix of ``cols`` per group (one
    aggregate)."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append((F.var_samp(a) if a == b else F.covar_samp(a, b)).alias(f"c__{a}__{b}"))
    return obs.groupBy(*keys).agg(*aggs)


PIVOT = 1e-10               # a correlation matrix with a smaller pivot counts as singular


def _correlations(cols: Sequence[str]) -> Column:
    """The correlation matrix of ``cols`` as a row-major array, from the columns of
    ``covariance_moments`` (null entries where a series is constant)."""
    def cell(i: int, j: int) -> Column:
        a, b = cols[min(i, j)], cols[max(i, j)]
        if i == j:
            return F.when(F.col(f"c__{a}__{a}") > 0, F.lit(1.0))
        return st.corr(F.col(f"c__{a}__{b}"), F.col(f"c__{a}__{a}"), F.col(f"c__{b}__{b}"))
    d = range(len(cols))
    return F.array(*[cell(i, j) for i in d for j in d])


def _at(matrix: Column, d: int, i: Column | int, j: Column | int) -> Column:
    return F.get(matrix, (F.lit(d) * i + j).cast("int"))


def swept(matrix: Column, d: int, pivots: int) -> Column:
    """The sweep operator on the first ``pivots`` positions of a row-major d x d matrix:
    their block becomes its inverse, the columns right of it the coefficients, and the
    block below right what is left unexplained.  Null when a pivot vanishes."""
    if not pivots:
        return matrix

    def step(m: Column, k: Column) -> Column:
        p = _at(m, d, k, k)

        def cell(v: Column, at: Column) -> Column:
            j = at % d
            i = ((at - j) / d).cast("int")
            return (F.when((i == k) & (j == k), 1 / p).when(i == k, v / p).when(j == k, -v / p)
                    .otherwise(v - _at(m, d, i, k) * _at(m, d, k, j) / p))
        return F.when(p > PIVOT, F.transform(m, cell))
    return F.aggregate(F.array(*[F.lit(k) for k in range(pivots)]), matrix, step)


def multi_control(obs: DataFrame, k: int, keys: Sequence[str] = GROUP) -> DataFrame:
    """Partial correlation of x and y given any number of controls
    z1..zk, its p-value (df n-2-k), and R^2 of y ~ x + z1..zk, for every
    group, from one moment row a group: sweeping the controls leaves the
    2 x 2 block of x and y.  Null for a constant series or dependent controls."""
    keys = list(keys)
    cols = [f"z{i + 1}" for i in range(k)] + ["x", "y"]
    d = k + 2
    m = covariance_moments(obs, keys, cols).select(*keys, "n", swept(_correlations(cols), d, k).alias("m"))
    xx, xy, yy = (_at(F.col("m"), d, i, j) for i, j in ((k, k), (k, k + 1), (k + 1, k + 1)))
    free = xx > PIVOT
    out = m.select(*keys, "n", F.when(free, st.safe_div(xy, st.safe_sqrt(xx * yy))).alias("partial_r"),
                   F.when(free, 1 - yy + st.safe_div(xy * xy, xx)).alias("r_squared"))
    return out.select("*", st.r_pvalue(F.col("partial_r"), F.col("n") - 2 - k).alias("partial_p"))


def with_time(obs: DataFrame, name: str = "t") -> DataFrame:
    """A linear time term: months since year 0."""
    return obs.withColumn(name, (F.year("month") * 12 + F.month("month")).cast("double"))


def ols_many(obs: DataFrame, regressors: Sequence[str], keys: Sequence[str], target: str = "y",
             names: dict[str, Column | str] | None = None) -> DataFrame:
    """G13 / G25 for any list of regressors (a time term is one of them, ``with_time``):
    OLS target ~ 1 + regressors per group over complete rows.  One row per term: coef,
    se, T, pval (df n - 1 - number of regressors), 95% interval, partial r of the term
    given the others, R^2 and adjusted R^2.  One aggregate per group, then the sweep
    operator within the moment row.  Groups without a degree of freedom are left out;
    a constant regressor or dependent regressors give null statistics."""
    keys, xs = list(keys), list(regressors)
    m, d = len(xs), len(xs) + 1
    whole = F.lit(True)
    for c in (*xs, target):
        whole = whole & F.col(c).isNotNull()
    cols = [*xs, target]
    aggs = [F.count(F.lit(1)).alias("n")] + [F.avg(c).alias(f"m__{c}") for c in cols]
    for i, a in enumerate(cols):
        for b in cols[i:]:
            aggs.append((F.var_samp(a) if a == b else F.covar_samp(a, b)).alias(f"c__{a}__{b}"))
    mom = obs.where(whole).groupBy(*keys).agg(*aggs).withColumn("dof", F.col("n") - 1 - m).where("dof > 0")
    mom = mom.withColumn("m", swept(_correlations(cols), d, m))
    sd = {c: F.sqrt(F.col(f"c__{c}__{c}")) for c in cols}
    left = _at(F.col("m"), d, m, m)
    mom = mom.withColumn("r2", 1 - left).withColumn("adj_r2", 1 - left * (F.col("n") - 1) / F.col("dof"))
    mom = mom.withColumn("s2", left * F.col(f"c__{target}__{target}") * (F.col("n") - 1) / F.col("dof"))
    coef = [_at(F.col("m"), d, i, m) * st.safe_div(sd[target], sd[x]) for i, x in enumerate(xs)]

    def root(v: Column) -> Column:
        return F.when(v.isNotNull(), st.safe_sqrt(v))
    se = [root(st.safe_div(F.col("s2") * _at(F.col("m"), d, i, i), (F.col("n") - 1) * F.col(f"c__{x}__{x}")))
          for i, x in enumerate(xs)]
    b0, spread = F.col(f"m__{target}"), F.lit(0.0)
    for i, x in enumerate(xs):
        b0 = b0 - coef[i] * F.col(f"m__{x}")
        for j, z in enumerate(xs):
            spread = spread + _at(F.col("m"), d, i, j) * st.safe_div(F.col(f"m__{x}"), sd[x]) * st.safe_div(
                F.col(f"m__{z}"), sd[z])
    se0 = root(F.col("s2") * (1 / F.col("n") + spread / (F.col("n") - 1)))
    label = {x: (names or {}).get(x, x) for x in xs}
    label = {x: F.lit(v) if isinstance(v, str) else v for x, v in label.items()}

    def term(kind: str, name: Column, c: Column, s: Column) -> Column:
        return F.struct(F.lit(kind).alias("term"), name.alias("names"), c.alias("coef"), s.alias("se"))
    terms = F.array(term("intercept", F.lit("Intercept"), b0, se0),
                    *[term(x, label[x], coef[i], se[i]) for i, x in enumerate(xs)])
    long = mom.select(*keys, "n", "dof", "r2", "adj_r2", F.explode(terms).alias("tm")).select(
        *keys, "n", "dof", "r2", "adj_r2", "tm.*")
    t = st.safe_div(F.col("coef"), F.col("se"))
    crit = t_quantile_975(F.col("dof"))
    partial = F.when(F.col("term") != "intercept", t / F.sqrt(t * t + F.col("dof")))
    return long.select(*keys, "n", "term", "names", "coef", "se", t.alias("T"), t_pvalue(t, F.col("dof")).alias("pval"),
                       partial.alias("partial_r"), "r2", "adj_r2", (F.col("coef") - crit * F.col("se")).alias("ci_low"),
                       (F.col("coef") + crit * F.col("se")).alias("ci_high"))


def diagnostics(obs: DataFrame, coefs: DataFrame) -> DataFrame:
    """Q11: G13 to G16 of every model as (model keys, section, item, other, value)."""
    keys = MODEL + ["lag"]

    def long(df: DataFrame, section: str, item: Column, values: Sequence[tuple[Column, Column]]) -> DataFrame:
        each = F.array(*[F.struct(o.alias("other"), v.cast("double").alias("value")) for o, v in values])
        return df.select(*keys, F.lit(section).alias("section"), item.alias("item"), F.explode(each).alias("e")) \
            .select(*keys, "section", "item", "e.other", "e.value")

    def named(*columns: str) -> list[tuple[Column, Column]]:
        return [(F.lit(c), F.col(c)) for c in columns]
    return (long(coefs, "coefficient", F.col("names"),
                 named("coef", "se", "T", "pval", "r2", "adj_r2", "ci_low", "ci_high"))
            .unionByName(long(coefficient_ranking(coefs), "ranking", F.col("names"), named("rank", "sign")))
            .unionByName(long(correlation_matrix(obs), "matrix", F.col("var_i"), [(F.col("var_j"), F.col("r"))]))
            .unionByName(long(residuals(obs, coefs), "observation", F.date_format("month", "yyyy-MM"),
                              named("fitted", "residual"))))


def classification_report(pred: DataFrame, actual: str, predicted: str,
                          keys: Sequence[str] = ()) -> DataFrame:
    """Per class: support, tp, fp, fn, precision, recall, F1, plus the
    overall accuracy -- from the (actual, predicted) count table.  Each count
    cell contributes to its actual class (tp or fn) and its predicted class
    (fp), so one explode + aggregate builds the report."""
    keys = list(keys) or ["_all"]
    src = pred if keys != ["_all"] else pred.withColumn("_all", F.lit(1))
    a, p = F.col(actual), F.col(predicted)
    cm = src.groupBy(*keys, a.alias("a"), p.alias("p")).agg(F.count(F.lit(1)).alias("cnt"))
    hit = F.col("a") == F.col("p")
    cnt = F.col("cnt")
    zero = F.lit(0).cast("bigint")
    contrib = F.array(
        F.struct(F.col("a").alias("cls"), F.when(hit, cnt).otherwise(zero).alias("tp"),
                 zero.alias("fp"), F.when(hit, zero).otherwise(cnt).alias("fn")),
        F.struct(F.col("p").alias("cls"), zero.alias("tp"),
                 F.when(hit, zero).otherwise(cnt).alias("fp"), zero.alias("fn")))
    per = (cm.select(*keys, F.explode(contrib).alias("c"))
           .groupBy(*keys, "c.cls").agg(F.sum("c.tp").alias("tp"), F.sum("c.fp").alias("fp"),
                                        F.sum("c.fn").alias("fn")))
    whole = Window.partitionBy(*keys)
    prec = st.safe_div(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = st.safe_div(F.col("tp"), F.col("tp") + F.col("fn"))
    out = per.select(*keys, "cls", (F.col("tp") + F.col("fn")).alias("support"), "tp", "fp", "fn",
                     prec.alias("precision"), rec.alias("recall"),
                     (F.sum("tp").over(whole) / F.sum(F.col("tp") + F.col("fn")).over(whole))
                     .alias("accuracy"))
    out = out.withColumn("f1", F.coalesce(st.safe_div(2 * F.col("precision") * F.col("recall"),
                                                      F.col("precision") + F.col("recall")),
                                          F.lit(0.0)))
    return out.drop("_all") if "_all" in keys else out


def lag_lookup(models: DataFrame, results: DataFrame) -> DataFrame:
    """The lag chosen by a prior result for each model key, 0 when the
    model has no result."""
    r = results.select(*MODEL, F.col("lag").alias("_lag"))
    return models.join(r, MODEL, "left").withColumn("lag", F.coalesce("_lag", F.lit(0))).drop("_lag")
