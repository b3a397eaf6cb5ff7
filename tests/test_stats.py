"""Statistics expressions against numpy and t-table values (G07-G11, G08,
G24 CI)."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratelens.functions import stats as st

# two-sided 5% critical values of Student's t (standard tables)
T_975 = {1: 12.70620474, 2: 4.30265273, 5: 2.57058184, 10: 2.22813885, 30: 2.04227246,
         100: 1.98397152}


@pytest.mark.parametrize("df", sorted(T_975))
def test_pvalue_matches_t_table(spark, df):
    t = T_975[df]
    r = t / math.sqrt(t * t + df)
    p = spark.range(1).select(st.r_pvalue(F.lit(r), F.lit(df)).alias("p")).first()["p"]
    assert abs(p - 0.05) < 1e-7


def test_pvalue_edges(spark):
    row = spark.range(1).select(
        st.r_pvalue(F.lit(1.0), F.lit(10)).alias("perfect"),
        st.r_pvalue(F.lit(0.0), F.lit(10)).alias("zero"),
        st.r_pvalue(F.lit(0.3), F.lit(0)).alias("nodf"),
        st.r_pvalue(F.lit(None).cast("double"), F.lit(5)).alias("null")).first()
    assert row["perfect"] == 0.0
    assert abs(row["zero"] - 1.0) < 1e-12
    assert row["nodf"] is None and row["null"] is None


def _numpy_partial(data: np.ndarray) -> float:
    """partial correlation of columns 0 and 1 given the rest (precision matrix)."""
    p = np.linalg.pinv(np.cov(data, rowvar=False))
    return -p[0, 1] / math.sqrt(p[0, 0] * p[1, 1])


def test_moment_formulas_match_numpy(spark):
    rng = np.random.default_rng(7)
    n = 60
    z = rng.normal(size=n)
    t = np.arange(n, dtype=float)
    x = 0.5 * z + rng.normal(size=n) + 0.01 * t
    y = 0.3 * x - 0.4 * z + rng.normal(size=n)
    df = spark.createDataFrame([(float(a), float(b), float(c), float(d)) for a, b, c, d in
                                zip(x, y, z, t)], "x double, y double, z double, t double")
    m = df.agg(F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"), F.var_samp("z").alias("vz"),
               F.var_samp("t").alias("vt"), F.covar_samp("x", "y").alias("cxy"),
               F.covar_samp("x", "z").alias("cxz"), F.covar_samp("y", "z").alias("cyz"),
               F.covar_samp("x", "t").alias("cxt"), F.covar_samp("y", "t").alias("cyt"),
               F.covar_samp("z", "t").alias("czt"))
    c = F.col
    m = m.select("*", st.corr(c("cxy"), c("vx"), c("vy")).alias("rxy"),
                 st.corr(c("cxz"), c("vx"), c("vz")).alias("rxz"),
                 st.corr(c("cyz"), c("vy"), c("vz")).alias("ryz"),
                 st.corr(c("cxt"), c("vx"), c("vt")).alias("rxt"),
                 st.corr(c("cyt"), c("vy"), c("vt")).alias("ryt"),
                 st.corr(c("czt"), c("vz"), c("vt")).alias("rzt"))
    m = m.select("*", st.partial(c("rxy"), c("rxz"), c("ryz")).alias("p1"),
                 st.partial(c("rxy"), c("rxt"), c("ryt")).alias("a"),
                 st.partial(c("rxz"), c("rxt"), c("rzt")).alias("b"),
                 st.partial(c("ryz"), c("ryt"), c("rzt")).alias("cc"),
                 st.r2_two(c("rxy"), c("ryz"), c("rxz")).alias("r2"))
    row = m.select("rxy", "p1", "r2", st.partial2(c("a"), c("b"), c("cc")).alias("p2")).first()
    assert abs(row["rxy"] - np.corrcoef(x, y)[0, 1]) < 1e-12
    assert abs(row["p1"] - _numpy_partial(np.column_stack([x, y, z]))) < 1e-12
    assert abs(row["p2"] - _numpy_partial(np.column_stack([x, y, z, t]))) < 1e-12
    design = np.column_stack([np.ones(n), x, z])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    r2 = 1 - np.sum((y - design @ beta) ** 2) / np.sum((y - y.mean()) ** 2)
    assert abs(row["r2"] - r2) < 1e-12


def test_constant_series_gives_null_not_error(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(10)], "x double, y double")
    row = df.agg(F.var_samp("x").alias("vx"), F.var_samp("y").alias("vy"),
                 F.covar_samp("x", "y").alias("c")).select(
        st.corr(F.col("c"), F.col("vx"), F.col("vy")).alias("r")).first()
    assert row["r"] is None


def test_fisher_ci_brackets_r(spark):
    lo, hi = st.fisher_ci(F.lit(0.4), F.lit(50))
    row = spark.range(1).select(lo.alias("lo"), hi.alias("hi")).first()
    z = math.atanh(0.4)
    assert abs(row["lo"] - math.tanh(z - 1.959963984540054 / math.sqrt(47))) < 1e-12
    assert abs(row["hi"] - math.tanh(z + 1.959963984540054 / math.sqrt(47))) < 1e-12


def test_sql_pvalue_equals_column_pvalue(spark):
    rows = [(r, d) for r in (-0.93, -0.4, 0.0, 0.05, 0.31, 0.77, 0.999) for d in (1, 2, 3, 8, 41, 76)]
    df = spark.createDataFrame(rows, "r double, d int")
    out = df.select(st.r_pvalue(F.col("r"), F.col("d")).alias("a"),
                    st.r_pvalue_sql("r", "d").alias("b")).collect()
    for a, b in out:
        assert abs(a - b) < 1e-15
