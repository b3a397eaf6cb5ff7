"""Statistics as column expressions over aggregated moments.

Everything here is a pure ``Column -> Column`` function, evaluated JVM-side
inside whole-stage codegen on rows that already hold second moments (one row
per analysed group), never on raw observations.

Division by zero, negative radicands from rounding and NaN all map to null,
so callers can apply fallbacks with ``coalesce``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _null() -> Column:
    return F.lit(None).cast("double")


def finite(x: Column) -> Column:
    """Null for NaN, else x (x is evaluated once)."""
    return F.nanvl(x, _null())


def safe_sqrt(x: Column) -> Column:
    return F.sqrt(F.greatest(x, F.lit(0.0)))


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null when b is 0 or the result is NaN."""
    return finite(F.try_divide(a, b))


def corr(cov_xy: Column, var_x: Column, var_y: Column) -> Column:
    """Pearson r from sample (co)variances; null for a constant series."""
    return safe_div(cov_xy, safe_sqrt(var_x * var_y))


def partial(r_xy: Column, r_xz: Column, r_yz: Column) -> Column:
    """First-order partial correlation of x and y given z."""
    return safe_div(r_xy - r_xz * r_yz, safe_sqrt((1 - r_xz * r_xz) * (1 - r_yz * r_yz)))


def partial2(r_xy_t: Column, r_xz_t: Column, r_yz_t: Column) -> Column:
    """Second-order partial correlation of x and y given z and t by the
    recursive formula: pass the first-order partials given t (materialise them
    as columns first: ``partial(r_xy, r_xt, r_yt)`` etc.)."""
    return partial(r_xy_t, r_xz_t, r_yz_t)


def r2_two(r_xy: Column, r_zy: Column, r_xz: Column) -> Column:
    """R^2 of OLS y ~ 1 + x + z from the three pairwise correlations."""
    return safe_div(r_xy * r_xy + r_zy * r_zy - 2 * r_xy * r_zy * r_xz, 1 - r_xz * r_xz)


# SQL-text twins of the formulas above (one parse per expression; used on the
# hot paths where the operands are plain column names)
_NULLD = "CAST(NULL AS DOUBLE)"


def corr_sql(cov: str, va: str, vb: str) -> str:
    return f"nanvl(try_divide({cov}, sqrt(greatest({va} * {vb}, 0D))), {_NULLD})"


def partial_sql(rxy: str, rxz: str, ryz: str) -> str:
    return (f"nanvl(try_divide({rxy} - {rxz} * {ryz}, "
            f"sqrt(greatest((1D - {rxz} * {rxz}) * (1D - {ryz} * {ryz}), 0D))), {_NULLD})")


def r2_sql(rxy: str, rzy: str, rxz: str) -> str:
    return (f"nanvl(try_divide({rxy} * {rxy} + {rzy} * {rzy} - 2D * {rxy} * {rzy} * {rxz}, "
            f"1D - {rxz} * {rxz}), {_NULLD})")


def _series_sum(c: Column, terms: Column, odd: bool) -> Column:
    """sum_{k=0}^{terms-1} c^k * prod_{j=1}^{k} f(j) with f(j) = (2j-1)/(2j) for
    even degrees of freedom and (2j)/(2j+1) for odd ones."""
    seq = F.when(terms > 1, F.sequence(F.lit(1), terms - 1)).otherwise(
        F.array().cast("array<int>"))

    def step(acc, j):
        jd = j.cast("double")
        ratio = (2 * jd) / (2 * jd + 1) if odd else (2 * jd - 1) / (2 * jd)
        term = acc["term"] * c * ratio
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    init = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
    return F.when(terms >= 1, F.aggregate(seq, init, step)["total"]).otherwise(F.lit(0.0))


def r_pvalue(r: Column, dof: Column) -> Column:
    """Two-sided p-value of a (partial) correlation r with integer degrees
    of freedom ``dof`` (n - 2 - number of covariates).

    Student-t tail in closed form for integer df (Abramowitz & Stegun
    26.7.3/26.7.4): with c = 1 - r^2 (= cos^2 theta) and s = |r| (= sin theta)
      even df:  A = s * S_even(c, df/2)
      odd df:   A = 2/pi * (asin(s) + s*sqrt(c) * S_odd(c, (df-1)/2))   (df >= 3)
                A = 2/pi * asin(s)                                        (df = 1)
    p = 1 - A.  Absolute accuracy about 1e-15.
    """
    s = F.abs(r)
    c = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - r * r))
    d = dof.cast("int")
    even_terms = (d / 2).cast("int")
    odd_terms = ((d - 1) / 2).cast("int")
    a_even = s * _series_sum(c, even_terms, odd=False)
    a_odd = (2 / math.pi) * (F.asin(F.least(s, F.lit(1.0)))
                             + s * F.sqrt(c) * _series_sum(c, odd_terms, odd=True))
    a = F.when(d % 2 == 0, a_even).otherwise(a_odd)
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 1 - a))
    return (F.when(r.isNull() | dof.isNull() | (d <= 0), F.lit(None).cast("double"))
            .when(c <= 0, F.lit(0.0))
            .otherwise(p))


def r_pvalue_sql(r: str, dof: str) -> Column:
    """``r_pvalue`` for column names / SQL snippets, built as one SQL
    expression (one parse instead of hundreds of client-side Column calls;
    same formula and evaluation)."""
    c = f"greatest(0D, least(1D, 1D - ({r}) * ({r})))"
    s = f"abs({r})"
    d = f"CAST({dof} AS INT)"

    def series(terms: str, odd: bool) -> str:
        ratio = "(2D * j) / (2D * j + 1D)" if odd else "(2D * j - 1D) / (2D * j)"
        return (f"CASE WHEN {terms} >= 1 THEN aggregate("
                f"CASE WHEN {terms} > 1 THEN sequence(1, {terms} - 1) ELSE array() END, "
                f"named_struct('term', 1D, 'total', 1D), "
                f"(acc, j) -> named_struct('term', acc.term * {c} * {ratio}, "
                f"'total', acc.total + acc.term * {c} * {ratio})).total ELSE 0D END")
    even_terms = f"CAST({d} / 2 AS INT)"
    odd_terms = f"CAST(({d} - 1) / 2 AS INT)"
    a = (f"CASE WHEN {d} % 2 = 0 THEN {s} * ({series(even_terms, False)}) "
         f"ELSE {2 / math.pi!r} * (asin(least({s}, 1D)) + {s} * sqrt({c}) * "
         f"({series(odd_terms, True)})) END")
    return F.expr(f"CASE WHEN ({r}) IS NULL OR ({dof}) IS NULL OR {d} <= 0 THEN CAST(NULL AS DOUBLE) "
                  f"WHEN {c} <= 0 THEN 0D ELSE greatest(0D, least(1D, 1D - ({a}))) END")


def fisher_ci(r: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """95% confidence interval of r via Fisher's z transform."""
    fz = F.atanh(F.least(F.greatest(r, F.lit(-0.999999999999)), F.lit(0.999999999999)))
    half = safe_div(F.lit(z), F.sqrt((n - 3).cast("double")))
    ok = n > 3
    return (F.when(ok, F.tanh(fz - half)), F.when(ok, F.tanh(fz + half)))


def rank_key(x: Column, decimals: int) -> Column:
    """Sort key for |statistic| rankings: rounded so differences below
    numerical noise become ties resolved by the caller's secondary keys."""
    return F.round(F.abs(x), decimals)
