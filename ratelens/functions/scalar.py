"""Scalar column helpers shared by operators (JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(c: Column, decimals: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d (+0.0 folds -0.0): the same IEEE
    operations in every engine, so identical doubles round identically, ties
    included (engines' own ROUND functions differ on ties).  From |x| * 10^d =
    2^53 on a double has no such decimals left and is returned as it is."""
    scale = float(10 ** decimals)
    rounded = F.floor(c * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)
    return F.when(F.abs(c) * F.lit(scale) < F.lit(float(2 ** 53)), rounded).otherwise(c) + F.lit(0.0)


def exact_avg(c: Column, scale_decimals: int) -> Column:
    """Average of a fixed-point column (``scale_decimals`` decimals) as one
    division of an exact integer sum: independent of summation order."""
    scale = 10 ** scale_decimals
    return (F.sum(F.round(c * scale).cast("bigint")) / F.count(c)) / F.lit(float(scale))


def slug(s: Column) -> Column:
    """lower case, spaces -> underscores."""
    return F.replace(F.lower(s), F.lit(" "), F.lit("_"))


def first_non_empty(*cols: Column) -> Column:
    """``a or b`` on strings: empty strings count as missing."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def clamp(c: Column, lo, hi) -> Column:
    """clamp to [lo, hi]."""
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def nan_to_null(c: Column) -> Column:
    """F16: NaN or null -> null."""
    return F.nanvl(c, F.lit(None).cast("double"))
