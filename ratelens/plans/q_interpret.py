"""Registered queries of result interpretation (Q05, F02, F18, F20, F21,
J11, X04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import interpret as it
from ..schema import empty
from ..session import scratch_path
from ..sinks import tables as sink
from . import oracle as O
from .correlation import correlation_batch
from .q_correlation import RUN_B, _runs_sql
from .registry import finish, register
from .star import Star

KEYS = ["country_code", "sector_id", "rate_basis", "target_variable"]


def fixed_sql(x: str, d: int, signed: bool = False) -> str:
    scale = 10 ** d
    v = f"CAST(floor(abs({x}) * {float(scale)} + 0.5) AS BIGINT)"
    body = f"(CAST({v} // {scale} AS VARCHAR) || '.' || lpad(CAST({v} % {scale} AS VARCHAR), {d}, '0'))"
    sign = f"(CASE WHEN ({x}) < 0 AND {v} > 0 THEN '-' ELSE '{'+' if signed else ''}' END)"
    return f"(CASE WHEN ({x}) IS NULL THEN NULL ELSE {sign} || {body} END)"


def band_sql(r: str) -> str:
    return (f"(CASE WHEN abs({r}) < 0.2 THEN 'very weak' WHEN abs({r}) < 0.3 THEN 'weak' "
            f"WHEN abs({r}) < 0.5 THEN 'moderate' ELSE 'strong' END)")


def cache_key_sql() -> str:
    ctrl = "CASE WHEN coalesce(control_set, '') = '' THEN 'None' ELSE control_set END"
    parts = ["country_code", "sector_id", "rate_basis", "target_variable", ctrl,
             fixed_sql("pearson_r", 3), fixed_sql("partial_r", 3), fixed_sql("p_value", 3),
             fixed_sql("r_squared", 3), "CAST(lag AS VARCHAR)"]
    return "substr(sha256(concat_ws('|', " + ", ".join(parts) + ")), 1, 32)"


def text_sql() -> str:
    tgt = ("(CASE WHEN target_variable = 'equity_valuation' THEN sector_name || ' sector valuation' "
           "ELSE sector_name || ' spot price' END)")
    delay = ("(CASE WHEN lag = 0 THEN 'within the same month' WHEN lag = 1 THEN 'one month later' "
             "ELSE CAST(lag AS VARCHAR) || ' months later' END)")
    timing = ("'Timing: ' || rate_basis || ' rate moves of ' || country_name || ' line up best with the ' || "
              + tgt + " || ' measured ' || " + delay + " || '.'")
    link = ("'Link: ' || " + band_sql("partial_r") + " || ', the two tend to move ' || (CASE WHEN partial_r >= 0 "
            "THEN 'together' ELSE 'in opposite directions' END) || ' (partial r ' || "
            + fixed_sql("partial_r", 2, True) + " || ').'")
    evidence = ("'Evidence: p ' || " + fixed_sql("p_value", 3) + " || (CASE WHEN p_value < 0.05 THEN "
                "' passes the 0.05 level.' ELSE ' fails the 0.05 level, so chance remains an adequate account.' END)")
    share = ("'Share: the fit covers ' || CAST(CAST(floor(r_squared * 100 + 0.5) AS BIGINT) AS VARCHAR) || "
             "'% of month-to-month changes (R2 ' || " + fixed_sql("r_squared", 2) + " || ').'")
    control = ("'Control: ' || (CASE WHEN coalesce(control_set, '') = '' THEN 'none (raw correlation only)' ELSE "
               "replace(control_set, '_', ' ') END) || '.'")
    return f"concat_ws(' ', {timing}, {link}, {evidence}, {share}, {control})"


_LABELLED = """
, lab AS (
  SELECT r.*, d.country_name,
         upper(substr(r.sector_id, 1, 1)) || substr(r.sector_id, 2) AS sector_name
  FROM result r LEFT JOIN s_dim_country d ON r.country_code = d.country_code)"""


def _q01_labelled_sql(select: str) -> str:
    return O.with_ctes(O.correlate_sql("s_leads") + _LABELLED + "\n" + select,
                       "s_leads", "s_dim_country")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    star = Star(spark, sf)
    b = correlation_batch(star).select(*KEYS, "lag", "control_set", "pearson_r", "partial_r",
                                       "p_value", "r_squared")
    return it.with_labels(b, star.dim_country, star.dim_sector)


@register("f02_cache_key", lambda: _q01_labelled_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, " + cache_key_sql()
    + " AS cache_key FROM lab"))
def f02(spark: SparkSession, sf: str) -> DataFrame:
    return finish(it.with_cache_key(_labelled(spark, sf)).select(*KEYS, "cache_key"))


@register("f18_strength_band", lambda: _q01_labelled_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, " + band_sql("partial_r")
    + " AS strength, p_value < 0.05 AS significant FROM lab"))
def f18(spark: SparkSession, sf: str) -> DataFrame:
    b = _labelled(spark, sf)
    return finish(b.select(*KEYS, it.strength_band(F.col("partial_r")).alias("strength"),
                           it.significant(F.col("p_value")).alias("significant")))


@register("f20_interpretation", lambda: _q01_labelled_sql(
    "SELECT country_code, sector_id, rate_basis, target_variable, " + text_sql()
    + " AS interpretation_text FROM lab"))
def f20(spark: SparkSession, sf: str) -> DataFrame:
    t = it.rule_text(_labelled(spark, sf))
    return finish(t.select(*KEYS, "interpretation_text"))


@register("f21_display_labels", lambda: _q01_labelled_sql("""
SELECT country_code, sector_id, rate_basis, target_variable, country_name, sector_name,
  CASE WHEN target_variable = 'equity_valuation' THEN sector_name || ' sector valuation'
       ELSE sector_name || ' spot price' END AS target_label,
  CASE WHEN coalesce(control_set, '') = '' THEN 'none (raw correlation only)'
       ELSE replace(control_set, '_', ' ') END AS control_label,
  country_code || '/' || sector_id AS pair_key FROM lab"""))
def f21(spark: SparkSession, sf: str) -> DataFrame:
    b = _labelled(spark, sf)
    return finish(b.select(*KEYS, "country_name", "sector_name",
                           it.target_label(F.col("target_variable"), F.col("sector_name")).alias("target_label"),
                           it.control_label(F.col("control_set")).alias("control_label"),
                           it.pair_key(F.col("country_code"), F.col("sector_id")).alias("pair_key")))


def _answers(spark: SparkSession, sf: str, generator=None):
    """Run A (control pinned) is explained first and its texts upserted into
    the interpretation cache table (a snapshot under the shared folder); run
    B (control search) is then looked up against that table."""
    star = Star(spark, sf)
    cols = [*KEYS, "lag", "control_set", "pearson_r", "partial_r", "p_value", "r_squared"]
    a = correlation_batch(star, controls=["cpi_inflation"]).select(*cols)
    b = correlation_batch(star).select(*cols)
    cache0 = empty(spark, "fact_interpretation")
    _, new_rows = it.lookup_or_generate(a, cache0, star.dim_country, star.dim_sector)
    root = scratch_path(spark, f"interpretation-cache-{sink.unique_suffix()}")
    cache_path = sink.write_snapshot(sink.upsert(cache0, new_rows, ["cache_key"]), root,
                                     "fact_interpretation")
    cache = spark.read.parquet(cache_path)
    answers, _ = it.lookup_or_generate(b, cache, star.dim_country, star.dim_sector,
                                       generator=generator)
    return answers


def _runs_labelled(select: str) -> str:
    lab = f"""
, hl AS (
  SELECT h.*, d.country_name, upper(substr(h.sector_id, 1, 1)) || substr(h.sector_id, 2) AS sector_name,
         h.computed_at = TIMESTAMP '{RUN_B[1]}' AS is_b
  FROM hist h LEFT JOIN s_dim_country d ON h.country_code = d.country_code),
keyed AS (SELECT *, {cache_key_sql()} AS cache_key FROM hl),
cache AS (SELECT DISTINCT cache_key FROM keyed WHERE NOT is_b),
ans AS (SELECT k.*, CASE WHEN k.cache_key IN (SELECT cache_key FROM cache) THEN 'cache'
                          ELSE 'generated' END AS source
        FROM keyed k WHERE is_b)"""
    return _runs_sql(lab + "\n" + select)  # s_dim_country is part of the s_leads chain


@register("j11_cache_lookup", lambda: _runs_labelled(
    "SELECT country_code, sector_id, rate_basis, target_variable, cache_key, source FROM ans"))
def j11(spark: SparkSession, sf: str) -> DataFrame:
    return finish(_answers(spark, sf).select(*KEYS, "cache_key", "source"))


@register("q05_interpret", lambda: _runs_labelled(
    "SELECT country_code, sector_id, rate_basis, target_variable, source, " + text_sql()
    + " AS interpretation_text FROM ans"))
def q05(spark: SparkSession, sf: str) -> DataFrame:
    """Interpretations of run B's results: cached text where run A already
    explained the identical result, generated otherwise."""
    return finish(_answers(spark, sf).select(*KEYS, "source", "interpretation_text"))


def _echo_generator(pdf):
    """Stand-in text generator plug-in (deterministic): returns the rule text."""
    return pdf["interpretation_text"]


@register("x04_text_generator", lambda: _runs_labelled(
    "SELECT country_code, sector_id, rate_basis, target_variable, " + text_sql()
    + " AS interpretation_text FROM ans WHERE source = 'generated'"))
def x04(spark: SparkSession, sf: str) -> DataFrame:
    """Generator plug-in run (Arrow batches) on the cache misses only."""
    a = _answers(spark, sf, generator=_echo_generator)
    return finish(a.where(F.col("source") == "generated").select(*KEYS, "interpretation_text"))
