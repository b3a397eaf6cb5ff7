"""Composite entry points in their full extent (Q06, Q08, Q11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import regression as rg
from ..operators import series as se
from ..sinks import tables as sink
from ..sources import landed
from ..streaming import pipeline as sp
from . import oracle as O
from . import q_ml
from .export import RESULT_COLS, export
from .q_articles import END, START, _star
from .q_correlation import KEYS4, _HIST_COLS, _history, _runs_sql
from .q_series import _sheet
from .registry import ORACLE, finish, register
from .star import Star

EXPORT_COUNTRY = "N07"


def _scratch(spark: SparkSession, name: str) -> str:
    return sp.scratch(spark, name)[0]


def _or_empty(df: DataFrame | None, rows: DataFrame) -> DataFrame:
    return rows.limit(0) if df is None else df


@register("q06_export_results", lambda: _runs_sql(f"""
SELECT {_HIST_COLS}, {O.r6('partial_r', 'partial_r')}, {O.r6('p_value', 'p_value')} FROM (
  SELECT *, row_number() OVER (PARTITION BY country_code, sector_id, rate_basis, target_variable
                               ORDER BY computed_at DESC, result_id DESC) AS rn
  FROM hist WHERE rate_basis = 'real') t WHERE rn = 1"""))
def q06_results(spark: SparkSession, sf: str) -> DataFrame:
    """Export with scope correlation: the latest result of every key with the real
    rate, with all its statistics, written as CSV and read back."""
    h = _history(spark, sf)
    back = export(spark, Star(spark, sf), _scratch(spark, "export"), "correlation", history=h, rate_basis="real")
    return finish(_or_empty(back, h.select(*RESULT_COLS)))


@register("q06_export_articles", lambda: O.with_ctes(f"""
SELECT title, article_category, {O.r6('sentiment_score', 'sentiment_score')}, source_url, published
FROM s_articles WHERE day BETWEEN DATE '{START}' AND DATE '{END}'
  AND article_id IN (SELECT article_id FROM s_bridge_country WHERE country_code = '{EXPORT_COUNTRY}')""",
    "s_articles", "s_bridge_country"))
def q06_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Export with scope articles: those of one country in a day range, written as CSV
    and read back."""
    star = _star(spark, sf)
    back = export(spark, star, _scratch(spark, "export"), "articles", country=EXPORT_COUNTRY, start=START, end=END)
    return finish(_or_empty(back, star.fact_article.select("title", "article_category", "sentiment_score",
                                                           "source_url", "published")))


@register("q08_market_facts", lambda: O.with_ctes(f"""
SELECT 'price' AS fact, price_id AS id, date_key, sector_id, {O.r6('price_index', 'level')},
       {O.r6('price_change', 'change')} FROM s_commodity_fact
UNION ALL
SELECT 'valuation', valuation_id, date_key, sector_id, {O.r6('valuation_index', 'level')},
       {O.r6('valuation_change', 'change')} FROM s_equity_fact""", "s_commodity_fact", "s_equity_fact"))
def q08_facts(spark: SparkSession, sf: str) -> DataFrame:
    """The market run: prices from the sheet landed as CSV under a banner, valuations from the price
    history, each turned into changes and upserted on its key (a second run over the
    same sheet changes nothing)."""
    star = Star(spark, sf)
    sheet = _sheet(spark, sf)
    columns = sheet.columns
    path = _scratch(spark, "sheet")
    banner = spark.createDataFrame([("Monthly prices",), (",".join(columns),)], "value string").coalesce(1)
    banner.write.mode("append").text(path)
    sheet.write.mode("append").option("header", False).csv(path)
    read = landed.read_price_sheet(spark, path, columns)
    mapping = {c.lower(): c for c in columns[1:]}
    prices = se.commodity_fact(landed.sheet_to_long(read, mapping))
    root = _scratch(spark, "market")
    first = spark.read.parquet(sink.write_snapshot(prices, f"{root}/price"))
    prices = sink.upsert(first, prices, ["price_id"])
    valuations = spark.read.parquet(sink.write_snapshot(star.fact_equity_valuation, f"{root}/valuation"))

    def rows(df: DataFrame, fact: str, key: str, level: str, change: str) -> DataFrame:
        return df.select(F.lit(fact).alias("fact"), F.col(key).alias("id"), "date_key", "sector_id",
                         F.col(level).alias("level"), F.col(change).alias("change"))
    return finish(rows(prices, "price", "price_id", "price_index", "price_change").unionByName(
        rows(valuations, "valuation", "valuation_id", "valuation_index", "valuation_change")))


_STATS = ["coef", "se", "T", "pval", "r2", "adj_r2", "ci_low", "ci_high"]
_KEYS = "country_code, sector_id, rate_basis, target_variable, lag"


def _report_sql() -> str:
    def long(query: str, section: str, item: str, pairs: list[tuple[str, str]]) -> list[str]:
        """Each measure of a registered query as rows of one section."""
        return [f"SELECT {_KEYS}, '{section}' AS section, {item} AS item, {other} AS other, "
                f"CAST({value} AS DOUBLE) AS value FROM ({ORACLE[query]}) t" for other, value in pairs]
    parts = long("g13_ols_coefficients", "coefficient", "names", [(f"'{s}'", f'"{s}"') for s in _STATS])
    parts += long("g14_coef_ranking", "ranking", "names", [("'rank'", '"rank"'), ("'sign'", '"sign"')])
    parts += long("g15_corr_matrix", "matrix", "var_i", [("var_j", "r")])
    parts += long("g16_residuals", "observation", "strftime(month, '%Y-%m')",
                  [("'fitted'", "fitted"), ("'residual'", "residual")])
    return "\nUNION ALL\n".join(parts)


@register("q11_regression_report", _report_sql)
def q11_report(spark: SparkSession, sf: str) -> DataFrame:
    """The whole diagnostics of every model: coefficient table, ranking, correlation
    matrix, fitted values and residuals, as (section, item, other, value).  The
    observations are written once and all four parts read them."""
    path = _scratch(spark, "model-obs")
    q_ml._mobs(spark, sf).write.parquet(path)
    obs = spark.read.parquet(path)
    coefs = rg.ols_two(obs, q_ml._rate_name(), q_ml.CONTROL)
    return finish(rg.diagnostics(obs, coefs))


@register("g25_any_controls", lambda: ORACLE["g25_multi_control"].replace("AS partial_p", "AS pval"))
def g25_any(spark: SparkSession, sf: str) -> DataFrame:
    """The rate's row of the regression on any controls (here two): partial r, R^2 and p
    from the swept Gram matrix."""
    obs = rg.model_observations(q_ml._leads(spark, sf), q_ml.MULTI, lags=(0, 1, 2, 3))
    table = rg.ols_many(obs, ["x", "z1", "z2"], q_ml.MK)
    return finish(table.where("names = 'x'").select(*KEYS4, "lag", "n", "partial_r", F.col("r2").alias("r_squared"), "pval"))
