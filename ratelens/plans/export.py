"""Q06: CSV export by scope and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import RATE_INDICATORS
from ..operators import articles as ar
from ..sinks import tables as sink
from .correlation import check_pair
from .star import Star

SCOPES = ("correlation", "articles")
RESULT_KEYS = ["country_code", "sector_id", "rate_basis", "target_variable"]
RESULT_COLS = ["result_id", *RESULT_KEYS, "control_set", "date_range_start", "date_range_end", "lag", "pearson_r",
               "partial_r", "p_value", "r_squared", "computed_at"]


def latest_results(history: DataFrame) -> DataFrame:
    """One row per full result key: the newest, ties by result id."""
    rest = [c for c in RESULT_COLS if c not in RESULT_KEYS]
    best = history.groupBy(*RESULT_KEYS).agg(
        F.max_by(F.struct(*rest), F.struct("computed_at", "result_id")).alias("l"))
    return best.select(*RESULT_KEYS, "l.*").select(*RESULT_COLS)


def export_rows(star: Star, scope: str, history: DataFrame | None = None, country: str | None = None,
                sector: str | None = None, rate_basis: str | None = None, start: str | None = None,
                end: str | None = None) -> DataFrame:
    """The rows of an export.  ``correlation``: the latest result of every key that the
    filters leave; ``articles``: the export columns of the articles in the day range
    that mention the country and sector, each once.  A filter that is not given does
    not restrict; an unknown scope, country, sector or basis is an error."""
    ar.require(scope, SCOPES, "scope")
    ar.require(rate_basis, list(RATE_INDICATORS), "rate_basis")
    check_pair(star, country, sector)
    if scope == "articles":
        found = ar.filter_articles(star.fact_article, star.bridge_article_country, star.bridge_article_sector,
                                   country, sector, None, start, end)
        return found.select(*ar.EXPORT_COLS)
    if history is None:
        raise ValueError("scope correlation needs the result history")
    for column, value in (("country_code", country), ("sector_id", sector), ("rate_basis", rate_basis)):
        if value is not None:
            history = history.where(F.col(column) == F.lit(value))
    return latest_results(history)


def export(spark: SparkSession, star: Star, path: str, scope: str, **filters) -> DataFrame | None:
    """Write the export as CSV with a header and return what a reader gets back, None
    when the filters leave no row (nothing is written then)."""
    rows = export_rows(star, scope, **filters)
    if not sink.export_csv(rows, path):
        return None
    return spark.read.option("header", True).options(**sink.CSV_TIMES).schema(rows.schema).csv(path)
