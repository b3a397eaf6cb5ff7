"""Registered queries: one per inventory item of the survey (driver contract).

Every query reads the driver tables of ``sf_dir`` (through the star-schema
sources) and runs over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import oracle as O
from .correlation import correlation_batch
from .registry import finish, register
from .star import Star

CORR_COLS = ["country_code", "sector_id", "rate_basis", "target_variable", "lag",
             "panel_start", "panel_end", "n_obs", "control_set", "pearson_r", "partial_r",
             "p_value", "r_squared"]


@register("q01_correlation_batch", O.q01_sql)
def q01_correlation_batch(spark: SparkSession, sf: str) -> DataFrame:
    return finish(correlation_batch(Star(spark, sf)).select(*CORR_COLS))
