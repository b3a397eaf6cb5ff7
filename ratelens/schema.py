"""Registry of the star-schema tables: one StructType per table plus its key.

Tables are Parquet directories.  Nothing is inferred on read; writes are cast
to the registry type by column name (``conform``), so an all-null column keeps
its declared type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, I, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()


def _struct(*cols: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


TABLES: dict[str, T.StructType] = {
    "dim_source": _struct(("source_id", S), ("source_name", S), ("source_type", S),
                          ("home_country_code", S)),
    "dim_country": _struct(("country_code", S), ("country_name", S), ("region", S)),
    "dim_sector": _struct(("sector_id", S), ("sector_name", S), ("sector_category", S)),
    "dim_indicator": _struct(("indicator_id", S), ("indicator_name", S), ("unit", S),
                             ("source_name", S), ("is_derived", B)),
    "dim_date": _struct(("date_key", S), ("full_date", DT), ("year", I), ("month", I),
                        ("quarter", I)),
    "fact_article": _struct(("article_id", S), ("date_key", S), ("source_id", S),
                            ("article_category", S), ("policy_subtype", S),
                            ("sentiment_score", D), ("sentiment_target", S),
                            ("source_url", S), ("title", S), ("published", TS),
                            ("mech", S), ("policy_stance", S)),
    "fact_macro_indicator": _struct(("record_id", S), ("date_key", S), ("country_code", S),
                                    ("indicator_id", S), ("value", D), ("value_change", D),
                                    ("is_interpolated", B)),
    "fact_commodity_price": _struct(("price_id", S), ("date_key", S), ("sector_id", S),
                                    ("price_index", D), ("price_change", D),
                                    ("production_volume_change", D)),
    "fact_equity_valuation": _struct(("valuation_id", S), ("date_key", S), ("sector_id", S),
                                     ("instrument_type", S), ("valuation_index", D),
                                     ("valuation_change", D)),
    "fact_correlation_result": _struct(("result_id", S), ("country_code", S), ("sector_id", S),
                                       ("rate_basis", S), ("target_variable", S),
                                       ("control_set", S), ("date_range_start", DT),
                                       ("date_range_end", DT), ("lag", I), ("pearson_r", D),
                                       ("partial_r", D), ("p_value", D), ("r_squared", D),
                                       ("computed_at", TS)),
    "bridge_article_country": _struct(("article_id", S), ("country_code", S)),
    "bridge_article_sector": _struct(("article_id", S), ("sector_id", S)),
    "fact_interpretation": _struct(("cache_key", S), ("country_code", S), ("sector_id", S),
                                   ("rate_basis", S), ("target_variable", S),
                                   ("control_used", S), ("interpretation_text", S),
                                   ("model", S), ("source", S), ("created_at", TS)),
    "fact_extraction_queue": _struct(("article_id", S), ("payload", S), ("queued_at", TS)),
    "dim_extraction_budget": _struct(("date_key", S), ("calls_used", I)),
}

KEYS: dict[str, list[str]] = {
    "dim_source": ["source_id"],
    "dim_country": ["country_code"],
    "dim_sector": ["sector_id"],
    "dim_indicator": ["indicator_id"],
    "dim_date": ["date_key"],
    "fact_article": ["article_id"],
    "fact_macro_indicator": ["record_id"],
    "fact_commodity_price": ["price_id"],
    "fact_equity_valuation": ["valuation_id"],
    "fact_correlation_result": ["result_id"],
    "bridge_article_country": ["article_id", "country_code"],
    "bridge_article_sector": ["article_id", "sector_id"],
    "fact_interpretation": ["cache_key"],
    "fact_extraction_queue": ["article_id"],
    "dim_extraction_budget": ["date_key"],
}

# Tag record produced by a tagger (X01) before it is split into star rows.
TAG_RECORD = T.StructType([
    T.StructField("article_category", S, True),
    T.StructField("country_codes", T.ArrayType(S), True),
    T.StructField("sector_tags", T.ArrayType(S), True),
    T.StructField("policy_subtype", T.ArrayType(S), True),
    T.StructField("sentiment_score", D, True),
    T.StructField("sentiment_target", S, True),
    T.StructField("mechanisms", T.ArrayType(S), True),
    T.StructField("policy_stance", S, True),
])

RAW_ARTICLE = _struct(("url", S), ("title", S), ("published", S), ("source", S),
                      ("category", S), ("raw_text", S))


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the registry columns of ``table`` by name, cast to their types
    (K09).  Missing columns become typed nulls; extra columns are dropped."""
    schema = TABLES[table]
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def empty(spark: SparkSession, table: str) -> DataFrame:
    """Typed empty table (S10: create-if-missing)."""
    return spark.createDataFrame([], TABLES[table])
