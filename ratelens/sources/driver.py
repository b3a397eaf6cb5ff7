"""Scan of the driver-provided Parquet tables (S09 building block).

Every read names its columns so the Parquet scan's ReadSchema carries only
what the plan uses; filters written downstream are pushed into the scan by
Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan of one driver table, projected to ``columns``.  Files are listed
    anew on every call, so an append is seen."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> None:
    """Expose driver tables as temp views for ``spark.sql``."""
    for name in names or DRIVER_TABLES:
        read(spark, sf_dir, name).createOrReplaceTempView(name)
