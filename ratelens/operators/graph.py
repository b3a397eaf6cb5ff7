"""Connected components of a link table by smallest-label propagation.

Every round a node takes the smallest label among its neighbours and then the label
of its label, so labels travel along paths in doubling steps.  Rounds are aggregates
and shuffle joins, each written under the shared checkpoint folder; nothing is
collected but the count of changed labels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sinks.tables import write_snapshot


def _written(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    return spark.read.schema(df.schema).parquet(write_snapshot(df, scratch_path(spark, name)))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for every linked node; the label is the smallest node that
    it reaches."""
    one = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = _written(one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = _written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("label").alias("seen")), "b") \
            .groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        hooked = labels.join(near, "node").select("node", F.col("label").alias("old"),
                                                  F.least("label", "seen").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = _written(hooked.join(up, "label", "left").select(
            "node", "old", F.least("label", F.coalesce("above", "label")).alias("label")), "labels")
        labels = moved.select("node", "label")
        if moved.where("old <> label").limit(1).count() == 0:
            return labels
