"""SparkSession construction and session-scoped settings."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "ratelens",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session with UTC time zone, ANSI mode and AQE switched on.

    On a cluster ``master`` is left to spark-submit; locally pass e.g.
    ``local[8]``.  ``shuffle_partitions`` should be sized so a shuffle
    partition stays in the low hundreds of MB at the target scale; AQE then
    coalesces small ones at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read.  When
    it is unset in local mode (tests) a private scratch folder is created and
    set; on a cluster an unset folder is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="ratelens-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate
    tables, stream checkpoints and sinks of one job."""
    root = ensure_checkpoint_dir(spark)
    return f"{root.rstrip('/')}/{name}"
