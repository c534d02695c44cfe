"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even where that costs one more shuffle after the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tierwork", **extra: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own with SETTINGS."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {
        **SETTINGS, "spark.sql.shuffle.partitions": str(shuffle_partitions), "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.sql.warehouse.dir": "/tmp/tierwork-warehouse", **extra,
    }.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
