"""Session settings the models rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Timestamps are UTC instants; bad money must fail loudly, not wrap.
SEMANTICS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results; sizing stays with the cluster."""
    for key, value in SEMANTICS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(
    cores: str = "*", shuffle_partitions: int = 8, app: str = "wagerlens", java_options: str = ""
) -> SparkSession:
    """A small local session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", java_options)
        .config("spark.ui.enabled", "false")
        # Recording the Python call site of every column costs more than planning a small query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
