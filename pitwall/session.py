"""Session settings every plan in this package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    # all event times are UTC wall clock without a zone
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # a hot join key is split at run time even when that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "8", app: str = "pitwall", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own session and only needs `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # the wide plans here hold several hundred generated classes; the default cache of 100 would compile them anew
        .config("spark.sql.codegen.cache.maxEntries", "4000")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
