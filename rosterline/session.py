"""Session settings: for skew on any session, and for local runs and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession


# Runtime settings the joins count on when one key holds a large share of the rows:
# split such a partition even where that costs another exchange.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Switch the skew settings on in the caller's session; they can be changed at run time."""
    for key, value in SKEW_SETTINGS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rosterline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    return prepare(spark)
