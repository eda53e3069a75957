"""Session settings the jobs are designed for."""

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Splits the hot side of a join; coalesces the many small partitions.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Size of shuffle partitions after coalescing, and so of stored files.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Lets the scan skip row groups with the bound a scalar subquery returns.
    "spark.sql.parquet.filterPushdown": "true",
    "spark.ui.enabled": "false",
}


def session(app: str = "ordertide", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
