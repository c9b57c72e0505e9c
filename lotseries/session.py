"""Session settings the operators are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Joins look up one row per key for many rows, so a hot key makes one side's partition large.
# The adaptive skew join splits such a partition by size, whatever the key. "Force" lets it
# do so even where a later operator could otherwise have reused the partitioning.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows that a window or a join has sorted already are aggregated as they come.
    "spark.sql.execution.replaceHashWithSortAgg": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows go to Python in batches of bounded size, however long their texts are.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
