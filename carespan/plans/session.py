"""Session settings the jobs count on; all can be set on a running session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # split a hot partition of a shuffle join even where that costs a shuffle
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a task of joins and aggregates takes up to 25 times what its shuffled rows fill packed
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # Spark's size check takes a file's bytes for its rows' bytes; staged lookups (zstd) were
    # seen to fill 4 to 43 times that in memory, and the driver holds all that is broadcast
    "spark.sql.sources.fileCompressionFactor": "16",
    # the JVM does not compile longer methods; beyond it Spark splits the projection,
    # which wide tables of text expressions need
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
