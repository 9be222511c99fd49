"""Session settings that suit these plans."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # tables of one run are written at the same time
    "spark.scheduler.mode": "FAIR",
    # 41 tables with a few generated classes each: keep them all compiled
    "spark.sql.codegen.cache.maxEntries": "1000",
}


# The JVM does not compile methods above 8000 bytes of bytecode.  One generated
# method over a hundred decoded columns is far above that and runs interpreted;
# below this limit Spark falls back to generated code split into small methods.
TUNING = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def tune(spark: SparkSession) -> SparkSession:
    """Set what wide rows need on a session made elsewhere."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def session(name: str = "formfold", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **TUNING, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
