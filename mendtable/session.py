"""Session settings the operators run best with; all are plain runtime settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # moments in text have no zone; a fixed one keeps them the same on every machine
    "spark.sql.session.timeZone": "UTC",
    # columns are known by their names as they stand: ``a`` and ``A`` are two
    "spark.sql.caseSensitive": "true",
    # the virtual machine does not compile methods above 8000 bytes of bytecode; long chains of
    # casts run faster as separate expressions than as one method that is never compiled
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark
