"""Session settings the operators are written for."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan with measured sizes: join sides, partition counts, skewed partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even when the rows must be shuffled once more afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Rows of whole texts are large: fewer of them in what a Python worker gets at a time.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Remove checkpoint files once nothing reads from them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def with_settings(builder: SparkSession.Builder, shuffle_partitions: int | None = None) -> SparkSession.Builder:
    """Apply the settings; on a cluster give two to four shuffle partitions per core or more and let them merge."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder


def apply_settings(spark: SparkSession) -> None:
    """Apply those settings that a running session still takes."""
    for name, value in SETTINGS.items():
        if spark.conf.isModifiable(name):
            spark.conf.set(name, value)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that they need not have it installed.

    The archive is built beside the driver and served by it; workers on other machines fetch it from there.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="perkwell-package-"), "perkwell.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(here):
            for file in files:
                if file.endswith(".py"):
                    path = os.path.join(folder, file)
                    out.write(path, os.path.join("perkwell", os.path.relpath(path, here)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
