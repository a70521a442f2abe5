"""Session settings the library is written for.

Only settings a job may choose for itself are listed here; cluster sizing
(executors, memory, shuffle service) stays with whoever submits the job.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

RECOMMENDED = {
    # Instants are stored in UTC; wall-clock time is always derived from an explicit zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Cells of stored records become typed leaves, and a reader of some cells reads their leaves only.
    "spark.sql.variant.writeShredding.enabled": "true",
    "spark.sql.variant.inferShreddingSchema": "true",
    "spark.sql.variant.pushVariantIntoScan": "true",
    # A publish replaces only the partitions present in the written data.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "shiftledger", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or reuse) a session carrying the recommended settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, for staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    own = tempfile.mkdtemp(prefix="shiftledger-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own
