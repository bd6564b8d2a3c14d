"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults a job can rely on.  Shuffle width is left to the caller: on a cluster
# a large initial number is coalesced by adaptive execution.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(app: str = "ledgerline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table.

    It lies in the shared folder named by ``spark.checkpoint.dir``.  Only a local
    session without that setting gets a folder of its own; on a cluster a missing
    setting is an error, since executors cannot read each other's local disks.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not context.getCheckpointDir():
            context.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerline-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/ledgerline/{label}-{uuid.uuid4().hex}"
