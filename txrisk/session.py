"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# The two sizes let Spark filter the alerts of all ages by the ids of a busy
# period before they are shuffled; its own limit for the period's side is 10 MB.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "10g",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "10g",
}


def build_session(app: str = "txrisk", **conf: str) -> SparkSession:
    """Session with the settings above; the master comes from spark-submit."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """New folder name under the cluster's shared checkpoint folder.

    A machine-local folder is used only by a local session that has no
    ``spark.checkpoint.dir``; on a cluster other executors could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="txrisk-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"
