"""Session construction and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkAttributeError, PySparkNotImplementedError
from pyspark.sql import SparkSession

# Settings every job in this package relies on. The session zone is pinned to
# UTC because the report truncates timestamps to days (ledger Q21).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "cardlake") -> SparkSession:
    """Build (or reuse) a session with the settings the warehouse needs.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session. Where it is unset, a session in
    local mode gets a private temporary folder, registered as its checkpoint
    folder; on a cluster that is an error, since executors would write to
    their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except (PySparkAttributeError, PySparkNotImplementedError):  # Spark Connect: no SparkContext on the client
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cardlake-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
    # unique per call so that re-runs never read a half-written folder
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
