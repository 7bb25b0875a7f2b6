"""Spark session defaults and the shared checkpoint folder.

On a cluster every setting below normally comes from ``spark-submit``; we only
fill in what is unset, so a cluster's own values always win.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings applied only when the session does not already define them.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, cores: int | None = None,
                  app_name: str = "tillroll", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. ``master`` is only used for local runs.

    ``_DEFAULTS`` are applied only to keys the session's own configuration
    (spark-submit, spark-defaults) does not set; ``extra`` always applies.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and cores is not None:
        master = f"local[{cores}]"
    if master is not None:
        builder = builder.master(master)
        if master.startswith("local"):
            n = cores or os.cpu_count() or 8
            builder = (builder
                       .config("spark.ui.enabled", "false")
                       .config("spark.ui.showConsoleProgress", "false")
                       .config("spark.driver.memory", "16g")
                       .config("spark.sql.shuffle.partitions", str(max(8, 2 * n)))
                       .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m"))
    spark = builder.getOrCreate()
    configured = spark.sparkContext.getConf()
    settings = {k: v for k, v in _DEFAULTS.items() if not configured.contains(k)}
    settings.update(extra or {})
    for key, value in settings.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # a static setting of an already running context
            pass
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster, if any."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; create a scratch one only for local runs.

    A cluster must name a shared folder in ``spark.checkpoint.dir``: a
    machine-local temporary folder would vanish with the executor.
    """
    path = checkpoint_dir(spark)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder on the cluster")
        path = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path
