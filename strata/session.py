"""SparkSession construction and shared-storage settings.

Settings chosen for the metric layer:

* session time zone UTC, so ``DATE(ts)`` and month truncation agree with the
  warehouse convention that all timestamps are UTC;
* AQE on (partition coalescing, runtime broadcast conversion, skew-join
  splitting) so the shuffle layout is re-planned from real sizes;
* broadcasts are left to Spark's size check (``autoBroadcastJoinThreshold``
  against plan statistics, and AQE against runtime shuffle sizes) instead of
  unconditional ``broadcast()`` hints, so a dimension that outgrows the
  threshold silently falls back to a sort-merge join;
* the checkpoint / materialisation folder is read from
  ``spark.checkpoint.dir``; only when it is unset (tests, local runs) a
  private scratch folder is created.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Check what the jobs rely on in an existing session; its settings stay as they are."""
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised tables.

    On a cluster ``spark.checkpoint.dir`` names a shared filesystem path and is
    used as is; without it only a local session gets a scratch folder.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def warehouse_path(spark: SparkSession, *parts: str) -> str:
    return os.path.join(checkpoint_dir(spark), *parts)
