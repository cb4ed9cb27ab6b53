"""Session construction and the shared scratch location.

Scratch data (round-trip checks, lineage cuts) lives under the cluster's
``spark.checkpoint.dir``.  We only invent a directory when that setting is
unset *and* the master is local (tests, the local bench); on a cluster an
unset checkpoint dir is an error, never a silent fall-back to a
machine-local folder.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# SQL settings that can be applied to a running session (see ``apply_sql_conf``).
#
# Only what results depend on (the time zone) or plans rely on (AQE); broadcast
# thresholds are the caller's.  Beyond them a join stays a sort-merge join,
# whose skewed partitions AQE splits.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

DEFAULT_CONF = dict(SQL_CONF, **{
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # A session that serves many different queries keeps their compiled
    # stages: the default 100-entry cache recompiles on every query.
    "spark.sql.codegen.cache.maxEntries": "2000",
})


def apply_sql_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for k, v in SQL_CONF.items():
        spark.conf.set(k, v)
    return spark


def build_session(master: str | None = None, app: str = "lodgelens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
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
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not re.match(r"local(\[|$)", sc.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/object store) before running lodgelens jobs on a cluster")
    local = tempfile.mkdtemp(prefix="lodgelens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the checkpoint folder for one run of one job."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/lodgelens-scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
