"""Session helpers: building a local session for tests and benches, and
finding the shared folder for checkpoints and stage tables.

On a cluster the caller owns the session; ``spark.checkpoint.dir`` names a
shared folder (HDFS, object store). Operators that cut lineage or write stage
tables read that setting; without it they say so.
"""

from __future__ import annotations

import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """The active session as it is, or else a new one with AQE on and the UI off.

    A setting that the configuration already has is left alone, so a
    cluster's own defaults win.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    given = SparkConf()
    builder = SparkSession.builder
    conf = {
        "spark.app.name": app,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if master:
        conf["spark.master"] = master
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        if not given.contains(k):
            builder = builder.config(k, v)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    The SparkContext's current folder, or else ``spark.checkpoint.dir``; the
    library has no folder of its own to fall back on. Sessions without a local
    SparkContext (Spark Connect) use the setting as the server sees it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no local SparkContext
        sc = None
    if sc is not None:
        if current := sc.getCheckpointDir():
            return current
        configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    if sc is not None:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    Used for stage tables written by round-trip queries; the folder is shared
    by the cluster, so every executor can read what another one wrote.
    """
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-stage/{name}-{uuid.uuid4().hex}"

