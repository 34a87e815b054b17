"""Session construction and cluster-wide settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of the library wants; the cluster may override
# them through spark-defaults, so they are only set when absent.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # partial aggregation must never be skipped: hot keys rely on it
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tempora",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Return (or create) the session with the library defaults.

    ``master`` is only for local runs and tests; on a cluster leave it to
    spark-submit.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder of the cluster.

    Read from ``spark.checkpoint.dir``; only when the setting is absent
    (local tests) a scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set on this cluster")
        configured = tempfile.mkdtemp(prefix="tempora-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable, not local)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
