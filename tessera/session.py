"""Session construction and the shared staging folder.

Library functions never create a session themselves; they take the caller's.
``build_session`` is a convenience for tests, benches and local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on: adaptive execution (runtime
# broadcast decisions from measured sizes, partition coalescing, skew-join
# splitting) and a pinned UTC clock so date logic matches the SQL oracle.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # PySpark otherwise records the Python call site on every Column operation
    # (JVM round trips per call, for error context): ~15% of plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read, never
    overridden; without it executors could not see each other's files, so that
    is an error. Only a session whose driver runs every task (``local``,
    ``local[n]``) may leave it out: a private folder is then created and
    registered.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tessera-staging/{label}-{uuid.uuid4().hex}"
