"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_local_checkpoint: dict[str, str] = {}


def build_session(app_name: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library's settings; keyword arguments override them
    (write ``spark_sql_shuffle_partitions`` for ``spark.sql.shuffle.partitions``)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("_", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    run without that setting; it then gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or sc.getCheckpointDir()
        or _local_checkpoint.get(sc.applicationId)
    )
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="millrace-")
        _local_checkpoint[sc.applicationId] = root
        sc.setCheckpointDir(root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{checkpoint_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def scratch_name(label: str) -> str:
    """A catalog name that no other run uses."""
    return f"{label}_{uuid.uuid4().hex}"
