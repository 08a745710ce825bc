"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# SQL settings every plan in this package is written for.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the stage above then needs a shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state off the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Settings a session can only start with. Call sites of column expressions are not recorded:
# collecting them takes longer than building the plans.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "growthmill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def has_shared_folder(spark: SparkSession) -> bool:
    return bool(spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir())


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, or else the checkpoint folder set on the context."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return base.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for staged tables, under the shared folder."""
    return f"{shared_folder(spark)}/growthmill/{label}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that is no longer needed, wherever it is stored."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
