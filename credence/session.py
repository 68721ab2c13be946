"""Session helpers: a local session for tests and the bench, and the shared
work folder every written intermediate goes to."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK = "/tmp/credence-checkpoints"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "credence") -> SparkSession:
    """Session for tests and the bench. On a cluster the job's own session is
    used instead; nothing here is required by the library."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; only when it is unset (local tests) is a local
    fallback set, so that ``DataFrame.checkpoint()`` and written
    intermediates have a home."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        # the setting itself is fixed once the session runs, so the context keeps it
        spark.sparkContext.setCheckpointDir(os.environ.get("CREDENCE_CHECKPOINT_DIR", _LOCAL_FALLBACK))
        root = spark.sparkContext.getCheckpointDir()
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    root = checkpoint_root(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for one written intermediate, under the shared root."""
    return f"{checkpoint_root(spark)}/credence-work/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cuts a DataFrame's lineage with a reliable checkpoint in the shared
    ``spark.checkpoint.dir`` (never ``localCheckpoint``: executors may be
    lost, and a local copy would go with them)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
