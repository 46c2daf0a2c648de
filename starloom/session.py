"""Session helpers: a local session for tests and the shared scratch folder.

Scratch tables (checkpoints, round-trip files, published test tables) live under the folder the
cluster names in ``spark.checkpoint.dir``, or else in its warehouse. Only a local session without that
setting gets a private folder under the system temp directory.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: str | None = None


def local_session(app: str = "starloom", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench: local master, UTC, AQE on, small shuffle count."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One process; ``local-cluster`` has executors of its own, with temp folders of their own."""
    return spark.sparkContext.master.partition("[")[0] == "local"


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder; sets the checkpoint directory when it is unset.

    The folder is the one that ``spark.checkpoint.dir`` names, with or without a scheme: whether a plain
    path is a shared mount cannot be told from here. Without that setting it is the checkpoint directory of
    the context, else on a cluster the warehouse, which executors share too: a machine-local temporary folder
    would not be visible to other executors and would not survive them.
    """
    global _LOCAL_ROOT
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _is_local(spark):
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/starloom-checkpoints")
        return sc.getCheckpointDir()
    if _LOCAL_ROOT is None:
        _LOCAL_ROOT = tempfile.mkdtemp(prefix="starloom-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(_LOCAL_ROOT, "checkpoints"))
    return _LOCAL_ROOT


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared root (not created; writers create it)."""
    return f"{shared_root(spark)}/starloom-work/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (a fresh folder on the shared storage) and read it back:
    a materialisation that survives lost executors, keeps true sizes for the planner and, unlike a
    checkpoint, is read column by column."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
