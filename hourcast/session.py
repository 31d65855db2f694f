"""Session helpers: local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "hourcast") -> SparkSession:
    """Session used by tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.ansi.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return ``spark.checkpoint.dir``; only when it is unset (tests, local runs)
    point it at a fresh scratch folder.  On a cluster the shared folder named in
    the session configuration is used as is."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="hourcast-ckpt-", dir=os.environ.get("HOURCAST_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared checkpoint folder and read back: survives executor loss, is computed once (a
    ``checkpoint`` runs its last stage twice), and later reads take only their columns and rows."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/hourcast/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
