"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a split skewed partition is worth an extra exchange above the join
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

# A side is broadcast by hand only after it was counted to hold no more rows than this.
BROADCAST_ROWS = 200_000


def build_session(app: str = "tenderloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where driver and
    executors share one disk, may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = os.environ.get("TENDERLOOM_SCRATCH") or tempfile.mkdtemp(prefix="tenderloom-")
    os.environ["TENDERLOOM_SCRATCH"] = root
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "cut") -> DataFrame:
    """Written to the shared folder and read back: worked off once, survives executor loss, and the file
    sizes let later joins choose their side to broadcast."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when a bounded count proves the side small; else leave the join to AQE."""
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df
