"""Session settings, shared scratch folder and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution splits hot join partitions and picks broadcast joins from measured sizes. The last setting splits a hot partition also where a later step
# would have reused the join's partitioning, at the price of one more shuffle in that case only.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Switch on adaptive skew handling in a session made elsewhere; sizes and partition counts stay."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "rollcall") -> SparkSession:
    """A session for tests and the bench; clusters pass their own session to every function."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("ROLLCALL_DRIVER_MEMORY", "8g"))
    )
    for name, value in ADAPTIVE.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="rollcall-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nobody else writes to."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage there (runs a job)."""
    spark = df.sparkSession
    shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)
