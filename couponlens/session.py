"""Session settings, and the one folder that all executors can reach."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings whose defaults do not already suit these jobs.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


_LOCAL: list[str] = []  # the one folder of a local master without a setting


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "couponlens") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder for stream checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. A local master may fall back to a folder of its own; a cluster
    without the setting is an error, since executors would not see a folder of the driver.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="couponlens-"))
        os.chmod(_LOCAL[0], 0o755)
    return _LOCAL[0]


def stage(df: DataFrame) -> DataFrame:
    """Writes an intermediate result to the shared folder and reads it back: its size is then known and nothing before
    it runs again, also when an executor is lost."""
    path = f"{shared_folder(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
