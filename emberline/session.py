"""Session helpers: a local test session and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cpus: int = 8, partitions: int | None = None) -> SparkSession:
    """A session for tests and the bench, with a scratch folder of its own; on a cluster the caller brings both."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("emberline")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", os.environ.get("EMBERLINE_SCRATCH") or tempfile.mkdtemp(prefix="emberline-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one that the driver and all executors share, named in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this library wrote, through the file system that holds it; absent is fine."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
