"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes(column: str = "text") -> Column:
    """The UTF-8 bytes of a text column; null reads as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one of ``spark.checkpoint.dir``.

    Where the setting is absent the session must have a checkpoint folder of its own (tests set one);
    a machine-local temporary folder is never chosen here.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        found = spark.sparkContext._jsc.sc().getCheckpointDir()
        if not found.isDefined():
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = found.get()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` again, cut so that the binary ``column`` of a slice holds about ``max_bytes``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        yield batch.slice(start)


def parts_for(size: int, each: int) -> int:
    """How many parts of ``each`` hold ``size``, one at least."""
    return max(1, -(-int(size) // each))


def once(shared, make):
    """What ``make`` makes of a broadcast value, made once in each Python worker."""
    if not hasattr(shared, "made"):
        shared.made = make(shared.value)
    return shared.made
