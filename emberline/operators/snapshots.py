"""Date-partitioned tables that change by snapshots.

A change writes whole days to new files and then puts one small file in place that names, for each day, the folder that
holds it. Readers follow the newest such file, so they see the table before a change or after it, never
between, and a change that stops half way leaves the table as it was. Of two changes at a time the second to
finish finds its number taken and is merged again on top of the first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberline.operators.tables import upsert
from emberline.session import remove_path

NO_DAY = "__HIVE_DEFAULT_PARTITION__"  # fixed value: how a null partition is written


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = jvm.Path(path)
    return jvm, at, at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The snapshots of a table, oldest first."""
    _, at, fs = _hadoop(spark, f"{path}/_snapshots")
    if not fs.exists(at):
        return []
    return sorted(int(f.getPath().getName()) for f in fs.listStatus(at) if f.getPath().getName().isdigit())


def snapshot(spark: SparkSession, path: str, number: int) -> dict:
    """``schema``, the name of the ``day`` column and the folder of each day (``days``)."""
    _, at, fs = _hadoop(spark, f"{path}/_snapshots/{number:020d}")
    stream = fs.open(at)
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, number: int, content: dict) -> bool:
    """Puts a snapshot in place as a whole; False where another change has taken the number."""
    jvm, made, fs = _hadoop(spark, f"{path}/_snapshots/.{uuid.uuid4().hex}")
    out = fs.create(made, False)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    files = jvm.FileContext.getFileContext(made.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm, "Options$Rename"), 0)  # never over an existing file
    try:
        files.rename(made, jvm.Path(f"{path}/_snapshots/{number:020d}"), plain)
        return True
    except Py4JJavaError as e:
        fs.delete(made, False)
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise


def create(spark: SparkSession, path: str, schema: StructType, day: str = "sum_date") -> None:
    """An empty table; nothing happens where there is one."""
    if not numbers(spark, path):
        commit(spark, path, 0, {"schema": schema.json(), "day": day, "days": {}})


def _days(spark: SparkSession, path: str, held: dict, days: Sequence[str]) -> DataFrame:
    schema = StructType.fromJson(json.loads(held["schema"]))
    if not days:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/data/change={held['days'][d]}/{held['day']}={d}" for d in days]
    return spark.read.schema(schema).option("basePath", f"{path}/data").parquet(*folders).select(*schema.names)


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as the newest snapshot, or an earlier one, has it."""
    held = snapshot(spark, path, numbers(spark, path)[-1] if number is None else number)
    return _days(spark, path, held, sorted(held["days"]))


def change_days(path: str, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame], batch: int | None = None) -> int:
    """Puts ``merge(old, new)`` in place of the days that ``new`` touches; returns the number of the snapshot that has them.

    Only those days are read and written, each once, a large day by several tasks. The list of days, one for each date of the table,
    passes through the driver. A table of years is better kept by month: any date column may be the ``day`` of ``create``. ``new`` is evaluated once and kept on disk by Spark until the change is in place. A ``batch``
    number is kept in the snapshot: a batch that the table has already, or an earlier one, changes nothing.
    """
    spark = new.sparkSession
    new = new.persist()
    try:
        while True:
            last = numbers(spark, path)[-1]
            held = snapshot(spark, path, last)
            if batch is not None and batch <= held.get("batch", -1):
                return last
            day = held["day"]
            touched = [NO_DAY if r[0] is None else str(r[0]) for r in new.select(day).distinct().collect()]
            folder, kept = uuid.uuid4().hex, {} if batch is None else {"batch": batch}
            if touched:
                old = _days(spark, path, held, [d for d in touched if d in held["days"]])
                merged = merge(old, new.select(*old.columns))
                merged.hint("rebalance", F.col(day)).write.partitionBy(day).parquet(f"{path}/data/change={folder}")
            elif not kept:
                return last
            if commit(spark, path, last + 1, {**held, **kept, "days": {**held["days"], **dict.fromkeys(touched, folder)}}):
                return last + 1
            remove_path(spark, f"{path}/data/change={folder}")
    finally:
        new.unpersist()


def upsert_days(path: str, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> int:
    """New rows win over old ones of the same key; doing it again changes nothing."""
    return change_days(path, new, lambda old, fresh: upsert(old, fresh, keys, order))


def add_days(path: str, new: DataFrame, keys: Sequence[str], batch: int) -> int:
    """Adds the other columns of ``new``, sums and counts, to those of the rows with the same key, once for each batch number."""

    def merge(old: DataFrame, fresh: DataFrame) -> DataFrame:
        totals = [F.sum(c).cast(old.schema[c].dataType).alias(c) for c in old.columns if c not in keys]
        return old.unionByName(fresh).groupBy(*keys).agg(*totals).select(*old.columns)

    return change_days(path, new, merge, batch)


def forget(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes snapshots but the newest ``keep``, and the days that only they name. Not while older ones are being read."""
    found = numbers(spark, path)
    old, kept = found[:-keep], found[-keep:]
    named = lambda n: {(f, d) for d, f in snapshot(spark, path, n)["days"].items()}
    live = set().union(*map(named, kept))
    for number in old:
        day = snapshot(spark, path, number)["day"]
        for folder, d in named(number) - live:
            remove_path(spark, f"{path}/data/change={folder}/{day}={d}")
        remove_path(spark, f"{path}/_snapshots/{number:020d}")
