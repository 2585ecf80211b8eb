"""Keeping stored tables current: append, upsert, insert-ignore, update, reset.

The functions return the new table state; ``write_days`` replaces only the date partitions
that a change touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from emberline.functions.calendar import ntz


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.unionByName(new)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """New rows win over old ones with the same key; among new ones the greatest ``order``."""
    cols = old.columns
    position = F.struct(F.col("_new"), *[F.col(c) for c in (order or [c for c in cols if c not in keys])])
    both = old.withColumn("_new", F.lit(0)).unionByName(new.select(*cols).withColumn("_new", F.lit(1)))
    picked = both.groupBy(*keys).agg(F.max_by(F.struct(*cols), position).alias("r"))
    return picked.select("r.*")


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], last: bool) -> DataFrame:
    """One row for each key: the first or last by ``order``, then by all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    pick = F.max_by if last else F.min_by
    return df.groupBy(*keys).agg(pick(F.struct(*df.columns), F.struct(*order, *rest, *keys)).alias("r")).select("r.*")


def insert_ignore(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Adds rows whose key is not there yet and leaves the rest as they are.

    Of new rows with one key the first by ``order`` is added, as a primary key lets only one in.
    """
    first = one_per_key(new.select(*old.columns), keys, order, last=False)
    return old.unionByName(first.join(old.select(*keys), [*keys], "left_anti").select(*old.columns))


def keyed_update(
    old: DataFrame, changes: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str] = (),
) -> DataFrame:
    """Sets ``cols`` where a change has the row's key; ``changed`` marks those rows.

    Of several changes to one key the last by ``order`` holds, so no row is doubled.
    """
    changes = one_per_key(changes.select(*dict.fromkeys([*keys, *cols, *order])), keys, order, last=True)
    renamed = changes.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in cols], F.lit(True).alias("_hit"))
    out = old.join(renamed, [*keys], "left")
    hit = F.col("_hit").isNotNull()
    return out.withColumns({
        **{c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in cols}, "changed": hit,
    }).drop("_hit", *[f"_new_{c}" for c in cols])


def reset_slot(df: DataFrame, slot: Column, at: str | Column) -> DataFrame:
    """Empties the slot that starts now: amount 0, not complete, stamped."""
    stamp = ntz(at) if isinstance(at, str) else at
    return df.withColumns({
        "btu": F.when(slot, F.lit(0.0)).otherwise(F.col("btu")),
        "complete": F.when(slot, "no").otherwise(F.col("complete")),
        "updated": F.when(slot, stamp).otherwise(F.col("updated")),
    })


def roll_year(df: DataFrame, day: Column) -> DataFrame:
    """On the given day last year's amount becomes the previous one and the current one empties."""
    return df.withColumns({
        "previous_year": F.when(day, F.col("current_year")).otherwise(F.col("previous_year")),
        "current_year": F.when(day, None).otherwise(F.col("current_year")),
    })


def with_surrogate_key(df: DataFrame, name: str, group: Column, order: Sequence[str]) -> DataFrame:
    """Consecutive ids in a stable order without putting the table into one task.

    ``group`` cuts the order into ranges (such as days): rows are numbered inside each range and
    shifted by the rows of all earlier ranges. Rows without a range come first.
    """
    rows = df.withColumn("_g", group)
    sizes = rows.groupBy("_g").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select(F.col("_g").alias("_range"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_g").orderBy(*order)
    numbered = rows.withColumn("_i", F.row_number().over(w)).join(shift, F.col("_g").eqNullSafe(F.col("_range")))
    return numbered.withColumn(name, (F.col("_i") + F.col("_off")).cast("long")).drop("_i", "_off", "_g", "_range")


def create_days(spark: SparkSession, path: str, schema: StructType, day: str = "sum_date") -> None:
    """An empty date-partitioned table."""
    spark.createDataFrame([], schema).write.partitionBy(day).parquet(path)


def write_days(df: DataFrame, path: str, day: str = "sum_date") -> None:
    """Replaces the date partitions present in ``df`` and no others."""
    (df.repartition(day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(day).parquet(path))


TOUCHED_DAYS = 4000


def upsert_days(path: str, new: DataFrame, keys: Sequence[str], day: str = "sum_date") -> None:
    """Upserts into a date-partitioned parquet table, reading only the touched days.

    The change is written once to a folder beside the table; its days (more than ``TOUCHED_DAYS`` in one
    change are joined instead) become a filter on the partitions. The merged days go to the same folder and
    are then put in place, so nothing is read from where it is written. Running the same change again gives
    the same table. The folder is emptied at the end.
    """
    spark = new.sparkSession
    staged = f"{path.rstrip('/')}-staged"
    change, merged = f"{staged}/change", f"{staged}/merged"
    new.write.mode("overwrite").parquet(change)
    fresh = spark.read.schema(new.schema).parquet(change)
    days = [r[0] for r in fresh.select(day).distinct().limit(TOUCHED_DAYS + 1).collect()]
    old = spark.read.schema(new.schema).parquet(path)
    if len(days) <= TOUCHED_DAYS:
        old = old.where(F.col(day).isin([d for d in days if d is not None]) | (F.col(day).isNull() if None in days else F.lit(False)))
    else:
        old = old.join(fresh.select(day).distinct(), day, "left_semi").select(*new.columns)
    upsert(old, fresh, keys).write.mode("overwrite").parquet(merged)
    write_days(spark.read.schema(new.schema).parquet(merged), path, day)
    for folder in (change, merged):  # an empty table replaces what was staged
        spark.createDataFrame([], new.schema).write.mode("overwrite").parquet(folder)
