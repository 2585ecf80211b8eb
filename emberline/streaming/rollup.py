"""A stored hourly rollup that a feed keeps current and that reports read instead of the readings.

Each micro-batch adds its own sums and counts to the hours it touches, late or not, and is added once: the table
remembers the number of the last batch with the days it changed, in one snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.operators import snapshots
from emberline.streaming.hourly import run_to_end

TOTAL = "decimal(38,2)"
MONTH = "sum_month"  # the folders of the table


def hour_totals(rows: DataFrame, ts: str, amount: Column, keys: Sequence[str] = ()) -> DataFrame:
    """(keys.., sum_month, sum_date, hour, runtime, n): what rows add to their hours. Rows without a time add nothing."""
    timed = rows.where(F.col(ts).isNotNull())
    return timed.groupBy(*keys, F.trunc(F.to_date(ts), "month").alias(MONTH), F.to_date(ts).alias("sum_date"), F.hour(ts).alias("hour")).agg(
        F.sum(amount).cast(TOTAL).alias("runtime"), F.count("*").alias("n"))


def add_batch(path: str, rows: DataFrame, number: int, ts: str, amount: Column, keys: Sequence[str] = ()) -> None:
    """Adds a batch of readings to the rollup below ``path``; a batch that came before changes nothing."""
    totals = hour_totals(rows, ts, amount, keys)
    snapshots.create(rows.sparkSession, path, totals.schema, MONTH)
    snapshots.add_days(path, totals, [*keys, MONTH, "sum_date", "hour"], number)


def stored_hours(spark: SparkSession, path: str) -> DataFrame:
    """The rollup as reports read it. A range of dates also reads only its months, if the caller filters on them."""
    return snapshots.read(spark, path).drop(MONTH)


def maintain(
    feed: DataFrame, path: str, ts: str, amount: Column, keys: Sequence[str] = (), checkpoint: str | None = None, trigger: dict | None = None,
) -> DataFrame:
    """Keeps the rollup current from a stream and returns it as it then is. The feed and its checkpoint belong to one rollup."""

    def add(batch: DataFrame, number: int) -> None:
        add_batch(path, batch, number, ts, amount, keys)
        snapshots.forget(batch.sparkSession, path)

    run_to_end(feed.writeStream.foreachBatch(add), feed.sparkSession, "rollup", checkpoint, trigger)
    return stored_hours(feed.sparkSession, path)
