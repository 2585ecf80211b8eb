"""Hourly sums of a live feed: closed hours, the open hour, upsert into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from emberline.functions.calendar import micros_between, ntz
from emberline.operators import snapshots
from emberline.session import scratch_path
from emberline.sources.files import SCHEMAS

DELAY = "1 hour"


def feed(spark: SparkSession, folder: str, name: str, files_per_batch: int = 100) -> DataFrame:
    """A parquet table below ``folder``, one file or a folder of part files, as a stream."""
    schema = SCHEMAS.get(name.removesuffix(".parquet")) or spark.read.parquet(f"{folder}/{name}").schema
    # a glob on the path takes a single file as well as a folder of part files
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(f"{folder}/{name.removesuffix('.parquet')}*.parquet"))


def hourly(stream: DataFrame, ts: str, amount: Column, delay: str = DELAY) -> DataFrame:
    """Tumbling hours with late rows up to ``delay``; a watermark needs a zoned timestamp."""
    t = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", delay)
    return t.groupBy(F.window("_t", "1 hour").alias("w")).agg(
        F.sum(amount).alias("runtime"), F.count("*").alias("n"))


def named_hours(windows: DataFrame) -> DataFrame:
    start = F.col("w.start").cast("timestamp_ntz")
    return windows.select(
        F.to_date(start).alias("sum_date"), F.hour(start).alias("hour"), "runtime", "n")


def run_to_end(writer, spark: SparkSession, name: str, checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Processes what is there and stops, unless another trigger is given; returns the query that ran.

    A caller that names the checkpoint goes on where the last run of it stopped.
    """
    query = (writer.option("checkpointLocation", checkpoint or scratch_path(spark, f"{name}-state"))
             .trigger(**(trigger or {"availableNow": True})).start())
    query.awaitTermination()
    return query


def watermark_of(query: StreamingQuery) -> Column:
    """The watermark of a query's last micro-batch, as its progress tells it; null if it had none."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress if "watermark" in p["eventTime"]]
    mark = marks[-1].removesuffix("Z") if marks and not marks[-1].startswith("1970-01-01") else None
    return F.lit(None).cast("timestamp_ntz") if mark is None else ntz(mark.replace("T", " "))


def closed_hours(windows: DataFrame) -> DataFrame:
    """Append mode: an hour is written once, when the watermark has passed its end."""
    spark = windows.sparkSession
    out = scratch_path(spark, "hours")
    run_to_end(named_hours(windows).writeStream.outputMode("append").format("parquet").option("path", out),
               spark, "hours")
    return spark.read.parquet(out)


def upsert_stream(windows: DataFrame, out: str, checkpoint: str | None = None) -> StreamingQuery:
    """Update mode: each batch's changed hours replace their rows in a snapshot table, the open hour included.

    A batch that runs again after a failure puts the same rows in place; readers see whole batches only.
    """
    snapshots.create(windows.sparkSession, out, named_hours(windows).schema)

    def merge(batch: DataFrame, number: int) -> None:
        snapshots.upsert_days(out, named_hours(batch), ["sum_date", "hour"])
        snapshots.forget(batch.sparkSession, out)

    return run_to_end(windows.writeStream.outputMode("update").foreachBatch(merge), windows.sparkSession, "live-hours", checkpoint)


def upserted_hours(windows: DataFrame) -> DataFrame:
    """All hours of the feed, summed as far as it goes."""
    upsert_stream(windows, out := scratch_path(windows.sparkSession, "live-hours"))
    return snapshots.read(windows.sparkSession, out)


def live_hours(windows: DataFrame) -> DataFrame:
    """All hours with a flag for those closed: those that append mode would have written by the query's own watermark."""
    query = upsert_stream(windows, out := scratch_path(windows.sparkSession, "live-hours"))
    end = F.timestamp_add("HOUR", F.col("hour") + 1, F.col("sum_date").cast("timestamp_ntz"))
    return snapshots.read(windows.sparkSession, out).withColumn("closed", F.coalesce(end <= watermark_of(query), F.lit(False)))


def hour_close_gaps(readings: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Hours that a roll-over trigger never closes, for each device.

    The trigger closes an hour only when a reading falls into the next hour of day (23 before
    0), counted without the date. A longer silence leaves the last hour before it unsummed, or
    sums a wrong one. Works on one row per hour with readings.
    """
    hours = readings.groupBy(*keys, F.to_date("ts").alias("sum_date"), F.hour("ts").alias("hour")).agg(
        F.count("*").alias("n"))
    at = F.timestamp_add("HOUR", F.col("hour"), F.col("sum_date").cast("timestamp_ntz"))
    hours = hours.withColumn("at", at)
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("at")
    hours = hours.withColumn("next_at", F.lead("at").over(w))
    skipped = (F.floor(micros_between(F.col("at"), F.col("next_at")) / 3_600_000_000) - 1).cast("int")
    rolls = F.hour("next_at") == (F.col("hour") + 1) % 24
    return hours.where((skipped > 0) | ~rolls).select(
        *keys, "sum_date", "hour", "n", "next_at", skipped.alias("hours_skipped"), rolls.alias("trigger_fires"))
