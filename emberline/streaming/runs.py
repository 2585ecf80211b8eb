"""Run detection and hourly summaries on a live feed.

Rows wait in a table until the watermark (the latest time seen less ``delay``) has passed them. What is
passed on is therefore complete and in order whichever way the feed was cut into files, and every log entry
is there before the readings it applies to. Rows that come after the watermark has passed them are kept in a
table of their own, never dropped. Each micro-batch runs the batch operators, so a busy device is split
into time chunks as there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.functions.calendar import ntz
from emberline.operators.runs import AUTO, classify_runs, summary
from emberline.session import remove_path, scratch_path
from emberline.streaming.hourly import run_to_end

FEED = "key long, ts timestamp_ntz, tie long, watts decimal(10,2), status string"
STATE_TABLE = ("key long, status string, status_ts timestamp_ntz, status_tie long, "
               "last_ts timestamp_ntz, last_tie long, last_watts decimal(10,2), last_main string, starts long")
CLOCK = "mark timestamp_ntz, late long"


def buffered(
    feed: DataFrame, sink: str, delay: str, state_schema: str, emit: Callable[[DataFrame, DataFrame, str], DataFrame],
    step: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, flush: bool = True,
) -> None:
    """Feeds a stream of ``FEED`` rows through ``emit(ready, state, folder) -> next state`` in order of time.

    ``sink`` holds, by number of the micro-batch, the rows that wait (``waiting``), the state (``state``) and
    the watermark (``clock``), and what came too late (``late``). A batch that is run again after a failure
    replaces what it wrote; only the last two of each table are kept. ``step`` rounds the watermark down
    (to the hour). ``flush`` treats what waits at the end as complete: its rows are written under the number
    of the next batch, which replaces them when the stream goes on.
    """
    spark = feed.sparkSession

    def read(name: str, schema: str, number: int) -> DataFrame:
        if number < 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{sink}/{name}/after={number}")

    def write(df: DataFrame, name: str, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{sink}/{name}/after={number}")

    def finished(mark) -> Column:
        """What the watermark has passed. With ``step`` that is what its last whole step holds: a row of an open hour is not late."""
        if step:
            return F.col("ts") < F.date_trunc(step, ntz(str(mark))).cast("timestamp_ntz")
        return F.col("ts") <= ntz(str(mark))

    def advance(batch: DataFrame, number: int, last: bool = False) -> None:
        clock = read("clock", CLOCK, number - 1).first()
        mark, late = (clock["mark"], clock["late"]) if clock else (None, 0)
        batch = batch.select("key", "ts", "tie", "watts", "status").persist()
        passed = F.lit(False) if mark is None else F.coalesce(finished(mark), F.lit(True))
        counts = batch.agg(F.count_if(passed).alias("late"), (F.max("ts") - F.expr(f"INTERVAL {delay}")).alias("mark")).first()
        if counts["late"]:
            batch.where(passed).write.mode("overwrite").parquet(f"{sink}/late/batch={number}")
        mark = max((m for m in (mark, counts["mark"]) if m is not None), default=None)
        waiting = read("waiting", FEED, number - 1).unionByName(batch.where(~passed))
        done = F.lit(True) if last else F.lit(False)
        if mark is not None and not last:
            done = finished(mark)
        ready = waiting.where(done).persist()
        state = emit(ready, read("state", state_schema, number - 1), f"{sink}/rows/batch={number}")
        if not last:
            write(state, "state", number)
            write(waiting.where(~F.coalesce(done, F.lit(False))), "waiting", number)
            write(spark.createDataFrame([(mark, late + counts["late"])], CLOCK), "clock", number)
            for name in ("state", "waiting", "clock"):
                remove_path(spark, f"{sink}/{name}/after={number - 2}")
        ready.unpersist()
        batch.unpersist()

    numbers = [-1]

    def one(batch: DataFrame, number: int) -> None:
        advance(batch, number)
        numbers.append(number)

    run_to_end(feed.writeStream.foreachBatch(one), spark, "feed", checkpoint or f"{sink}/checkpoint", trigger)
    if flush and max(numbers) >= 0:
        advance(spark.createDataFrame([], FEED), max(numbers) + 1, last=True)


def late_rows(spark: SparkSession, sink: str, number: int) -> int:
    """How many rows had come too late after micro-batch ``number``."""
    return spark.read.schema(CLOCK).parquet(f"{sink}/clock/after={number}").first()["late"]


def stream_runs_by_batch(
    feed: DataFrame, thresholds: DataFrame, which: str, start: str, end: str, seconds: int | None = AUTO,
    delay: str = "1 hour", sink: str | None = None, checkpoint: str | None = None, trigger: dict | None = None,
) -> DataFrame:
    """Runs over a stream of ``(key, ts, tie, watts, status)``; ``status`` is null on plain readings.

    The same rows as :func:`classify_runs` over everything that was not late. The caller may name the sink
    folder, the checkpoint and the trigger, and goes on from them with the next call.
    """
    spark = feed.sparkSession
    sink = sink or scratch_path(spark, "run-rows")

    def emit(ready: DataFrame, state: DataFrame, folder: str) -> DataFrame:
        rows = run_batch(ready, state, thresholds, which, start, end, seconds).persist()
        rows.write.mode("overwrite").parquet(folder)
        return next_state(ready, rows, state)

    buffered(feed, sink, delay, STATE_TABLE, emit, checkpoint=checkpoint, trigger=trigger)
    return spark.read.parquet(f"{sink}/rows").drop("batch")


def stream_runs(
    readings: DataFrame, log: DataFrame, thresholds: DataFrame, which: str, end: str,
    start: str = "1900-01-01 00:00:00", **how,
) -> DataFrame:
    """Runs over a stream of readings and one of log entries; gaps and ids never restart."""
    r = readings.select("key", "ts", "tie", F.col("watts").cast("decimal(10,2)").alias("watts"), F.lit(None).cast("string").alias("status"))
    m = log.select("key", "ts", "tie", F.lit(None).cast("decimal(10,2)").alias("watts"), "status")
    return stream_runs_by_batch(r.unionByName(m), thresholds, which, start, end, **how)


STATUS_TABLE = "key long, ts timestamp_ntz, tie long, status string"


def stream_hour_summaries(
    feed: DataFrame, thresholds: DataFrame, which: str, start: str, end: str, seconds: int | None = AUTO,
    delay: str = "1 hour", sink: str | None = None, checkpoint: str | None = None, trigger: dict | None = None, flush: bool = True,
) -> DataFrame:
    """Run totals (cycles, run time, heat, fuel, energy) of each device and hour, once the hour is closed.

    An hour is closed when the watermark has reached its end; runs and gaps begin anew in each hour, as in
    ``runs.summary(..., period="hour")``. Only the last status of each device goes from hour to hour.
    """
    spark = feed.sparkSession
    sink = sink or scratch_path(spark, "hour-summaries")

    def emit(ready: DataFrame, state: DataFrame, folder: str) -> DataFrame:
        marks = ready.where(F.col("status").isNotNull()).select("key", "ts", "tie", "status").unionByName(state)
        readings = ready.where(F.col("watts").isNotNull()).select("key", "ts", "tie", "watts")
        summary(readings, marks, thresholds, ["key"], which, start, end, "hour", seconds=seconds).write.mode("overwrite").parquet(folder)
        return marks.groupBy("key").agg(F.max(F.struct("ts", "tie", "status")).alias("m")).select("key", "m.*")

    buffered(feed, sink, delay, STATUS_TABLE, emit, "HOUR", checkpoint, trigger, flush)
    return spark.read.parquet(f"{sink}/rows").drop("batch")


def run_batch(batch, state, thresholds, which, start, end, seconds=AUTO) -> DataFrame:
    """Runs of rows that are all later than those ``state`` stands for.

    The last reading of each device and its last status go in ahead of the new rows, so gaps and
    starts come out as in one series; the number of earlier starts is added to the ids.
    """
    seen = state.select("key", "last_ts", F.col("starts").alias("_starts"))
    fresh = batch.where(F.col("watts").isNotNull()).select("key", "ts", "tie", "watts", F.lit(False).alias("_seed"))
    seeds = state.where(F.col("last_ts").isNotNull()).select(
        "key", F.col("last_ts").alias("ts"), F.col("last_tie").alias("tie"),
        F.col("last_watts").alias("watts"), F.lit(True).alias("_seed"))
    marks = batch.where(F.col("status").isNotNull()).select("key", "ts", "tie", "status")
    marks = marks.unionByName(state.where(F.col("status").isNotNull()).select(
        "key", F.col("status_ts").alias("ts"), F.col("status_tie").alias("tie"), "status"))
    # the status at the last reading may be older than the newest one
    marks = marks.unionByName(state.where(F.col("last_main").isNotNull()).select(
        "key", F.col("last_ts").alias("ts"), F.col("last_tie").alias("tie"), F.col("last_main").alias("status")))
    c = classify_runs(fresh.unionByName(seeds), marks, thresholds, ["key"], which, start, end, seconds=seconds)
    c = c.where(~F.col("_seed")).join(seen.select("key", "_starts"), "key", "left")
    return c.select(
        "key", "ts", "tie", "watts", "gap_us", "main_status", "system_status",
        (F.col("run_id") + F.coalesce("_starts", F.lit(0))).cast("long").alias("run_id"))


def next_state(batch, rows, state) -> DataFrame:
    """Per device the newest status, the newest reading and the number of runs started so far."""
    marks = batch.where(F.col("status").isNotNull()).select(
        "key", F.struct("ts", "tie", "status").alias("mark"))
    reads = rows.select(
        "key", F.struct("ts", "tie", "watts", F.col("main_status").alias("main")).alias("read"),
        F.col("run_id").alias("starts"))
    old = state.select(
        "key",
        F.when(F.col("status").isNotNull(), F.struct(
            F.col("status_ts").alias("ts"), F.col("status_tie").alias("tie"), "status")).alias("mark"),
        F.when(F.col("last_ts").isNotNull(), F.struct(
            F.col("last_ts").alias("ts"), F.col("last_tie").alias("tie"), F.col("last_watts").alias("watts"),
            F.col("last_main").alias("main"))).alias("read"),
        "starts")
    every = old.unionByName(marks, allowMissingColumns=True).unionByName(reads, allowMissingColumns=True)
    new = every.groupBy("key").agg(
        F.max("mark").alias("m"), F.max("read").alias("r"), F.coalesce(F.max("starts"), F.lit(0)).alias("starts"))
    return new.select(
        "key", "m.status", F.col("m.ts").alias("status_ts"), F.col("m.tie").alias("status_tie"),
        F.col("r.ts").alias("last_ts"), F.col("r.tie").alias("last_tie"), F.col("r.watts").alias("last_watts"),
        F.col("r.main").alias("last_main"), "starts")
