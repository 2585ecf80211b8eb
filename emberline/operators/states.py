"""What state was the equipment in at each reading?

Readings are ``(keys.., ts, tie, watts)``: ``tie`` orders readings of the same instant.
Logs are ``(keys.., ts, tie, status)`` and thresholds ``(change_time, hi, lo)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.calendar import instant_order, micros_between, ntz, period_start
from emberline.operators import chunks

RUNNING = {"hi": "boiler", "lo": "circulator"}
IDLE = "main power"
# Watts below which a furnace that is on only blows air, seconds after which its state is unknown,
# watts above which it dries; and, without a log, watts below which it is off and below which it only blows.
BLOWER_W, UNKNOWN_S, DRYING_W = 69, 600, 500
OFF_W, UNLOGGED_BLOWER_W = 40, 60
# Log entries (_kind 0) come before readings (_kind 1) of the same instant. Scans that follow on the
# same rows name the same order, so that Spark sorts once.
SCAN_ORDER = ("ts", "_kind", "tie")


# ---- predicates -------------------------------------------------------------------------


def in_range(df: DataFrame, ts: str, start: str, end: str, closed: bool = False) -> DataFrame:
    """``[start, end)``, or ``[start, end]`` where ``closed``. Plain comparisons reach the scan."""
    t = F.col(ts)
    return df.where((t >= ntz(start)) & ((t <= ntz(end)) if closed else (t < ntz(end))))


def threshold_state(main: Column, watts: Column, threshold: Column, running: str) -> Column:
    return (
        F.when((main == "ON") & (watts < threshold), IDLE)
        .when((main == "ON") & (watts >= threshold), running)
        .when(main == "OFF", "OFF")
    )


def fixed_state(watts: Column, limit) -> Column:
    """ON above the limit, else OFF; an unknown reading is OFF."""
    return F.when(watts > limit, "ON").otherwise("OFF")


def furnace_mode(status: Column, watts: Column, gap_s: Column) -> Column:
    """Refines ON. Each step rewrites rows still ON, so low power wins over a long gap."""
    on = status == "ON"
    return (
        F.when(on & (watts < BLOWER_W), "blower")
        .when(on & (gap_s > UNKNOWN_S), "unknown")
        .when(on & (watts > DRYING_W), "dehumidification")
        .otherwise(status)
    )


def furnace_mode_unlogged(watts: Column) -> Column:
    """The variant without a log: power alone decides, unknown power counts as on."""
    return (
        F.when(watts > DRYING_W, "dehumidification")
        .when(watts < OFF_W, "off")
        .when(watts < UNLOGGED_BLOWER_W, "blower")
        .otherwise("on")
    )


# ---- status as of a reading -------------------------------------------------------------


def is_on(status: Column) -> Column:
    """ON / OFF as a boolean: narrower in a shuffle, and max_by over it is a hash aggregate."""
    return F.when(status == "ON", True).when(status == "OFF", False)


def on_off(flag: Column) -> Column:
    return F.when(flag, "ON").when(~flag, "OFF")


def last_status(name: str = "status") -> Column:
    """Aggregate: the newest known status of (ts, tie, status) rows."""
    known = is_on(F.col("status"))
    at = F.when(known.isNotNull(), instant_order(F.col("ts"), F.col("tie")))
    return on_off(F.max_by(known, at)).alias(name)


def status_as_of(
    readings: DataFrame, log: DataFrame, keys: Sequence[str], start: str | None = None,
    seconds: int | None = None, thresholds: DataFrame | None = None,
) -> DataFrame:
    """Adds ``main_status``: the last log entry at or before each reading (log wins a tie).

    ``thresholds`` with a row per device and change travel the same way and add ``hi`` and ``lo``.

    Log entries older than ``start`` count too; they give the state at the start. The rows keep
    ``_kind`` and, where the scan is split, their chunk number for the scans that follow.
    Only the last of them per key matters, so the rest is dropped before the scan.
    """
    marks = log.select(*keys, "ts", "tie", is_on(F.col("status")).alias("_on"))
    if start is not None:
        old = marks.where((F.col("ts") < ntz(start)) & F.col("_on").isNotNull())
        at = instant_order(F.col("ts"), F.col("tie"))
        initial = old.groupBy(*keys).agg(
            F.max("ts").alias("ts"), F.max_by("tie", at).alias("tie"), F.max_by("_on", at).alias("_on"))
        marks = marks.where(F.col("ts") >= ntz(start)).unionByName(initial.where(F.col("ts").isNotNull()))
    filled = ["_on"]
    if thresholds is not None:
        changes = thresholds.select(
            *keys, F.col("change_time").alias("ts"), F.lit(0).cast("long").alias("tie"), "hi", "lo")
        marks, filled = marks.unionByName(changes, allowMissingColumns=True), ["_on", "hi", "lo"]
    marks = chunks.with_chunk(marks, "ts", seconds)
    readings = chunks.with_chunk(readings, "ts", seconds)
    rows = (
        readings.withColumn("_kind", F.lit(1))
        .unionByName(marks.withColumn("_kind", F.lit(0)), allowMissingColumns=True)
    )
    rows = chunks.fill_forward(rows, keys, SCAN_ORDER, filled, seconds)
    return rows.where(F.col("_kind") == 1).withColumn("main_status", on_off(F.col("_on"))).drop("_on")


def initial_value(log: DataFrame, keys: Sequence[str], start: str, col: str, ts: str = "ts") -> DataFrame:
    """Last value strictly before ``start`` per key, with its time."""
    tie = [c for c in ("tie",) if c in log.columns]
    return (
        log.where((F.col(ts) < ntz(start)) & F.col(col).isNotNull())
        .groupBy(*keys)
        .agg(
            F.max_by(col, F.struct(ts, *tie)).alias(col),
            F.max(ts).alias(ts),
        )
    )


def step_intervals(steps: DataFrame, ts: str, end: str) -> DataFrame:
    """One row per day that a step value covers, with the interval it holds for.

    A reading finds its value by day plus a range test, an ordinary hash join for which the
    engine itself picks broadcast or shuffle by size.
    """
    # Ordered over the whole step table: one row per threshold change, a settings history.
    nxt = F.lead(ts).over(Window.partitionBy(F.lit(1)).orderBy(ts))
    spans = steps.withColumn("_until", F.coalesce(nxt, ntz(end) + F.expr("INTERVAL 1 DAY")))
    return spans.withColumn(
        "_day",
        F.explode(F.sequence(F.to_date(ts), F.greatest(F.to_date(ts), F.to_date("_until")))),
    ).withColumnRenamed(ts, "_from")


def threshold_as_of(readings: DataFrame, thresholds: DataFrame, end: str) -> DataFrame:
    """Adds the threshold columns that hold at each reading; null before the first change."""
    spans = step_intervals(thresholds, "change_time", end)
    hit = (
        (F.to_date(readings["ts"]) == spans["_day"])
        & (readings["ts"] >= spans["_from"])
        & (readings["ts"] < spans["_until"])
    )
    return readings.join(spans, hit, "left").drop("_day", "_from", "_until")


def bucket_join(
    readings: DataFrame, log: DataFrame, keys: Sequence[str], bucket: str = "minute",
) -> DataFrame:
    """Gives every reading the last log entry of its own time bucket, null where there is none."""
    cut = period_start(bucket, F.col("ts"))
    last = log.groupBy(*keys, cut.alias("_bucket")).agg(last_status())
    return readings.withColumn("_bucket", cut).join(last, [*keys, "_bucket"], "left").drop("_bucket")


def fill_status(
    readings: DataFrame, log: DataFrame, keys: Sequence[str], start: str, end: str,
    seconds: int | None = None,
) -> DataFrame:
    """Readings of ``[start, end)`` with gap in seconds and filled status, unknown power kept."""
    return fill_rows(in_range(readings, "ts", start, end), in_before(log, end), keys, start, seconds)


def fill_rows(
    rows: DataFrame, log: DataFrame, keys: Sequence[str], start: str, seconds: int | None = None,
) -> DataFrame:
    """Gap and filled status of readings already cut to their range."""
    rows = status_as_of(rows, log, keys, start, seconds)
    rows = chunks.previous(rows, keys, SCAN_ORDER, {"ts": "_before"}, seconds)
    return rows.withColumn("gap_us", micros_between(F.col("_before"), F.col("ts"))).drop(
        "_before", "_kind", chunks.CHUNK).withColumnRenamed("main_status", "status")


def in_before(df: DataFrame, end: str, ts: str = "ts", closed: bool = False) -> DataFrame:
    return df.where(F.col(ts) <= ntz(end) if closed else F.col(ts) < ntz(end))


def active_days(days: DataFrame, log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Days worth summarising: last state up to the day is ON, or the log changes that day.

    ``days`` holds (keys, date). The log is first reduced to one row per (key, date).
    """
    daily = log.groupBy(*keys, F.to_date("ts").alias("date")).agg(
        last_status("last_status"), F.count("status").alias("changes"),
    )
    both = days.select(*keys, "date", F.lit(True).alias("_asked")).unionByName(daily, allowMissingColumns=True)
    both = both.groupBy(*keys, "date").agg(
        F.max("_asked").alias("_asked"), F.max("last_status").alias("last_status"),
        F.coalesce(F.sum("changes"), F.lit(0)).alias("changes"),
    )
    w = chunks.up_to_here(Window.partitionBy(*keys).orderBy("date"))
    carried = both.withColumn("last_status", F.last("last_status", ignorenulls=True).over(w))
    return carried.where(
        F.col("_asked") & ((F.col("last_status") == "ON") | (F.col("changes") > 0))
    ).drop("_asked")
