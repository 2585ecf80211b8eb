"""Runs (cycles): contiguous stretches of one running state, and their sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions import energy
from emberline.functions.calendar import micros_between, period_start
from emberline.operators import chunks
from emberline.operators.states import (
    RUNNING, SCAN_ORDER, in_before, in_range, status_as_of, threshold_as_of, threshold_state,
)

AUTO = -1
PERIOD = "period_start"


def mark_runs(
    rows: DataFrame, keys: Sequence[str], state: str, running: str,
    restart: Sequence[str] = (), seconds: int | None = None, order: Sequence[str] = ("ts", "tie"),
) -> DataFrame:
    """Adds ``gap_us`` and ``run_id`` to ordered rows.

    A run starts where the state turns to ``running`` from another known state. A run already
    open at the first row has id 0, and so has one that follows an unknown state before any
    start. Rows in another known state have no id, nor have rows without a device, which have no gap
    either. ``restart`` columns (a period) begin anew.
    """
    devices, keys = keys, [*keys, *restart]
    here, runs_on = F.col(state), F.col(state) == running
    if seconds is None:
        w = chunks.ordered(keys, order)
        rows = rows.withColumns({"_pts": F.lag("ts").over(w), "_ps": F.lag(state).over(w)})
        starts = F.when(runs_on & (F.col("_ps") != running), 1).otherwise(0)
        rows = rows.withColumn("_n", F.sum(starts).over(chunks.up_to_here(w)))
    else:
        rows = _mark_runs_chunked(rows, keys, state, running, seconds, order)
    return rows.withColumns({
        "gap_us": chunks.of_series(devices, micros_between(F.col("_pts"), F.col("ts"))),
        "run_id": chunks.of_series(devices, F.when(here.isNotNull() & (here != running), None).otherwise(F.col("_n"))),
    }).drop("_pts", "_ps", "_n")


def _mark_runs_chunked(rows, keys, state, running, seconds, order):
    c = chunks.CHUNK
    given = rows
    rows = chunks.with_chunk(rows, "ts", seconds)
    w = chunks.ordered([*keys, c], order)
    so_far = chunks.up_to_here(w)
    runs_on = F.col(state) == running
    rows = rows.withColumns({
        "_pts": F.lag("ts").over(w), "_ps": F.lag(state).over(w),
        "_first": F.first(state).over(so_far), "_end": F.lead(F.lit(1)).over(w).isNull(),
    })
    start = F.when(runs_on & (F.col("_ps") != running), 1).otherwise(0)
    rows = rows.withColumn("_n", F.sum(start).over(so_far))
    # a chunk's last row knows how the chunk begins, how it ends and how many runs start inside
    edge = rows.where("_end").select(*keys, c, "_first", F.col("_n").alias("_inside"), F.struct("ts", F.col(state).alias("s")).alias("_own"))
    edge = chunks.over_chunks(edge, keys, {"_prev": ("last", "_own")}, seconds)
    at_border = F.when((F.col("_first") == running) & (F.col("_prev.s") != running), 1).otherwise(0)
    edge = edge.withColumn("_border", at_border).withColumn("_new", F.col("_inside") + F.col("_border"))
    carry = chunks.over_chunks(edge, keys, {"_off": ("sum", "_new")}, seconds).select(
        *keys, c, "_prev", "_border", F.coalesce("_off", F.lit(0)).alias("_off"))
    out = chunks.attach(rows.drop("_first", "_end"), carry, keys).withColumns({
        "_pts": F.coalesce("_pts", "_prev.ts"),
        "_n": F.col("_n") + F.col("_off") + F.col("_border"),
    }).drop("_prev", "_border", "_off")
    return out if c in given.columns else out.drop(c)


def classify_runs(
    readings: DataFrame, log: DataFrame, thresholds: DataFrame, keys: Sequence[str],
    which: str, start: str, end: str, period: str | None = None, closed: bool = False,
    seconds: int | None = AUTO,
) -> DataFrame:
    """State, interval quantities and run id of every reading in a range.

    ``which`` picks the threshold: ``hi`` (burner) or ``lo`` (pump; includes burner time and
    carries no fuel). Thresholds hold for all devices or, if they have the key columns, for their
    own. ``period`` restarts gaps and run ids at every hour/day/month, which equals
    one call per period. ``seconds`` is the scan's chunk length: measured if AUTO, None for whole
    keys.
    """
    rows, seconds = known_states(readings, log, thresholds, keys, start, end, period, closed, seconds)
    return finish_runs(rows, keys, which, period, seconds)


def known_states(readings, log, thresholds, keys, start, end, period=None, closed=False, seconds=AUTO):
    """Readings of the range with main status and thresholds, and the chunk length to go on with.

    Readings without a device or without power belong to no run and are left out.
    """
    rows = in_range(readings, "ts", start, end, closed).where(F.col("watts").isNotNull())
    log = in_before(log, end, closed=closed)
    for k in keys:
        rows, log = rows.where(F.col(k).isNotNull()), log.where(F.col(k).isNotNull())
    if seconds == AUTO:
        seconds = chunks.choose_chunk(rows, keys, "ts", period)
    rows = chunks.with_chunk(rows, "ts", seconds)
    if keys and set(keys) <= set(thresholds.columns):
        rows = status_as_of(rows, log, keys, start, seconds, in_before(thresholds, end, "change_time", closed))
    else:
        rows = threshold_as_of(status_as_of(rows, log, keys, start, seconds), thresholds, end)
    if period is not None:
        rows = rows.withColumn(PERIOD, period_start(period, F.col("ts")))
    return rows, seconds


def finish_runs(rows: DataFrame, keys: Sequence[str], which: str, period: str | None, seconds: int | None) -> DataFrame:
    """State, run id and interval quantities for one of the two thresholds."""
    running = RUNNING[which]
    rows = rows.withColumn(
        "system_status", threshold_state(F.col("main_status"), F.col("watts"), F.col(which), running))
    rows = mark_runs(rows, keys, "system_status", running, [PERIOD] if period else [], seconds, SCAN_ORDER)
    burning = (F.col("system_status") == running) if which == "hi" else F.lit(False)
    fuel_us = energy.capped_gap(F.col("gap_us"))
    return rows.withColumns({
        "btu": F.when(burning, energy.btu(fuel_us)).otherwise(F.lit(0.0)),
        "gallons": F.when(burning, energy.gallons(fuel_us)).otherwise(F.lit(0.0)),
    }).drop("hi", "lo", "_kind", chunks.CHUNK)


def run_sums(classified: DataFrame, keys: Sequence[str], cap: bool = True) -> DataFrame:
    """Runtime and energy per (run, state). Kept as exact integers: microseconds, watt-microseconds."""
    gap = F.col("gap_us")
    return classified.groupBy(*keys, "run_id", "system_status").agg(
        F.sum(energy.capped_gap(gap) if cap else gap).alias("run_us"),
        F.sum(energy.watt_micros(F.col("watts"), gap)).alias("w_us"),
    )


def with_fuel(runs: DataFrame, running: str) -> DataFrame:
    """Adds heat and fuel of each run to its sums; other states burn nothing."""
    us = F.when(F.col("system_status") == running, F.col("run_us")).otherwise(F.lit(0))
    return runs.withColumns({"btu": F.coalesce(energy.btu(us), F.lit(0.0)), "gallons": F.coalesce(energy.gallons(us), F.lit(0.0))})


def summarize_runs(runs: DataFrame, keys: Sequence[str], running: str) -> DataFrame:
    """Totals over runs; without any run or reading every figure is zero."""
    on = F.col("system_status") == running
    us = F.when(on, F.col("run_us"))
    total = runs.groupBy(*keys).agg(
        F.sum("w_us").alias("w_us"),
        F.count(F.when(on, 1)).alias("cycles"),
        F.sum(us).alias("us"), F.count(us).alias("timed"),
        F.min(us).alias("min_us"), F.max(us).alias("max_us"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    us = F.col("us")
    return total.select(
        *keys,
        F.coalesce(us, F.lit(0)).alias("run_us"),
        zero(energy.btu(us)).alias("btu"),
        zero(energy.gallons(us)).alias("gallons"),
        zero(energy.kwh(F.col("w_us"))).alias("kwh"),
        F.col("cycles").cast("int").alias("cycles"),
        zero(energy.minutes(us)).alias("total_runtime"),
        zero(energy.minutes(us) / F.col("timed")).alias("avg_runtime"),
        zero(energy.minutes(F.col("min_us"))).alias("min_runtime"),
        zero(energy.minutes(F.col("max_us"))).alias("max_runtime"),
    )


def summary(
    readings: DataFrame, log: DataFrame, thresholds: DataFrame, keys: Sequence[str], which: str,
    start: str, end: str, period: str | None = None, cap: bool | None = None,
    seconds: int | None = AUTO, closed: bool = False,
) -> DataFrame:
    """Run totals per key (and period). The burner caps gaps, the pump does not."""
    cls = classify_runs(readings, log, thresholds, keys, which, start, end, period, closed, seconds)
    keys = [*keys, *([PERIOD] if period else [])]
    runs = run_sums(cls, keys, cap if cap is not None else which == "hi")
    return summarize_runs(runs, keys, RUNNING[which])


def debounce(rows: DataFrame, keys: Sequence[str], state: str, seconds: int | None = None) -> DataFrame:
    """An OFF sample between two ON samples becomes ON."""
    order = ("ts", "tie")
    rows = chunks.previous(rows, keys, order, {state: "_before"}, seconds)
    rows = chunks.following(rows, keys, order, {state: "_after"}, seconds)
    gap = (F.col(state) == "OFF") & (F.col("_before") == "ON") & (F.col("_after") == "ON")
    return rows.withColumn(state, F.when(gap, "ON").otherwise(F.col(state))).drop("_before", "_after")


def fixed_runs(
    readings: DataFrame, keys: Sequence[str], state: Column, smooth: bool = False,
    seconds: int | None = AUTO,
) -> DataFrame:
    """Runs under a fixed limit: state ON/OFF, optional smoothing, gaps and run ids per key."""
    if seconds == AUTO:
        seconds = chunks.choose_chunk(readings, keys, "ts")
    rows = readings.withColumn("system_status", state)
    rows = chunks.with_chunk(rows, "ts", seconds)
    if smooth:
        rows = debounce(rows, keys, "system_status", seconds)
    return mark_runs(rows, keys, "system_status", "ON", seconds=seconds).drop(chunks.CHUNK)


def cycle_stats(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hours, cycles and minutes per cycle of ON runs (kWh over all rows)."""
    us = F.when(F.col("system_status") == "ON", F.col("run_us"))
    minutes = energy.minutes
    t = runs.groupBy(*keys).agg(
        F.sum("w_us").alias("w_us"), F.sum(us).alias("us"), F.count(us).alias("cycles"),
        F.min(us).alias("lo"), F.max(us).alias("hi"),
    )
    return t.select(
        *keys,
        F.round(energy.kwh(F.col("w_us")), 2).alias("kwh"),
        F.round(minutes(F.col("us")) / 60, 2).alias("total_hours"),
        F.round(minutes(F.col("us")) / F.col("cycles"), 2).alias("avg_minutes"),
        F.round(minutes(F.col("lo")), 2).alias("min_minutes"),
        F.round(minutes(F.col("hi")), 2).alias("max_minutes"),
        F.col("cycles").cast("int").alias("cycles"),
    )
