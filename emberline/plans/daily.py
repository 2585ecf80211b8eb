"""Daily statistics: one row per device and day on which the device was on or switched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions import labels
from emberline.functions.calendar import micros_between
from emberline.functions.energy import rounded
from emberline.operators import chunks
from emberline.operators.runs import (
    AUTO, PERIOD, cycle_stats, finish_runs, fixed_runs, known_states, run_sums, summarize_runs,
)
from emberline.operators.states import RUNNING, active_days, fixed_state

DRYING_LIMIT_W = 415  # fixed value


def heating_daily(
    readings: DataFrame, log: DataFrame, thresholds: DataFrame, keys: Sequence[str],
    start: str, end: str, seconds: int | None = AUTO,
) -> DataFrame:
    """Burner and pump figures side by side, rounded, with the line of text reported each day.

    Status and thresholds are worked out once; both thresholds read the same shuffle.
    """
    rows, seconds = known_states(readings, log, thresholds, keys, start, end, "day", seconds=seconds)
    by = [*keys, PERIOD]

    def figures(which):
        runs = run_sums(finish_runs(rows, keys, which, "day", seconds), by, cap=which == "hi")
        return summarize_runs(runs, by, RUNNING[which])

    hi = figures("hi").drop("run_us")
    lo = figures("lo").select(*by, *[
        F.col(c).alias(f"low_{c}") for c in ("cycles", "total_runtime", "avg_runtime", "min_runtime", "max_runtime")])
    both = hi.join(lo, by).withColumn("date", F.to_date(PERIOD)).drop(PERIOD)
    gate = active_days(both.select(*keys, "date"), log, keys).select(*keys, "date")
    both = both.join(gate, [*keys, "date"], "left_semi")
    line = labels.heating_status_line(
        F.col("total_runtime"), F.col("cycles"), F.col("avg_runtime"),
        F.col("low_total_runtime"), F.col("low_cycles"), F.col("low_avg_runtime"),
        F.col("btu"), F.col("gallons"), F.col("kwh"))
    two = lambda c: rounded(F.col(c), 2).alias(c)
    return both.withColumn("status_line", line).select(
        *keys, "date", two("btu"), two("gallons"), two("kwh"), "cycles", two("total_runtime"),
        two("avg_runtime"), two("min_runtime"), two("max_runtime"), "low_cycles", two("low_total_runtime"),
        two("low_avg_runtime"), two("low_min_runtime"), two("low_max_runtime"), "status_line")


def drying_daily(
    readings: DataFrame, log: DataFrame, weather: DataFrame, keys: Sequence[str],
    limit: float = DRYING_LIMIT_W, seconds: int | None = AUTO,
) -> DataFrame:
    """Dehumidifier day by day: fixed limit, single OFF samples smoothed, runs within the day.

    Gaps reach back into the day before; runs and smoothing do not.
    """
    if seconds == AUTO:
        seconds = chunks.choose_chunk(readings, keys, "ts", "day")
    rows = chunks.previous(readings, keys, ("ts", "tie"), {"ts": "_before"}, seconds)
    rows = rows.withColumns({
        "stored_us": micros_between(F.col("_before"), F.col("ts")), "date": F.to_date("ts"),
    }).drop("_before")
    by = [*keys, "date"]
    rows = fixed_runs(rows, by, fixed_state(F.col("watts"), limit), smooth=True, seconds=seconds)
    stats = cycle_stats(run_sums(rows.withColumn("gap_us", F.col("stored_us")), by, cap=False), by)
    gate = active_days(stats.select(*by), log, keys).select(*by)
    out = stats.join(gate, by, "left_semi").join(weather, "date", "left")
    line = labels.drying_status_line(
        F.coalesce("total_hours", F.lit(0.0)), F.col("cycles"), F.coalesce("avg_minutes", F.lit(0.0)),
        F.col("mean_temperature"), F.col("mean_dewpoint"))
    return out.withColumn("status_line", line).drop("mean_temperature", "mean_dewpoint")
