"""Closing hours, days and months: slot tables, running baselines, sums, completeness.

The scheduled job closes one period per call. Here every period of a range is closed in one
pass, which leaves the same tables behind. Periods are exact and half-open. ``keys`` close every
device apart; without keys all readings are those of one device.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions import energy
from emberline.functions.calendar import dow, meteorological_season, micros_between, ntz, period_start
from emberline.operators import chunks, quality, tables
from emberline.operators.runs import AUTO, PERIOD, summary
from emberline.sources.series import SEASONS, calendar, integers, slot_grid, spine


def closed_end(period: str, as_of: str) -> str:
    """Start of the period that is open at ``as_of``; all before it is closed."""
    cut = {"hour": 13, "day": 10, "month": 7, "year": 4}[period]
    return as_of[:cut] + "0000-01-01 00:00:00"[cut:]


def stored_gaps(readings: DataFrame, seconds: int | None, keys: Sequence[str] = ()) -> DataFrame:
    """Readings with the gap to the one before, whatever period that lies in."""
    x = chunks.previous(readings, keys, ("ts", "tie"), {"ts": "_before"}, seconds)
    return x.withColumn("gap_us", micros_between(F.col("_before"), F.col("ts"))).drop("_before")


def closed_periods(
    readings: DataFrame, log: DataFrame, thresholds: DataFrame, period: str, start: str, as_of: str,
    seconds: int | None = AUTO, keys: Sequence[str] = (),
) -> DataFrame:
    """One row per closed period, idle and empty ones too.

    The single device of a table without ``keys`` has every period of the range; with keys each device has
    those from its first to its last reading in it, so a device seen for a day costs a day. Readings
    without a device belong to none and are left out.
    """
    end = closed_end(period, as_of)
    rows = readings.where((F.col("ts") >= ntz(start)) & (F.col("ts") < ntz(end)))
    for k in keys:
        rows = rows.where(F.col(k).isNotNull())
    if seconds == AUTO:
        seconds = chunks.choose_chunk(rows, keys, "ts", period)
    by, step = [*keys, PERIOD], F.expr(f"INTERVAL 1 {period}")
    sums = summary(readings, log, thresholds, keys, "hi", start, end, period, seconds=seconds)
    ok = quality.complete_any_gap(
        stored_gaps(rows, seconds, keys).withColumn(PERIOD, period_start(period, F.col("ts"))), by)
    if keys:
        every = rows.select(*keys, period_start(period, F.col("ts")).alias(PERIOD)).distinct()
    else:
        bounds = readings.sparkSession.range(1).select(
            ntz(start).alias("lo"), (ntz(end) - step).cast("timestamp_ntz").alias("hi"))
        every = spine(bounds, "lo", "hi", f"1 {period.upper()}", PERIOD)
    every = every.join(sums.select(*by, "run_us"), by, "left").join(ok, by, "left")
    if keys:
        every = with_empty_periods(every, step, keys)
    p = F.col(PERIOD)
    return every.select(
        *keys, p, p.cast("date").alias("sum_date"), F.hour(p).alias("hour"), dow(p).alias("dow"),
        F.month(p).alias("month"), F.dayofmonth(p).alias("day"),
        meteorological_season(F.dayofyear(p)).alias("season"),
        F.coalesce("run_us", F.lit(0)).alias("run_us"),
        F.coalesce("complete", F.lit("yes")).alias("complete"),
        (p + F.expr(f"INTERVAL 1 {period}")).cast("timestamp_ntz").alias("updated"),
    )


def with_empty_periods(seen: DataFrame, step: Column, keys: Sequence[str]) -> DataFrame:
    """The periods of each device that hold readings, each followed by the empty ones up to the next.

    Only periods with readings are shuffled, by device; all periods stay where they are made. A partition's rows are few
    beside what they become, so their number is kept: merged by size, a task would get a share that grows with the table.
    """
    partitions = int(seen.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = seen.repartition(partitions, *keys)
    upcoming = (F.lead(PERIOD).over(Window.partitionBy(*keys).orderBy(PERIOD)) - step).cast("timestamp_ntz")
    rows = seen.withColumn("_until", F.coalesce(upcoming, PERIOD)).withColumnRenamed(PERIOD, "_own")
    rows = rows.select("*", F.explode(F.sequence("_own", "_until", step)).alias(PERIOD))
    mine = F.col(PERIOD) == F.col("_own")
    return rows.select(*keys, PERIOD, *(F.when(mine, F.col(c)).alias(c) for c in ("run_us", "complete")))


def on_grid(grid: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All slots of ``grid`` with their ``known`` values, else null; each device in ``known`` has them all.

    ``_slot`` numbers the slots of the grid, 960 at most, from 0. A device's rows bring the slots between them along and
    stay where they are: a join on device and slot would shuffle the grid once for each device.
    """
    if not keys:
        return grid.join(known, "_slot", "left").drop("_slot")
    values = [c for c in known.columns if c not in (*keys, "_slot")]
    slots = grid.agg(F.sort_array(F.collect_list(F.struct("_slot", *(c for c in grid.columns if c != "_slot"))))).scalar()
    w = Window.partitionBy(*keys).orderBy("_slot")
    start = F.when(F.lag("_slot").over(w).isNull(), F.lit(0)).otherwise(F.col("_slot"))
    rows = known.withColumns({"_start": start, "_until": F.lead("_slot").over(w)})
    # the grid comes in above the window, which would carry it on every row
    length = F.coalesce("_until", F.size(slots)) - F.col("_start")
    rows = rows.select(*keys, *values, F.col("_slot").alias("_own"), F.inline(F.slice(slots, F.col("_start") + 1, length)))
    mine = F.col("_slot") == F.col("_own")
    return rows.select(
        *keys, *(c for c in grid.columns if c != "_slot"), *(F.when(mine, F.col(c)).alias(c) for c in values))


def period_sums(closed: DataFrame, period: str, keys: Sequence[str] = ()) -> DataFrame:
    """The rows that closing appends to the hourly, daily or monthly sums, one for each closed period."""
    slots = {"hour": ["sum_date", "hour"], "day": ["sum_date"], "month": ["sum_date", "month"]}[period]
    us = F.col("run_us")
    return closed.select(*keys, *slots, energy.minutes(us).alias("runtime"), energy.btu(us).alias("btu"), "complete")


def slot_number(slots: Sequence[str]) -> Column:
    """The number of a slot in its table, from 0 and without holes; a leap year numbers the days."""
    hour, weekday, season = F.col("hour"), F.col("dow"), F.array_position(F.array(*map(F.lit, SEASONS)), F.col("season")).cast("int") - 1
    return {
        "hour": hour,
        "hour+dow": hour * 7 + weekday,
        "hour+season": hour * 4 + season,
        "hour+dow+season": (hour * 7 + weekday) * 4 + season,
        "dow": weekday,
        "dow+season": weekday * 4 + season,
        "month": F.col("month") - 1,
        "month+day": F.dayofyear(F.make_date(F.lit(2000), F.col("month"), F.col("day"))) - 1,
    }["+".join(slots)]


def means() -> list[Column]:
    return [F.sum("run_us").alias("us"), F.count("*").alias("n")]


def newest() -> list[Column]:
    """The newest closed period of a slot, in columns of fixed width, so that a hash aggregate can hold them."""
    return [
        F.max_by("run_us", PERIOD).alias("last_us"), F.max_by(F.col("complete") == "yes", PERIOD).alias("whole"),
        F.max("updated").alias("updated")]


def slot_table(grid: DataFrame, closed: DataFrame, slots: tuple[str, ...], keys: Sequence[str], *figures: Column) -> DataFrame:
    """Every slot of ``grid``, of each device that has closed a period, with figures of its closed periods."""
    at = slot_number(slots).alias("_slot")
    known = closed.groupBy(*keys, *slots).agg(*figures)
    known = known.select(*keys, at, *(c for c in known.columns if c not in (*keys, *slots)))
    return on_grid(grid.select(*slots, at), known, keys)


def usage(starting: Column, period: str, as_of: str, t: DataFrame) -> DataFrame:
    """Each slot holds its newest closed period; the slot now starting is empty."""
    t = t.withColumns({
        "btu": F.coalesce(energy.btu(F.col("last_us")), F.lit(0.0)),
        "complete": quality.yes_no(F.col("whole"))}).drop("last_us", "whole")
    return tables.reset_slot(t, starting, closed_end(period, as_of))


def running_mean(t: DataFrame) -> DataFrame:
    """Running mean per slot over the closed periods, zero where there is none yet."""
    return t.withColumns({
        "count": F.coalesce("n", F.lit(0)).cast("int"),
        "btu_avg": F.coalesce(energy.btu(F.col("us")) / F.col("n"), F.lit(0.0))}).drop("us", "n")


def usage_table(
    grid: DataFrame, closed: DataFrame, slots: tuple[str, ...], starting: Column, period: str, as_of: str, keys: Sequence[str],
    *more: Column,
) -> DataFrame:
    """Slot table with running means, from one aggregate; ``more`` figures stay at the end as they are."""
    t = slot_table(grid, closed, slots, keys, *newest(), *means(), *more)
    rest = [c for c in t.columns if c not in (*keys, *slots, "last_us", "whole", "updated", "us", "n")]
    return running_mean(usage(starting, period, as_of, t)).select(
        *keys, *slots, "btu", "complete", "updated", "count", "btu_avg", *rest)


def hour_table(closed: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    hours, now = integers(closed.sparkSession, 0, 23, "hour"), F.hour(ntz(as_of))
    return usage_table(hours, closed, ("hour",), F.col("hour") == now, "hour", as_of, keys)


# Each baseline by its slots, with the number of its first slot where the four tables stand in a row.
BASELINES = {("hour",): 0, ("hour", "dow"): 24, ("hour", "season"): 192, ("hour", "dow", "season"): 288}


def hour_baselines(closed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The four hourly baselines in one table, from one aggregate; slots a baseline ignores are null."""
    full = ["hour", "dow", "season"]
    at = {b: (first + slot_number(b)).alias("_slot") for b, first in BASELINES.items()}
    rows = (F.struct(at[b], F.lit("+".join(b)).alias("baseline"), *(F.when(F.lit(c in b), F.col(c)).alias(c) for c in full)) for b in at)
    grid = slot_grid(closed.sparkSession).select(F.inline(F.array(*rows))).distinct()
    known = closed.groupBy(*keys, *full).agg(*means())
    known = known.select(*keys, "us", "n", F.explode(F.array(*at.values())).alias("_slot"))
    known = known.groupBy(*keys, "_slot").agg(F.sum("us").alias("us"), F.sum("n").alias("n"))
    return running_mean(on_grid(grid, known, keys)).select("baseline", *keys, *full, "count", "btu_avg")


def dow_table(closed: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    days, today = integers(closed.sparkSession, 0, 6, "dow"), dow(ntz(as_of))
    return usage_table(days, closed, ("dow",), F.col("dow") == today, "day", as_of, keys)


def dow_season_table(closed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    grid = slot_grid(closed.sparkSession).select("dow", "season").distinct()
    return running_mean(slot_table(grid, closed, ("dow", "season"), keys, *means()))


def doy_table(closed: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """Day-of-year slots with this and the previous year's amount, rolled on the day now starting."""
    days, slots = calendar(closed.sparkSession).select("month", "day"), ("month", "day")
    today = (F.col("month") == F.month(ntz(as_of))) & (F.col("day") == F.dayofmonth(ntz(as_of)))
    closed = closed.withColumn("before", F.lag("run_us").over(Window.partitionBy(*keys, *slots).orderBy(PERIOD)))
    years = F.max_by("run_us", PERIOD).alias("this_us"), F.max_by("before", PERIOD).alias("before_us")
    t = usage_table(days, closed, slots, today, "day", as_of, keys, *years)
    amount = lambda c: F.coalesce(energy.btu(F.col(c)), F.lit(0.0))
    t = t.withColumns({"previous_year": amount("before_us"), "current_year": amount("this_us")}).drop("before_us", "this_us")
    return tables.roll_year(t, today)


def month_table(closed: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    months, slots = integers(closed.sparkSession, 1, 12, "month"), ("month",)
    last = F.max_by("run_us", PERIOD).alias("previous_us")
    t = usage_table(months, closed, slots, F.col("month") == F.month(ntz(as_of)), "month", as_of, keys, last)
    return t.withColumn("previous_year", F.coalesce(energy.btu(F.col("previous_us")), F.lit(0.0))).drop("previous_us")
