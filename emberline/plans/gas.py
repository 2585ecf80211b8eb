"""Gas heat by hour, weekday, day of year, month and year: fill, score, sum, completeness."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.functions.calendar import dow, instant_order, ntz, period_start
from emberline.functions.energy import exact_sum
from emberline.operators import chunks, model, quality, tables
from emberline.operators.runs import AUTO, PERIOD
from emberline.operators.states import fill_rows, fill_status, in_range
from emberline.plans.closeout import closed_end

SLOTS = {"hour": "hour", "dow": "day", "doy": "day", "month": "month", "year": "year"}


def scored(readings: DataFrame, log: DataFrame, start: str, end: str, seconds: int | None = AUTO, keys: Sequence[str] = ()) -> DataFrame:
    """Every interval with its heat; rows without a device are left out."""
    for k in keys:
        readings, log = readings.where(F.col(k).isNotNull()), log.where(F.col(k).isNotNull())
    if seconds == AUTO:
        seconds = chunks.choose_chunk(readings, keys, "ts")
    return model.score(fill_status(readings, log, keys, start, end, seconds))


def gas_periods(intervals: DataFrame, period: str, keys: Sequence[str] = ()) -> DataFrame:
    """Heat and completeness per period. Long periods must also be covered end to end."""
    x = intervals.withColumn(PERIOD, period_start(period, F.col("ts")))
    by = [*keys, PERIOD]
    sums = x.groupBy(*by).agg(F.coalesce(exact_sum(F.col("btu")), F.lit(0.0)).alias("btu"))
    if period in ("month", "year"):
        ok = quality.complete_coverage(x, by, period)
    else:
        ok = quality.complete_max_gap(x, by)
    return sums.join(ok, by)


def gas_usage(intervals: DataFrame, slot: str, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """Slot table of closed periods: the newest period per slot, the one now starting empty.

    With ``keys`` each device that has closed a period has slots of its own, those of its readings.
    """
    period = SLOTS[slot]
    p = F.col(PERIOD)
    name = {"hour": F.hour, "dow": dow, "doy": F.dayofyear, "month": F.month, "year": F.year}[slot]
    closed = gas_periods(intervals.where(F.col("ts") < ntz(closed_end(period, as_of))), period, keys)
    newest = closed.groupBy(*keys, name(p).alias(slot)).agg(F.max_by(F.struct("btu", "complete", PERIOD), PERIOD).alias("n"))
    t = newest.select(
        *keys, slot, F.col("n.btu").alias("btu"), F.col("n.complete").alias("complete"),
        (F.col(f"n.{PERIOD}") + F.expr(f"INTERVAL 1 {period}")).cast("timestamp_ntz").alias("updated"))
    devices = closed.select(*keys).distinct() if keys else closed.sparkSession.range(1)
    opened = devices.select(
        *keys, name(ntz(as_of)).alias(slot), F.lit(0.0).alias("btu"), F.lit("no").alias("complete"),
        ntz(closed_end(period, as_of)).alias("updated"))
    return tables.upsert(t, opened, [*keys, slot])


def firing_rate(readings: DataFrame, log: DataFrame, as_of: str) -> DataFrame:
    """BTU per hour since the start of the previous hour.

    Of everything before only the newest reading matters, for the first gap; it is found by an
    aggregate, so just the recent readings are ordered.
    """
    hour = datetime.fromisoformat(as_of).replace(minute=0, second=0, microsecond=0)
    since = str(hour - timedelta(hours=1))
    before = readings.where(F.col("ts") < ntz(since))
    at = instant_order(F.col("ts"), F.col("tie"))
    seed = before.agg(
        F.max("ts").alias("ts"), F.max_by("tie", at).alias("tie"), F.max_by("watts", at).alias("watts"),
    ).where(F.col("ts").isNotNull())
    recent = in_range(readings, "ts", since, as_of, closed=True).select("ts", "tie", "watts")
    seconds = chunks.choose_chunk(recent, [], "ts")
    rows = fill_rows(recent.unionByName(seed), log.where(F.col("ts") <= ntz(as_of)), [], since, seconds)
    return model.score(rows.where(F.col("ts") >= ntz(since))).select(
        "ts", "watts", "status", "heatcall",
        F.round(F.col("heatcall") / 100 * 60000).cast("int").alias("btuph"))
