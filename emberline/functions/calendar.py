"""Calendar parts, period bounds and season lookups as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Heating season of each month, January to December.
HEATING_SEASON = (
    "heat", "heat", "heat", "shoulder", "shoulder", "noheat",
    "noheat", "noheat", "noheat", "shoulder", "heat", "heat",
)
PERIODS = ("hour", "day", "month", "year")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def dow(d: Column) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(d) - 1


def period_start(period: str, ts: Column) -> Column:
    """Start of the minute, hour, day, month or year that holds ``ts``, without a time zone."""
    if period not in ("minute", *PERIODS):
        raise ValueError(f"period must be minute or one of {PERIODS}, not {period!r}")
    day = F.to_date(ts)
    if period == "minute":
        return F.timestamp_add("MINUTE", F.minute(ts), at_hour(day, F.hour(ts)))
    if period == "hour":
        return at_hour(day, F.hour(ts))
    if period == "day":
        return day.cast("timestamp_ntz")
    return F.trunc(day, period).cast("timestamp_ntz")


def period_step(period: str):
    return F.expr(f"INTERVAL 1 {period.upper()}")


def previous_period(period: str, now: Column) -> tuple[Column, Column]:
    """Half-open bounds of the last finished period before ``now``."""
    end = period_start(period, now)
    return (end - period_step(period)).cast("timestamp_ntz"), end


def micros_between(a: Column, b: Column) -> Column:
    """Whole microseconds from ``a`` to ``b``.

    A difference of zone-less timestamps stays clear of the session zone, whose clock changes
    would otherwise lengthen or shorten gaps.
    """
    seconds = (b - a).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("long")


def epoch_micros(ts: Column) -> Column:
    return micros_between(ntz("1970-01-01 00:00:00"), ts)


def instant_order(ts: Column, tie: Column) -> Column:
    """Time and tie as one number. Unlike a struct it lets max_by run as a hash aggregate."""
    return epoch_micros(ts).cast("decimal(38,0)") * F.lit("10000000000000000000").cast("decimal(20,0)") + tie


def epoch_seconds(ts: Column) -> Column:
    return F.floor(epoch_micros(ts) / 1_000_000)


def days_in_month(d: Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def is_leap(year: Column) -> Column:
    return F.dayofmonth(F.last_day(F.make_date(year, F.lit(2), F.lit(1)))) == 29


def at_hour(d: Column, hour: Column) -> Column:
    """Date plus an hour number."""
    return F.timestamp_add("HOUR", hour, d.cast("timestamp_ntz"))


def meteorological_season(doy: Column) -> Column:
    """winter / spring / summer / fall from the day of year."""
    return (
        F.when(doy < 60, "winter")
        .when(doy < 152, "spring")
        .when(doy < 244, "summer")
        .when(doy < 335, "fall")
        .otherwise("winter")
    )


def season_dimension(spark: SparkSession) -> DataFrame:
    """The twelve rows (month, season)."""
    names = F.array(*[F.lit(s) for s in HEATING_SEASON])
    return spark.range(1, 13).select(
        F.col("id").cast("int").alias("month"),
        F.element_at(names, F.col("id").cast("int")).alias("season"),
    )


def month_season(month: Column) -> Column:
    """The same mapping as an expression, where a join would only add a step."""
    return F.element_at(F.array(*[F.lit(s) for s in HEATING_SEASON]), month)
