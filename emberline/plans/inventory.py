"""Fuel in the tank: level now, level by hour, days until low and empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.energy import GALLONS_PER_HOUR, TANK_GALLONS
from emberline.operators.rollups import cumulative
from emberline.sources.series import spine

# The share of the tank that counts as low, and the gallons before the first delivery.
LOW_SHARE = 0.25
START_GALLONS = 31.5


def burned(minutes: Column) -> Column:
    return minutes.cast("double") / 60 * GALLONS_PER_HOUR


def remaining_gallons(deliveries: DataFrame, hourly: DataFrame, tank: float = TANK_GALLONS) -> DataFrame:
    """Full tank at the last fill, plus later deliveries, less usage from the fill date on; a full tank without any fill.

    Both tables are read once and summed by day; the window is over days.
    """
    date = F.col("delivery_date").cast("date")
    days = deliveries.select(date.alias("date"), "gallons", F.when(F.col("fill"), date).alias("filled")).unionByName(
        hourly.select(F.col("sum_date").cast("date").alias("date"), "runtime"), allowMissingColumns=True)
    days = days.groupBy("date").agg(F.sum("gallons").alias("gallons"), F.sum("runtime").alias("runtime"), F.max("filled").alias("filled"))
    days = days.withColumn("filled", F.max("filled").over(Window.partitionBy()))
    added = F.sum(F.when(F.col("date") > F.col("filled"), F.col("gallons"))).cast("double")
    used = F.round(burned(F.sum(F.when(F.col("date") >= F.col("filled"), F.col("runtime")))), 2)
    return days.agg((F.lit(tank) + F.coalesce(added, F.lit(0.0)) - F.coalesce(used, F.lit(0.0))).alias("remaining_gallons"))


def balance(predicted: DataFrame, remaining: DataFrame) -> DataFrame:
    """Gallons left at the end of each coming day."""
    x = predicted.withColumn("gallons", burned(F.col("predicted_runtime")))
    x = cumulative(x, ["date"], "gallons", "_sum")
    return x.select("date", "gallons", (remaining.scalar() - F.col("_sum")).alias("remaining_gallons"))


def remaining_fuel(
    deliveries: DataFrame, hourly: DataFrame, predicted: DataFrame, as_of: str, tank: float = TANK_GALLONS,
) -> DataFrame:
    """Level, and the last day still above a quarter and above nothing.

    If the balance stays above a limit, its date is the last forecast date and ``*_reached`` is
    false.
    """
    left = remaining_gallons(deliveries, hourly, tank)
    today = F.lit(as_of[:10]).cast("date")
    g = F.col("remaining_gallons")
    low, empty = g < LOW_SHARE * tank, g < 0
    ahead = balance(predicted, left).agg(
        F.max(F.when(~low, F.col("date"))).alias("low_date"),
        F.max(F.when(~empty, F.col("date"))).alias("empty_date"),
        F.coalesce(F.bool_or(low), F.lit(False)).alias("low_reached"),
        F.coalesce(F.bool_or(empty), F.lit(False)).alias("empty_reached"),
    ).withColumn("remaining_gallons", left.scalar())
    return ahead.select(
        "remaining_gallons", F.round(g / tank * 100, 2).alias("tank_level"),
        "low_date", F.datediff("low_date", today).alias("low_days"),
        "empty_date", F.datediff("empty_date", today).alias("empty_days"),
        "low_reached", "empty_reached",
    )


def tank_level(deliveries: DataFrame, hourly: DataFrame, as_of: str, start: float = START_GALLONS) -> DataFrame:
    """Level by hour, from one hour before the first delivery. Deliveries land at midnight.

    Gallons and minutes are summed apart as decimals and turned into a level once.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    first = (F.min("delivery_date").cast("timestamp_ntz") - F.expr("INTERVAL 1 HOUR")).alias("lo")
    hours = spine(deliveries.agg(first).withColumn("hi", now), "lo", "hi", "1 HOUR", "timestamp", ["lo"])
    hours = hours.withColumns({"sum_date": F.to_date("timestamp"), "hour": F.hour("timestamp")})
    filled = deliveries.groupBy(F.col("delivery_date").cast("timestamp_ntz").alias("timestamp")).agg(
        F.sum("gallons").alias("gallons"))
    x = hours.join(filled, "timestamp", "left").join(hourly, ["sum_date", "hour"], "left")
    opening = F.when(F.col("timestamp") == F.col("lo"), F.lit(str(start)).cast("decimal(28,2)"))
    x = x.withColumns({
        "_in": F.coalesce("gallons", opening, F.lit(0).cast("decimal(28,2)")),
        "_run": F.coalesce("runtime", F.lit(0).cast("decimal(28,2)")),
    })
    x = cumulative(cumulative(x, ["timestamp"], "_in", "_ins"), ["timestamp"], "_run", "_runs")
    return x.select("timestamp", (F.col("_ins").cast("double") - burned(F.col("_runs"))).alias("tank_level"))
