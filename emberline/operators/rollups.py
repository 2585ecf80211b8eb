"""Sums by hour, day, month and year, and the baselines drawn from them.

Rollups have one row per calendar slot (and key), so they stay small however many readings
lie below; windows over them are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberline.functions.calendar import dow, instant_order, season_dimension


def ratio(total: str | Column, n: str | Column) -> Column:
    """Mean from an exact sum and a count, divided once."""
    return F.col(total).cast("double") / F.col(n) if isinstance(total, str) else total.cast("double") / n


def hourly_sums(df: DataFrame, day: Column, hour: Column, amount: Column, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys, day.alias("sum_date"), hour.alias("hour")).agg(F.sum(amount).alias("runtime"))


def daily_sums(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return hourly.groupBy(*keys, "sum_date").agg(F.sum("runtime").alias("runtime")).withColumn(
        "dow", dow(F.col("sum_date")))


def monthly_sums(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    d = F.col("sum_date")
    return hourly.groupBy(*keys, F.year(d).alias("year"), F.month(d).alias("month")).agg(
        F.sum("runtime").alias("runtime"))


def yearly_sums(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return hourly.groupBy(*keys, F.year("sum_date").alias("year")).agg(F.sum("runtime").alias("runtime"))


def union_live(stored: DataFrame, live: DataFrame) -> DataFrame:
    """Stored hours and the open hour. Duplicates go only where the amount is equal as well."""
    return stored.unionByName(live).distinct()


def with_season(df: DataFrame, spark: SparkSession, day: str = "sum_date") -> DataFrame:
    """Adds the heating season by month. The dimension has twelve rows by construction."""
    months = F.broadcast(season_dimension(spark).withColumnRenamed("month", "_m"))
    return df.join(months, F.month(day) == F.col("_m")).drop("_m")


def _average(df: DataFrame, slots: Sequence) -> DataFrame:
    return df.groupBy(*slots).agg(
        F.sum("runtime").alias("runtime_sum"), F.count("*").alias("count"))


def with_mean(baseline: DataFrame) -> DataFrame:
    return baseline.withColumn("runtime_avg", ratio("runtime_sum", "count")).drop("runtime_sum")


def by_dow_season(daily: DataFrame, spark: SparkSession, keys: Sequence[str] = ()) -> DataFrame:
    return _average(with_season(daily, spark), [*keys, "dow", "season"])


def by_month_day(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    d = F.col("sum_date")
    return _average(daily, [*keys, F.month(d).alias("month"), F.dayofmonth(d).alias("day")])


def by_dow_season_hour(hourly: DataFrame, spark: SparkSession, keys: Sequence[str] = ()) -> DataFrame:
    return _average(with_season(hourly, spark), [*keys, dow(F.col("sum_date")).alias("dow"), "season", "hour"])


def by_month(monthly: DataFrame, as_of: Column, keys: Sequence[str] = ()) -> DataFrame:
    """Mean per month, leaving out the month that is not over yet."""
    done = (F.col("year") != F.year(as_of)) | (F.col("month") != F.month(as_of))
    return monthly.groupBy(*keys, "month").agg(
        F.sum(F.when(done, F.col("runtime"))).alias("runtime_sum"),
        F.count(F.when(done, 1)).alias("count"),
    )


def by_month_day_hour(hourly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    d = F.col("sum_date")
    return _average(hourly, [*keys, F.month(d).alias("month"), F.dayofmonth(d).alias("day"), "hour"])


def weighted_mean(baseline: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Mean of means weighted by count; the merged sums give it exactly."""
    return baseline.groupBy(*slots).agg(
        F.sum("runtime_sum").alias("_s"), F.sum("count").alias("_n")
    ).select(*slots, ratio("_s", "_n").alias("runtime_avg"))


def merge_baselines(old: DataFrame, new: DataFrame, slots: Sequence[str]) -> DataFrame:
    """Folds new sums and counts into old ones: the running mean without re-reading history."""
    return old.select(*slots, "runtime_sum", "count").unionByName(
        new.select(*slots, "runtime_sum", "count")
    ).groupBy(*slots).agg(F.sum("runtime_sum").alias("runtime_sum"), F.sum("count").alias("count"))


def latest(df: DataFrame, order: Sequence[str], k: int, keys: Sequence[str] = ()) -> DataFrame:
    """The k newest rows (a top-k, not a full sort), of each key where there are keys."""
    if keys:
        return recency(df, order, keys, "_k").where(F.col("_k") <= k).drop("_k")
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(k)


def newest_reading(readings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Time and power of each device's last reading."""
    at = instant_order(F.col("ts"), F.col("tie"))
    return readings.groupBy(*keys).agg(F.max("ts").alias("ts"), F.max_by("watts", at).alias("watts"))


def recency(df: DataFrame, order: Sequence, keys: Sequence[str] = (), name: str = "row_number") -> DataFrame:
    """1 for the newest row. Meant for rollups, whose rows per key the calendar bounds."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn(name, F.row_number().over(w))


def cumulative(df: DataFrame, order: Sequence[str], col: str, name: str, keys: Sequence = ()) -> DataFrame:
    """Running total of a rollup; equal order shares its total."""
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*order)
    return df.withColumn(name, F.sum(col).over(w))


def prior_year(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Adds the amount of the same day a year earlier (29 February compares with the 28th)."""
    before = daily.select(*keys, F.col("sum_date").alias("_d"), F.col("runtime").alias("previous_year"))
    return daily.withColumn("_d", F.add_months("sum_date", -12)).join(before, [*keys, "_d"], "left").drop("_d")
