"""Chart tables: now against usual, against last year, and cumulative curves.

All read an hourly rollup ``(keys.., sum_date, hour, runtime)``, never readings. With ``keys`` each
device gets its own chart in the same pass; a rollup's rows per device are bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions import labels
from emberline.functions.calendar import at_hour, dow, micros_between, month_season
from emberline.operators import rollups
from emberline.operators.rollups import cumulative, latest, recency, weighted_mean


def _time(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp_ntz")


def shown(df: DataFrame, keys: Sequence[str], *order) -> DataFrame:
    """Rows in chart order. Charts of many devices come unsorted, as a table."""
    return df if keys else df.orderBy(*order)


def amount(c: str = "runtime") -> Column:
    return F.col(c).cast("double")


def daily_vs_last_year(hourly: DataFrame, days: int | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Each day beside the same day a year before; ``days`` keeps the newest."""
    u = rollups.prior_year(rollups.daily_sums(hourly, keys), keys)
    if days is not None:
        u = latest(u, ["sum_date"], days, keys)
    u = recency(u, ["sum_date"], keys)
    return shown(u.select(
        *keys, "sum_date", labels.day_label(F.col("sum_date")).alias("label"), amount().alias("runtime"),
        amount("previous_year").alias("previous_year"), F.lit("yes").alias("complete"), "row_number"), keys, "sum_date")


def week_vs_usual(
    hourly: DataFrame, stored: DataFrame, by_season: bool, keys: Sequence[str] = (),
) -> DataFrame:
    """The last seven days beside the mean of their weekday (in their season)."""
    spark = hourly.sparkSession
    base = rollups.by_dow_season(rollups.daily_sums(stored, keys), spark, keys)
    slots = [*keys, "dow", *(["season"] if by_season else [])]
    u = latest(rollups.daily_sums(hourly, keys), ["sum_date"], 7, keys).withColumn(
        "season", month_season(F.month("sum_date")))
    u = u if by_season else u.drop("season")
    return shown(u.join(weighted_mean(base, slots), slots).select(
        *keys, "sum_date", labels.weekday_name(F.col("sum_date")).alias("label"),
        amount().alias("runtime"), "runtime_avg", F.lit("yes").alias("complete")), keys, "sum_date")


def slot_day(hour: Column, as_of: str) -> Column:
    """Hours later than now belong to yesterday."""
    now = _time(as_of)
    return F.when(hour > F.hour(now), F.date_sub(F.to_date(now), 1)).otherwise(F.to_date(now))


def day_vs_usual(
    hourly: DataFrame, as_of: str, by_dow: bool = False, by_season: bool = False, keys: Sequence[str] = (),
) -> DataFrame:
    """The last 24 hours beside the mean of their hour (and weekday, and season)."""
    base = rollups.by_dow_season_hour(hourly, hourly.sparkSession, keys)
    slots = ["hour", *(["dow"] if by_dow else []), *(["season"] if by_season else [])]
    day = slot_day(F.col("hour"), as_of)
    slot = {"hour": F.col("hour"), "dow": dow(day), "season": month_season(F.month(day))}
    u = latest(hourly, ["sum_date", "hour"], 24, keys).select(
        *keys, "sum_date", "runtime", *[slot[s].alias(s) for s in slots])
    slots = [*keys, *slots]
    return shown(u.join(weighted_mean(base, slots), slots).select(
        *keys, "sum_date", F.col("hour").alias("label"), amount().alias("runtime"), "runtime_avg",
        F.lit("yes").alias("complete")), keys, "sum_date", "label")


def year_vs_usual(hourly: DataFrame, stored: DataFrame, as_of: str, keys: Sequence[str] = ()) -> DataFrame:
    """The last twelve months beside the mean of their month, in hours."""
    base = rollups.by_month(rollups.monthly_sums(stored, keys), _time(as_of), keys)
    u = hourly.groupBy(*keys, F.year("sum_date").alias("year"), F.month("sum_date").alias("month")).agg(
        F.max("sum_date").alias("last_day"), F.sum("runtime").alias("runtime"))
    u = recency(latest(u, ["last_day"], 12, keys), ["last_day"], keys)
    slots = [*keys, "month"]
    return shown(u.join(weighted_mean(base, slots), slots).select(
        *keys, F.date_format("last_day", "MMM").alias("label"), (amount() / 60).alias("runtime"),
        (F.col("runtime_avg") / 60).alias("runtime_avg"), F.lit("yes").alias("complete"), "row_number"),
        keys, F.col("row_number").desc())


def prior_year_to_date(hourly: DataFrame, as_of: str, adjustments: dict[int, float] | None = None) -> DataFrame:
    """Last year's amount up to this day, with fixed back-fills for years the feed missed."""
    today = F.to_date(_time(as_of))
    year = int(as_of[:4])
    span = hourly.where(
        (F.col("sum_date") >= F.make_date(F.lit(year - 1), F.lit(1), F.lit(1)))
        & (F.col("sum_date") <= F.add_months(today, -12)))
    extra = (adjustments or {}).get(year - 1, 0.0)
    return span.agg((F.sum("runtime").cast("double") + F.lit(float(extra))).alias("runtime")).select(
        F.lit(year).alias("year"), "runtime")


# Fixed value: minutes of 2016 from before the feed began.
BACKFILL_MINUTES = {2016: 46048.72230754999999996671}


def years(hourly: DataFrame, as_of: str) -> DataFrame:
    """Each year in hours; the current one beside the prior year to date."""
    prior = prior_year_to_date(hourly, as_of, BACKFILL_MINUTES).select("runtime").scalar()
    return rollups.yearly_sums(hourly).select(
        F.col("year").alias("label"), (amount() / 60).alias("runtime"),
        F.when(F.col("year") == int(as_of[:4]), prior / 60).alias("previous_yeartodate_runtime"),
        F.lit("yes").alias("complete")).orderBy("label")


def plot_stamp(ts: Column, year: int) -> Column:
    """The same clock time in a common year; 29 February falls on the 28th if that has none."""
    shift = (F.lit(year) - F.year(ts)) * 12
    day = F.add_months(F.to_date(ts), shift)
    since_midnight = micros_between(F.to_date(ts).cast("timestamp_ntz"), ts)
    return F.timestamp_add("MICROSECOND", since_midnight, day.cast("timestamp_ntz"))


def month_curves(
    hourly: DataFrame, averages: DataFrame, projection: DataFrame, month: int,
) -> DataFrame:
    """Cumulative hours within one month: a curve per year, the mean, and the projection.

    The projection begins at the newest measured point.
    """
    d = F.col("sum_date")
    m = hourly.where(F.month(d) == month).withColumns({"year": F.year(d), "day": F.dayofmonth(d)})
    m = cumulative(m, ["day", "hour"], "runtime", "_c", ["year"])
    end_of_hour = F.timestamp_add("SECOND", F.lit(3599), at_hour(d, F.col("hour")))
    measured = m.select(
        F.concat(F.lit("measured "), F.col("year").cast("string")).alias("curve"),
        end_of_hour.alias("timestamp"), (amount("_c") / 60).alias("hours"))
    mean = averages.where(F.month("timestamp") == month).select(
        F.lit("average").alias("curve"), "timestamp", (F.col("monthly_cum_avg_runtime") / 60).alias("hours"))
    anchor = latest(measured, ["timestamp"], 1)
    ahead = anchor.unionByName(projection.select(
        F.lit("").alias("curve"), "timestamp", (F.col("runtime") / 60).alias("hours")))
    parts = measured.unionByName(mean).unionByName(ahead.withColumn("curve", F.lit("predicted")))
    return parts.withColumn("plotstamp", plot_stamp(F.col("timestamp"), 2000))


def year_curves(stored: DataFrame, averages: DataFrame, as_of: str) -> DataFrame:
    """Cumulative hours within the year: a curve per year and the mean, on this year's dates."""
    d = F.col("sum_date")
    daily = rollups.daily_sums(stored).withColumns({"year": F.year(d), "doy": F.dayofyear(d)})
    daily = cumulative(daily, ["doy"], "runtime", "_c", ["year"])
    shift = (F.lit(int(as_of[:4])) - F.col("year")) * 12
    measured = daily.select(
        F.concat(F.lit("measured "), F.col("year").cast("string")).alias("curve"),
        d.alias("date"), F.add_months(d, shift).alias("plotstamp"), (amount("_c") / 60).alias("hours"))
    mean = averages.groupBy(F.to_date("timestamp").alias("date")).agg(F.max("cum_avg_runtime").alias("_c"))
    return measured.unionByName(mean.select(
        F.lit("average").alias("curve"), "date", F.col("date").alias("plotstamp"),
        (F.col("_c") / 60).alias("hours")))


def daylight_markers(hours: DataFrame, sky: DataFrame) -> DataFrame:
    """Latest sunrise and sunset at or before each hour: today's, or yesterday's if still to come.

    ``hours`` has (sum_date, hour), ``sky`` (date, sunrise, sunset) as clock texts.
    """
    clock_hour = lambda c: F.hour(F.to_timestamp(F.concat(F.lit("2000-01-01 "), F.col(c))))
    today = sky.select(F.col("date").alias("sum_date"), "sunrise", "sunset")
    before = sky.select(
        F.date_add("date", 1).alias("sum_date"),
        F.col("sunrise").alias("_r"), F.col("sunset").alias("_s"))
    x = hours.join(today, "sum_date").join(before, "sum_date", "left")
    return x.select(
        "sum_date", "hour",
        F.when(clock_hour("sunrise") > F.col("hour"), F.col("_r")).otherwise(F.col("sunrise")).alias("sunrise"),
        F.when(clock_hour("sunset") > F.col("hour"), F.col("_s")).otherwise(F.col("sunset")).alias("sunset"))
