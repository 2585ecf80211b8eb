"""Degree days, predicted runtime and the rest-of-month projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.calendar import dow, meteorological_season
from emberline.operators.rollups import cumulative
from emberline.sources.series import spine

# Minutes of runtime as a polynomial of degree days, constant term first,
# by season and by weekend (Saturday, Sunday) or weekday.
RUNTIME_CURVES = {
    ("spring", "weekend"): (95.970912, -6.420110, 0.610510, -0.005119),
    ("spring", "weekday"): (56.122516, 4.128802, -0.509963, 0.039681, -0.000559),
    ("summer", "weekend"): (63.50494,),
    ("summer", "weekday"): (56.70688,),
    ("fall", "weekend"): (54.303062, 2.450336, -0.443580, 0.057871, -0.001182),
    ("fall", "weekday"): (65.96960, -10.36148, 1.38611, -0.02345),
    ("winter", "weekend"): (813.0, -101.0668277, 5.5227733, -0.1139575, 0.0008518),
    ("winter", "weekday"): (942.79250606, -67.43478419, 1.47757949, 0.03468729, -0.00130760, 0.00001031),
}


def polynomial(x: Column, coefficients) -> Column:
    """Value of a polynomial given constant term first."""
    out = F.lit(float(coefficients[-1]))
    for c in reversed(coefficients[:-1]):
        out = out * x + F.lit(float(c))
    return out


def curve_value(season: Column, weekend: Column, x: Column) -> Column:
    out = F.lit(None).cast("double")
    for (name, part), coefficients in RUNTIME_CURVES.items():
        here = (season == name) & (weekend if part == "weekend" else ~weekend)
        out = F.when(here, polynomial(x, coefficients)).otherwise(out)
    return out


def degree_days(climate: DataFrame, forecast: DataFrame) -> DataFrame:
    """A forecast replaces the long-term mean of its day of year."""
    ahead = forecast.select(F.dayofyear("forecast_date").alias("doy"), "hdd")
    return climate.join(ahead, "doy", "left").select(
        "doy", F.coalesce("hdd", F.round("hdd_avg", 0).cast("int")).alias("hdd"))


def predicted_runtime(hdd: DataFrame, as_of: str, days: int = 365) -> DataFrame:
    """Predicted minutes for today and the next ``days`` days, where degree days are known."""
    today = F.lit(as_of[:10]).cast("date")
    bounds = hdd.sparkSession.range(1).select(today.alias("lo"), F.date_add(today, days).alias("hi"))
    d = F.col("date")
    ahead = spine(bounds, "lo", "hi", "1 DAY", "date").withColumn("doy", F.dayofyear(d))
    season, weekend = meteorological_season(F.col("doy")), dow(d).isin(0, 6)
    return ahead.join(hdd, "doy").select(
        "date", "doy", curve_value(season, weekend, F.col("hdd").cast("double")).alias("predicted_runtime"))


def month_projection(predicted: DataFrame, stored: DataFrame, as_of: str) -> DataFrame:
    """Runtime of this month at the end of each coming day.

    Without a stored hour today there is nothing to start from and the result is empty.
    """
    now = F.lit(as_of).cast("timestamp_ntz")
    today = F.to_date(now)
    this_day = F.col("sum_date") == today
    # today's and this month's sums in one pass over the rollup; null where absent
    so_far = stored.agg(
        F.sum(F.when(this_day, F.col("runtime"))).cast("double").alias("day"),
        F.sum(F.when(F.trunc("sum_date", "month") == F.trunc(today, "month"), F.col("runtime")))
        .cast("double").alias("month"),
    )
    day_run, month_run = so_far.select("day").scalar(), so_far.select("month").scalar()
    left = 1 - F.hour(now) / F.lit(24.0)
    ahead = predicted.where(F.col("date") < F.add_months(F.trunc(today, "month"), 1))
    ahead = cumulative(ahead, ["date"], "predicted_runtime", "total")
    ahead = ahead.withColumns({"_day": day_run, "_month": month_run}).where(F.col("_day").isNotNull())
    best = F.greatest(F.col("_day") + F.col("total") * left, F.col("total"))
    return ahead.select(
        F.timestamp_add("SECOND", F.lit(86399), F.col("date").cast("timestamp_ntz")).alias("timestamp"),
        (best - F.col("_day") + F.col("_month")).alias("runtime"))


def prediction_log(log: DataFrame | None, projection: DataFrame, as_of: str) -> DataFrame:
    """Adds one snapshot of the projection, keyed by its run time."""
    new = projection.select(
        F.lit(as_of).cast("timestamp_ntz").alias("prediction_rundate"),
        F.col("timestamp").alias("predicted_timestamp"), F.col("runtime").alias("predicted_runtime"))
    return new if log is None else log.unionByName(new)


def cumulative_averages(mdh: DataFrame, as_of: str) -> DataFrame:
    """Mean (month, day, hour) sums laid on the hours of the current year, running per month and year."""
    year = int(as_of[:4])
    one = mdh.sparkSession.range(1).select(
        F.lit(f"{year}-01-01 00:00:00").cast("timestamp_ntz").alias("lo"),
        F.lit(f"{year}-12-31 23:00:00").cast("timestamp_ntz").alias("hi"))
    hours = spine(one, "lo", "hi", "1 HOUR", "timestamp").withColumns({
        "month": F.month("timestamp"), "day": F.dayofmonth("timestamp"), "hour": F.hour("timestamp")})
    # decimals, so that a running total does not depend on how it is added up
    mdh = mdh.withColumn("runtime_avg", F.col("runtime_avg").cast("decimal(20,8)"))
    x = hours.join(mdh, ["month", "day", "hour"])
    x = cumulative(x, ["month", "day", "hour"], "runtime_avg", "monthly_cum_avg_runtime", ["month"])
    x = cumulative(x, ["month", "day", "hour"], "runtime_avg", "cum_avg_runtime")
    return x.select("timestamp", *[
        F.col(c).cast("double").alias(c) for c in ("monthly_cum_avg_runtime", "cum_avg_runtime")])
