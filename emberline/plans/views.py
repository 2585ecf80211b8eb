"""The rollups, baselines and reports as temporary views, for those who work in SQL."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from emberline.functions.calendar import ntz
from emberline.operators import rollups
from emberline.plans import charts, forecast, inventory


@dataclass(frozen=True)
class Inputs:
    """Hourly sums closed (``stored``) and with the open hour (``hourly``), deliveries, weather, clock."""

    stored: DataFrame
    hourly: DataFrame
    deliveries: DataFrame
    climate: DataFrame
    forecast: DataFrame
    as_of: str


def views(x: Inputs) -> dict[str, DataFrame]:
    """Every view by name; nothing runs until one is read."""
    spark, as_of = x.hourly.sparkSession, x.as_of
    hdd = forecast.degree_days(x.climate, x.forecast)
    predicted = forecast.predicted_runtime(hdd, as_of)
    mdh = rollups.with_mean(rollups.by_month_day_hour(x.hourly))
    averages = forecast.cumulative_averages(mdh, as_of)
    projection = forecast.month_projection(predicted, x.stored, as_of)
    daily = rollups.daily_sums(x.stored)
    mean = rollups.with_mean
    out = {
        "sums_hourly": x.hourly,
        "sums_daily": daily,
        "sums_monthly": rollups.monthly_sums(x.stored),
        "sums_yearly": rollups.yearly_sums(x.stored),
        "baseline_dow": mean(rollups.by_dow_season(daily, spark)),
        "baseline_doy": mean(rollups.by_month_day(daily)),
        "baseline_hourly": mean(rollups.by_dow_season_hour(x.hourly, spark)),
        "baseline_monthly": mean(rollups.by_month(rollups.monthly_sums(x.stored), ntz(as_of))),
        "degree_days": hdd,
        "predicted_runtime": predicted,
        "predicted_this_month": projection,
        "cumulative_averages": averages,
        "remaining_fuel": inventory.remaining_fuel(x.deliveries, x.hourly, predicted, as_of),
        "tank_level": inventory.tank_level(x.deliveries, x.hourly, as_of),
        "plot_daily": charts.daily_vs_last_year(x.hourly),
        "plot_dow": charts.week_vs_usual(x.hourly, x.stored, False),
        "plot_dow_season": charts.week_vs_usual(x.hourly, x.stored, True),
        "plot_monthly": charts.year_vs_usual(x.hourly, x.stored, as_of),
        "plot_yearly": charts.years(x.hourly, as_of),
        "plot_year_to_year": charts.year_curves(x.stored, averages, as_of),
        "plot_month_to_month": charts.month_curves(x.hourly, averages, projection, int(as_of[5:7])),
    }
    for name, by_dow, by_season in (
        ("plot_hourly", False, False), ("plot_hourly_dow", True, False),
        ("plot_hourly_season", False, True), ("plot_hourly_dow_season", True, True),
    ):
        out[name] = charts.day_vs_usual(x.hourly, as_of, by_dow, by_season)
    return out


def register(x: Inputs) -> list[str]:
    """Creates or replaces the views in the session of the inputs."""
    made = views(x)
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return sorted(made)
