"""Run sums, rollups, baselines and completeness."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.filters import FILLED, GAPS, MODE, filled, with_gaps
from emberline.catalog.registry import (
    BTU, DELIVERIES, EV, GAL, order_hours, query, run_totals, season,
)
from emberline.functions import energy
from emberline.functions.calendar import ntz, period_start
from emberline.operators import model, quality, rollups, runs
from emberline.operators.states import fixed_state, furnace_mode
from emberline.plans import charts
from emberline.sources import fixtures as fx


def feed(spark, sf):
    return fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark), fx.KEY


def totals_sql(prefix: str, fuel: bool = True) -> str:
    heat = (f"coalesce(us * {BTU} / 3.6e9, 0) AS btu, coalesce(us * {GAL} / 3.6e9, 0) AS gallons, "
            "coalesce(w_us / 3.6e12, 0) AS kwh, ") if fuel else ""
    return (f"SELECT {prefix}{heat}cycles, coalesce(us / 6e7, 0) AS total_runtime, "
            "coalesce(us / 6e7 / timed, 0) AS avg_runtime, coalesce(min_us / 6e7, 0) AS min_runtime, "
            "coalesce(max_us / 6e7, 0) AS max_runtime FROM tot")


FIGURES = ("cycles", "total_runtime", "avg_runtime", "min_runtime", "max_runtime")


@query("run_sums", f"""
WITH {run_totals('hi')}
SELECT key, run_id, system_status, us / 6e7 AS runtime, CAST(w_us AS DOUBLE) / 3.6e12 AS kwh,
       coalesce(round(CASE WHEN system_status = 'boiler' THEN us * (140000e0 * 0.666205227383988e0) / 3.6e9 END, 6), 0) AS btu,
       coalesce(round(CASE WHEN system_status = 'boiler' THEN us * 0.666205227383988e0 / 3.6e9 END, 9), 0) AS gallons FROM r""")
def run_sums(spark, sf):
    c = runs.classify_runs(*feed(spark, sf), "hi", fx.E_START, fx.E_END)
    return runs.with_fuel(runs.run_sums(c, fx.KEY), "boiler").select(
        "key", "run_id", "system_status", (F.col("run_us") / 6e7).alias("runtime"),
        (F.col("w_us").cast("double") / 3.6e12).alias("kwh"), F.round("btu", 6).alias("btu"), F.round("gallons", 9).alias("gallons"))


@query("run_summary", f"WITH {run_totals('hi')} {totals_sql('key, ')}")
def run_summary(spark, sf):
    return runs.summary(*feed(spark, sf), "hi", fx.E_START, fx.E_END).drop("run_us")


@query("run_summary_chunked", f"WITH {run_totals('hi')} {totals_sql('key, ')}")
def run_summary_chunked(spark, sf):
    return runs.summary(*feed(spark, sf), "hi", fx.E_START, fx.E_END, seconds=86400).drop("run_us")


@query("run_summary_hourly", f"WITH {run_totals('hi', period='hour')} {totals_sql('key, period_start, ')}")
def run_summary_hourly(spark, sf):
    return runs.summary(*feed(spark, sf), "hi", fx.E_START, fx.E_END, "hour").drop("run_us")


@query("run_summary_uncapped", f"WITH {run_totals('lo', cap=False)} {totals_sql('key, ', fuel=False)}")
def run_summary_uncapped(spark, sf):
    return runs.summary(*feed(spark, sf), "lo", fx.E_START, fx.E_END).select("key", *FIGURES)


def fixed_sql(limit: int, smooth: bool, by: str = "key", gap: str = "PARTITION BY key") -> str:
    state = (f"CASE WHEN raw = 'OFF' AND lag(raw) OVER w = 'ON' AND lead(raw) OVER w = 'ON' THEN 'ON' ELSE raw END"
             if smooth else "raw")
    return f"""{EV},
f0 AS (SELECT *, CAST(ts AS DATE) AS date, CASE WHEN watts > {limit} THEN 'ON' ELSE 'OFF' END AS raw,
              epoch_us(ts) - epoch_us(lag(ts) OVER ({gap} ORDER BY ts, tie)) AS gap_us FROM ev),
f1 AS (SELECT *, {state} AS status FROM f0 WINDOW w AS (PARTITION BY {by} ORDER BY ts, tie)),
f2 AS (SELECT *, CASE WHEN status = 'ON' AND lag(status) OVER (PARTITION BY {by} ORDER BY ts, tie) = 'OFF' THEN 1 ELSE 0 END AS edge FROM f1),
f3 AS (SELECT *, CASE WHEN status = 'ON' THEN sum(edge) OVER (PARTITION BY {by} ORDER BY ts, tie) END AS run_id FROM f2),
f4 AS (SELECT {by}, run_id, status, CAST(sum(gap_us) AS BIGINT) AS us, CAST(sum(watts * gap_us) AS DOUBLE) AS w_us FROM f3 GROUP BY ALL),
f5 AS (SELECT {by}, sum(w_us) AS w_us, sum(us) FILTER (WHERE status = 'ON') AS us,
              CAST(count(us) FILTER (WHERE status = 'ON') AS INTEGER) AS cycles,
              min(us) FILTER (WHERE status = 'ON') AS lo, max(us) FILTER (WHERE status = 'ON') AS hi FROM f4 GROUP BY ALL)"""


FIXED_COLS = """round(w_us / 3.6e12, 2) AS kwh, round(us / 6e7 / 60, 2) AS total_hours, round(us / 6e7 / cycles, 2) AS avg_minutes,
  round(lo / 6e7, 2) AS min_minutes, round(hi / 6e7, 2) AS max_minutes, cycles"""


@query("run_summary_fixed", f"WITH {fixed_sql(50, True)} SELECT key, {FIXED_COLS} FROM f5")
def run_summary_fixed(spark, sf):
    r = runs.fixed_runs(fx.readings(spark, sf), fx.KEY, fixed_state(F.col("watts"), 50), smooth=True)
    return runs.cycle_stats(runs.run_sums(r, fx.KEY, cap=False), fx.KEY)


@query("cycle_stats", f"WITH {fixed_sql(49, False)} SELECT key, {FIXED_COLS.split('AS kwh,')[1]} FROM f5")
def cycle_stats(spark, sf):
    r = runs.fixed_runs(fx.readings(spark, sf), fx.KEY, fixed_state(F.col("watts"), 49))
    return runs.cycle_stats(runs.run_sums(r, fx.KEY, cap=False), fx.KEY).drop("kwh")


def _plain(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols or ("runtime",)})


@query("sums_daily", f"""
WITH {order_hours(live=False)}
SELECT sum_date, CAST(dayofweek(sum_date) AS INTEGER) AS dow, sum(rc) / 100e0 AS runtime FROM oh GROUP BY 1""")
def sums_daily(spark, sf):
    return _plain(rollups.daily_sums(fx.order_hours(spark, sf, live=False)))


@query("sums_monthly", f"""
WITH {order_hours(live=False)}
SELECT year(sum_date) AS year, month(sum_date) AS month, sum(rc) / 100e0 AS runtime FROM oh GROUP BY 1, 2""")
def sums_monthly(spark, sf):
    return _plain(rollups.monthly_sums(fx.order_hours(spark, sf, live=False)))


@query("sums_yearly", f"""
WITH {order_hours(live=False)} SELECT year(sum_date) AS year, sum(rc) / 100e0 AS runtime FROM oh GROUP BY 1""")
def sums_yearly(spark, sf):
    return _plain(rollups.yearly_sums(fx.order_hours(spark, sf, live=False)))


DAILY = "d AS (SELECT sum_date, sum(rc) AS rc FROM oh GROUP BY 1)"
MEAN = "sum(rc) / 100e0 / count(*) AS runtime_avg, count(*) AS count"
# sums kept beside the mean: means weighted by count are the merged sums over the merged counts
SUMS = "sum(rc) AS s, count(*) AS n"
WEIGHTED = "sum(s) / 100e0 / sum(n)"


@query("base_dow", f"""
WITH {order_hours(live=False)}, {DAILY}
SELECT dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season, {MEAN} FROM d GROUP BY 1, 2""")
def base_dow(spark, sf):
    return rollups.with_mean(rollups.by_dow_season(rollups.daily_sums(fx.order_hours(spark, sf, live=False)), spark))


@query("base_doy", f"""
WITH {order_hours(live=False)}, {DAILY}
SELECT month(sum_date) AS month, day(sum_date) AS day, {MEAN} FROM d GROUP BY 1, 2""")
def base_doy(spark, sf):
    return rollups.with_mean(rollups.by_month_day(rollups.daily_sums(fx.order_hours(spark, sf, live=False))))


@query("base_hourly", f"""
WITH {order_hours()}
SELECT dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season, hour, {MEAN} FROM oh GROUP BY 1, 2, 3""")
def base_hourly(spark, sf):
    return rollups.with_mean(rollups.by_dow_season_hour(fx.order_hours(spark, sf), spark))


MONTHLY = "m AS (SELECT year(sum_date) AS y, month(sum_date) AS month, sum(rc) AS rc FROM oh GROUP BY 1, 2)"


@query("base_monthly", f"""
WITH {order_hours(live=False)}, {MONTHLY}
SELECT month, sum(rc) FILTER (WHERE y <> 2001 OR month <> 7) / 100e0 / count(*) FILTER (WHERE y <> 2001 OR month <> 7) AS runtime_avg,
       count(*) FILTER (WHERE y <> 2001 OR month <> 7) AS count
FROM m GROUP BY 1""")
def base_monthly(spark, sf):
    m = rollups.monthly_sums(fx.order_hours(spark, sf, live=False))
    return rollups.with_mean(rollups.by_month(m, ntz(fx.O_AS_OF)))


@query("weighted_mean", f"""
WITH {order_hours(live=False)}, {DAILY},
b AS (SELECT dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season, {SUMS} FROM d GROUP BY 1, 2)
SELECT dow, {WEIGHTED} AS runtime_avg FROM b GROUP BY 1""")
def weighted_mean(spark, sf):
    b = rollups.by_dow_season(rollups.daily_sums(fx.order_hours(spark, sf, live=False)), spark)
    return rollups.weighted_mean(b, ["dow"])


@query("base_mdh", f"""
WITH {order_hours()}
SELECT month(sum_date) AS month, day(sum_date) AS day, hour, {MEAN} FROM oh GROUP BY 1, 2, 3""")
def base_mdh(spark, sf):
    return rollups.with_mean(rollups.by_month_day_hour(fx.order_hours(spark, sf)))


@query("running_mean_merge", f"""
WITH {order_hours()}
SELECT hour, dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season, {MEAN} FROM oh GROUP BY 1, 2, 3""")
def running_mean_merge(spark, sf):
    h = fx.order_hours(spark, sf)
    cut = F.col("sum_date") < F.lit("2000-01-01").cast("date")
    old, new = (rollups.by_dow_season_hour(h.where(c), spark) for c in (cut, ~cut))
    return rollups.with_mean(rollups.merge_baselines(old, new, ["hour", "dow", "season"]))


def _periods(spark, sf, period):
    return with_gaps(spark, sf).withColumn("period_start", period_start(period, F.col("ts")))


@query("complete_any_gap", f"""
WITH {GAPS}
SELECT key, date_trunc('day', ts) AS period_start,
       CASE WHEN coalesce(bool_or(gap_us >= 300000000 AND gap_us * watts > 0), false) THEN 'no' ELSE 'yes' END AS complete
FROM gp GROUP BY 1, 2""")
def complete_any_gap(spark, sf):
    return quality.complete_any_gap(_periods(spark, sf, "day"), ["key", "period_start"])


@query("complete_max_gap", f"""
WITH {GAPS}
SELECT key, date_trunc('hour', ts) AS period_start, CASE WHEN max(gap_us) < 300000000 THEN 'yes' ELSE 'no' END AS complete
FROM gp GROUP BY 1, 2""")
def complete_max_gap(spark, sf):
    return quality.complete_max_gap(_periods(spark, sf, "hour"), ["key", "period_start"])


@query("complete_coverage", f"""
WITH {GAPS}
SELECT key, date_trunc('month', ts) AS period_start,
       CASE WHEN day(min(ts)) = 1 AND day(max(ts)) = day(last_day(max(ts))) AND max(gap_us) < 300000000 THEN 'yes' ELSE 'no' END AS complete
FROM gp GROUP BY 1, 2""")
def complete_coverage(spark, sf):
    return quality.complete_coverage(_periods(spark, sf, "month"), ["key", "period_start"], "month")


@query("distinct_on", f"""
WITH {DELIVERIES} SELECT DISTINCT ON (fill) fill, delivery_date, gc / 100e0 AS gallons FROM dl ORDER BY fill, delivery_date DESC""")
def distinct_on(spark, sf):
    d = fx.deliveries(spark, sf).groupBy("fill").agg(F.max_by(F.struct("delivery_date", "gallons"), "delivery_date").alias("n"))
    return d.select("fill", "n.delivery_date", F.col("n.gallons").cast("double").alias("gallons"))


@query("prior_ytd", f"""
WITH {order_hours()}
SELECT 2001 AS year, sum(rc) / 100e0 + 0 AS runtime FROM oh WHERE year(sum_date) = 2000 AND sum_date <= DATE '2000-07-15'""")
def prior_ytd(spark, sf):
    return charts.prior_year_to_date(fx.order_hours(spark, sf), fx.O_AS_OF, charts.BACKFILL_MINUTES)


@query("range_total", f"""
WITH {FILLED}, m AS (SELECT *, {MODE} AS mode FROM fl)
SELECT round(sum(least(greatest(CAST(watts AS DOUBLE), 40), 100) / 100 * 60000 * (gap_us / 3.6e9)) FILTER (WHERE mode = 'ON'), 3) AS btu FROM m""")
def range_total(spark, sf):
    x = filled(spark, sf)
    x = x.withColumn("status", furnace_mode(F.col("status"), F.col("watts"), F.col("gap_us") / 1e6))
    level = model.clamp_mask(F.col("watts").cast("double"), F.col("status"))
    return x.agg(F.round(energy.exact_sum(model.heat(level, F.col("gap_us"), F.col("status"))), 3).alias("btu"))
