"""Daily statistics, forecast, inventory, live state and weather reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.aggregates import FIXED_COLS, fixed_sql
from emberline.catalog.charts import PROJECTION, projection
from emberline.catalog.joins import ACTIVE
from emberline.catalog.registry import (
    BTU, DEGREES, DELIVERIES, EV, GAL, PREDICTED, THR, order_hours, query, run_totals,
)
from emberline.catalog.windows import REMAINING
from emberline.operators import rollups
from emberline.plans import charts, daily, forecast, inventory, weather
from emberline.sources import fixtures as fx
from emberline.sources.files import table

_ONE = "CAST(CAST(round(CAST({x} AS DECIMAL(30,8)), 1) AS DECIMAL(30,1)) AS VARCHAR)"


def _one(x):
    return _ONE.format(x=x)


_HI = "(SELECT * FROM (WITH " + run_totals("hi", period="day") + " SELECT * FROM tot))"
_LO = "(SELECT * FROM (WITH " + run_totals("lo", period="day", cap=False) + " SELECT * FROM tot))"


@query("rpt_boiler_daily", f"""
WITH {EV}, {ACTIVE},
b AS (SELECT h.key, CAST(h.period_start AS DATE) AS date, coalesce(h.us * {BTU} / 3.6e9, 0) AS btu, coalesce(h.us * {GAL} / 3.6e9, 0) AS gallons,
             coalesce(h.w_us / 3.6e12, 0) AS kwh, h.cycles, coalesce(h.us / 6e7, 0) AS tr, coalesce(h.us / 6e7 / h.timed, 0) AS ar,
             coalesce(h.min_us / 6e7, 0) AS mn, coalesce(h.max_us / 6e7, 0) AS mx, l.cycles AS low_cycles,
             coalesce(l.us / 6e7, 0) AS ltr, coalesce(l.us / 6e7 / l.timed, 0) AS lar,
             coalesce(l.min_us / 6e7, 0) AS lmn, coalesce(l.max_us / 6e7, 0) AS lmx
      FROM {_HI} h JOIN {_LO} l ON h.key = l.key AND h.period_start = l.period_start)
SELECT b.key, b.date, round(btu, 2) AS btu, round(gallons, 2) AS gallons, round(kwh, 2) AS kwh, cycles,
  round(tr, 2) AS total_runtime, round(ar, 2) AS avg_runtime, round(mn, 2) AS min_runtime, round(mx, 2) AS max_runtime,
  low_cycles, round(ltr, 2) AS low_total_runtime, round(lar, 2) AS low_avg_runtime, round(lmn, 2) AS low_min_runtime, round(lmx, 2) AS low_max_runtime,
  'Boiler: ' || {_one('tr / 60')} || 'h, ' || cycles || ' cycles, mean of ' || {_one('ar')} || ' min/cycle. Circulator: '
  || {_one('ltr / 60')} || 'h, ' || low_cycles || ' cycles, mean of ' || {_one('lar')} || ' min/cycle. '
  || CAST(CAST(round(CAST(btu AS DECIMAL(30,8)), 0) AS DECIMAL(30,0)) AS VARCHAR) || ' btu, ' || {_one('gallons')} || ' gal, ' || {_one('kwh')} || ' kwh.' AS status_line
FROM b JOIN act ON act.key = b.key AND act.date = b.date""")
def rpt_boiler_daily(spark, sf):
    return daily.heating_daily(
        fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark), fx.KEY, fx.E_START, fx.E_END)


_DAILY_K = """wx AS (SELECT CAST(ts AS DATE) AS date, sum(CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT)) AS k, count(*) AS n FROM events GROUP BY 1)"""


@query("rpt_dehumidifier_daily", f"""
WITH {fixed_sql(40, True, by='key, date')}, {ACTIVE}, {_DAILY_K},
s AS (SELECT key, date, {FIXED_COLS} FROM f5)
SELECT s.*, 'Dehumidifier: total runtime ' || {_one('coalesce(total_hours, 0)')} || ' hours, ' || cycles || ' cycles, mean of '
  || {_one('coalesce(avg_minutes, 0)')} || ' minutes per cycle. The mean temp was ' || k % 80 || ' and the mean dewpoint was ' || k % 50 || '.' AS status_line
FROM s JOIN act ON act.key = s.key AND act.date = s.date LEFT JOIN wx ON wx.date = s.date""")
def rpt_dehumidifier_daily(spark, sf):
    w = weather.ingest(fx.weather_documents(spark, sf)).select("date", "mean_temperature", "mean_dewpoint")
    return daily.drying_daily(fx.readings(spark, sf), fx.status_log(spark, sf), w, fx.KEY, limit=40)


@query("rpt_degree_days", f"WITH {DEGREES} SELECT doy, hdd FROM hdd")
def rpt_degree_days(spark, sf):
    return forecast.degree_days(fx.climatology(spark, sf), fx.forecast(spark, sf))


def predicted(spark, sf):
    return forecast.predicted_runtime(rpt_degree_days(spark, sf), fx.O_AS_OF)


@query("rpt_predicted_runtime", f"WITH {PREDICTED} SELECT date, doy, round(predicted_runtime, 6) AS predicted_runtime FROM pr")
def rpt_predicted_runtime(spark, sf):
    return predicted(spark, sf).withColumn("predicted_runtime", F.round("predicted_runtime", 6))


_PJ = f"WITH {PREDICTED}, {order_hours(live=False, name='st')}, {PROJECTION}"


@query("rpt_predicted_month", f"{_PJ} SELECT timestamp, round(runtime, 4) AS runtime FROM pj")
def rpt_predicted_month(spark, sf):
    return projection(spark, sf).withColumn("runtime", F.round("runtime", 4))


@query("rpt_prediction_log", f"""{_PJ}
SELECT TIMESTAMP '2001-07-15 12:00:00' AS prediction_rundate, timestamp AS predicted_timestamp, round(runtime, 4) AS predicted_runtime FROM pj
UNION ALL SELECT TIMESTAMP '2001-07-15 13:00:00', timestamp, round(runtime, 4) FROM pj""")
def rpt_prediction_log(spark, sf):
    p = projection(spark, sf).withColumn("runtime", F.round("runtime", 4))
    log = forecast.prediction_log(None, p, fx.O_AS_OF)
    return forecast.prediction_log(log, p, "2001-07-15 13:00:00")


@query("rpt_remaining_fuel", f"""
WITH {PREDICTED}, {DELIVERIES}, {order_hours()}, {REMAINING},
b AS (SELECT date, (SELECT g FROM rem) - sum(predicted_runtime / 60 * 0.666205227383988e0) OVER (ORDER BY date) AS g FROM pr),
w AS (SELECT max(date) FILTER (WHERE NOT g < 65) AS low_date, max(date) FILTER (WHERE NOT g < 0) AS empty_date,
             coalesce(bool_or(g < 65), false) AS low_reached, coalesce(bool_or(g < 0), false) AS empty_reached FROM b)
SELECT round(rem.g, 4) AS remaining_gallons, round(rem.g / 260 * 100, 2) AS tank_level, low_date,
       CAST(low_date - DATE '2001-07-15' AS INTEGER) AS low_days, empty_date, CAST(empty_date - DATE '2001-07-15' AS INTEGER) AS empty_days,
       low_reached, empty_reached FROM rem, w""")
def rpt_remaining_fuel(spark, sf):
    r = inventory.remaining_fuel(
        fx.deliveries(spark, sf), fx.order_hours(spark, sf), predicted(spark, sf), fx.O_AS_OF)
    return r.withColumn("remaining_gallons", F.round("remaining_gallons", 4))


@query("rpt_tank_level", f"""
WITH {DELIVERIES}, {order_hours()},
s AS (SELECT unnest(generate_series(CAST(min(delivery_date) AS TIMESTAMP) - INTERVAL 1 HOUR, TIMESTAMP '2001-07-15 12:00:00', INTERVAL 1 HOUR)) AS t FROM dl),
x AS (SELECT t, coalesce(dl.gc, CASE WHEN t = (SELECT min(t) FROM s) THEN 3150 ELSE 0 END) AS a, coalesce(oh.rc, 0) AS u
      FROM s LEFT JOIN dl ON CAST(dl.delivery_date AS TIMESTAMP) = t
      LEFT JOIN oh ON oh.sum_date = CAST(t AS DATE) AND oh.hour = hour(t))
SELECT CAST(t AS TIMESTAMP) AS timestamp,
       round(sum(a) OVER (ORDER BY t) / 100e0 - sum(u) OVER (ORDER BY t) / 100e0 / 60 * 0.666205227383988e0, 4) AS tank_level FROM x""")
def rpt_tank_level(spark, sf):
    t = inventory.tank_level(fx.deliveries(spark, sf), fx.order_hours(spark, sf), fx.O_AS_OF)
    return t.withColumn("tank_level", F.round("tank_level", 4))


def _is_on(name, which):
    @query(f"rpt_is_on_{which}", f"""
WITH {EV}, {THR}, t AS (SELECT {which} AS x FROM thr ORDER BY change_time DESC LIMIT 1)
SELECT key, arg_max(watts, ROW(ts, tie)) >= (SELECT x FROM t) AS is_on FROM ev GROUP BY key""")
    def report(spark, sf):
        last = rollups.newest_reading(fx.readings(spark, sf), fx.KEY)
        limit = rollups.latest(fx.thresholds(spark), ["change_time"], 1).select(which)
        return last.select("key", (F.col("watts") >= limit.scalar()).alias("is_on"))

    return report


_is_on("boiler", "hi")
_is_on("circulator", "lo")


@query("rpt_daylight", """
WITH h AS (SELECT CAST(ts AS DATE) AS sum_date, hour(ts) AS hour FROM events GROUP BY 1, 2),
sky AS (SELECT DISTINCT sum_date AS d, TIMESTAMP '2000-01-01 07:05:00' + to_minutes(CAST(dayofyear(sum_date) % 60 AS INTEGER)) AS r,
               TIMESTAMP '2000-01-01 16:40:00' + to_minutes(CAST(dayofyear(sum_date) % 60 AS INTEGER)) AS s FROM h)
SELECT h.sum_date, h.hour, strftime(CASE WHEN hour(a.r) > h.hour THEN b.r ELSE a.r END, '%H:%M:%S') AS sunrise,
       strftime(CASE WHEN hour(a.s) > h.hour THEN b.s ELSE a.s END, '%H:%M:%S') AS sunset
FROM h JOIN sky a ON a.d = h.sum_date LEFT JOIN sky b ON b.d = h.sum_date - 1""")
def rpt_daylight(spark, sf):
    e = table(spark, sf, "events")
    hours = e.select(F.to_date("ts").alias("sum_date"), F.hour("ts").alias("hour")).distinct()
    sky = fx.astronomy(hours.select(F.col("sum_date").alias("date")).distinct())
    return charts.daylight_markers(hours, sky)


@query("rpt_weather_ingest", f"""
WITH {_DAILY_K}
SELECT row_number() OVER (ORDER BY date) AS id, date, CAST(n % 40 AS INTEGER) AS hdd, CAST(k % 50 AS INTEGER) AS mean_dewpoint,
       29 + (n % 100) / 100e0 AS mean_pressure, CAST(k % 80 AS INTEGER) AS mean_temperature, CAST(n % 10 AS INTEGER) AS mean_visibility,
       CAST(k % 360 AS INTEGER) AS mean_wind_direction, CAST(n % 25 AS INTEGER) AS mean_wind_speed FROM wx""")
def rpt_weather_ingest(spark, sf):
    w = weather.ingest(fx.weather_documents(spark, sf))
    return w.withColumn("mean_pressure", F.col("mean_pressure").cast("double"))
