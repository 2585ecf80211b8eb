"""Chart reports: now against usual, against last year, and cumulative curves."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.aggregates import DAILY, SUMS, WEIGHTED
from emberline.catalog.registry import PREDICTED, event_hours, order_hours, query, season
from emberline.functions.calendar import ntz
from emberline.operators import rollups
from emberline.plans import charts, forecast
from emberline.session import scratch_path
from emberline.sources import fixtures as fx
from emberline.streaming import rollup

_DAILY_SQL = f"""
WITH {order_hours()}, {DAILY}, u AS (SELECT sum_date, rc / 100e0 AS runtime, row_number() OVER (ORDER BY sum_date DESC) AS row_number FROM d)
SELECT u.sum_date, strftime(u.sum_date, '%b') || ' - ' || strftime(u.sum_date, '%d') AS label, u.runtime,
       p.runtime AS previous_year, 'yes' AS complete, u.row_number
FROM u LEFT JOIN u p ON CAST(u.sum_date - INTERVAL 1 YEAR AS DATE) = p.sum_date"""


@query("rpt_daily", _DAILY_SQL + " WHERE u.row_number < 31")
def rpt_daily(spark, sf):
    return charts.daily_vs_last_year(fx.order_hours(spark, sf), 30)


@query("rpt_daily_1year", _DAILY_SQL + " WHERE u.row_number < 366")
def rpt_daily_1year(spark, sf):
    return charts.daily_vs_last_year(fx.order_hours(spark, sf), 365)


@query("rpt_daily_stored", _DAILY_SQL + " WHERE u.row_number < 31")
def rpt_daily_stored(spark, sf):
    """The same chart from a stored rollup that three batches of orders have kept current; the second comes twice."""
    at = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.to_date("o_orderdate").cast("timestamp_ntz"))
    orders = fx.table(spark, sf, "orders").withColumn("ts", at).where(F.col("ts") <= ntz(fx.O_AS_OF))
    path = scratch_path(spark, "stored-hours")
    for number in (0, 1, 1, 2):
        rollup.add_batch(path, orders.where(F.col("o_custkey") % 3 == number), number, "ts", fx.order_minutes())
    return charts.daily_vs_last_year(rollup.stored_hours(spark, path), 30)


_KEYED = order_hours().replace("SELECT CAST(o_orderdate", "SELECT o_custkey AS key, CAST(o_orderdate")


@query("rpt_daily_by_device", f"""
WITH {_KEYED}, d AS (SELECT key, sum_date, sum(rc) AS rc FROM oh GROUP BY 1, 2),
u AS (SELECT key, sum_date, rc / 100e0 AS runtime, row_number() OVER (PARTITION BY key ORDER BY sum_date DESC) AS row_number FROM d)
SELECT u.key, u.sum_date, strftime(u.sum_date, '%b') || ' - ' || strftime(u.sum_date, '%d') AS label, u.runtime,
       p.runtime AS previous_year, 'yes' AS complete, u.row_number
FROM u LEFT JOIN u p ON u.key = p.key AND CAST(u.sum_date - INTERVAL 1 YEAR AS DATE) = p.sum_date WHERE u.row_number < 31""")
def rpt_daily_by_device(spark, sf):
    return charts.daily_vs_last_year(fx.order_hours(spark, sf, keys=fx.KEY), 30, fx.KEY)


@query("rpt_hourly_by_device", f"""
WITH {event_hours().replace("SELECT CAST(ts", "SELECT user_id AS key, CAST(ts")},
b AS (SELECT key, hour, {SUMS} FROM hh GROUP BY 1, 2),
u AS (SELECT * FROM hh QUALIFY row_number() OVER (PARTITION BY key ORDER BY sum_date DESC, hour DESC) <= 24)
SELECT u.key, u.sum_date, u.hour AS label, u.rc / 100e0 AS runtime, s / 100e0 / n AS runtime_avg, 'yes' AS complete
FROM u JOIN b ON b.key = u.key AND b.hour = u.hour""")
def rpt_hourly_by_device(spark, sf):
    return charts.day_vs_usual(fx.event_hours(spark, sf, keys=fx.KEY), fx.H_AS_OF, keys=fx.KEY)


def _week_sql(by_season):
    on = "AND b.season = u.season" if by_season else ""
    return f"""
WITH {order_hours()}, {order_hours(live=False, name='st')}, {DAILY},
sd AS (SELECT sum_date, sum(rc) AS rc FROM st GROUP BY 1),
b AS (SELECT dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season, {SUMS} FROM sd GROUP BY 1, 2),
u AS (SELECT sum_date, rc, {season('month(sum_date)')} AS season FROM d ORDER BY sum_date DESC LIMIT 7)
SELECT u.sum_date, strftime(u.sum_date, '%A') AS label, rc / 100e0 AS runtime,
       {WEIGHTED} AS runtime_avg, 'yes' AS complete
FROM u JOIN b ON b.dow = dayofweek(u.sum_date) {on} GROUP BY u.sum_date, rc"""


def _week(spark, sf, by_season):
    return charts.week_vs_usual(fx.order_hours(spark, sf), fx.order_hours(spark, sf, live=False), by_season)


@query("rpt_dow", _week_sql(False))
def rpt_dow(spark, sf):
    return _week(spark, sf, False)


@query("rpt_dow_season", _week_sql(True))
def rpt_dow_season(spark, sf):
    return _week(spark, sf, True)


def _day_sql(by_dow, by_season):
    day = "CASE WHEN u.hour > 12 THEN DATE '2024-01-29' ELSE DATE '2024-01-30' END"
    on = (f" AND b.dow = dayofweek({day})" if by_dow else "") + (
        f" AND b.season = {season(f'month({day})')}" if by_season else "")
    return f"""
WITH {event_hours()},
b AS (SELECT dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season, hour, {SUMS} FROM hh GROUP BY 1, 2, 3),
u AS (SELECT * FROM hh ORDER BY sum_date DESC, hour DESC LIMIT 24)
SELECT u.sum_date, u.hour AS label, u.rc / 100e0 AS runtime,
       {WEIGHTED} AS runtime_avg, 'yes' AS complete
FROM u JOIN b ON b.hour = u.hour{on} GROUP BY u.sum_date, u.hour, u.rc"""


def _day(name, by_dow, by_season):
    @query(name, _day_sql(by_dow, by_season))
    def report(spark, sf):
        return charts.day_vs_usual(fx.event_hours(spark, sf), fx.H_AS_OF, by_dow, by_season)

    return report


rpt_hourly = _day("rpt_hourly", False, False)
rpt_hourly_dow = _day("rpt_hourly_dow", True, False)
rpt_hourly_season = _day("rpt_hourly_season", False, True)
rpt_hourly_dow_season = _day("rpt_hourly_dow_season", True, True)


@query("rpt_monthly", f"""
WITH {order_hours()}, {order_hours(live=False, name='st')},
sm AS (SELECT year(sum_date) AS y, month(sum_date) AS m, sum(rc) AS rc FROM st GROUP BY 1, 2),
b AS (SELECT m, sum(rc) / 100e0 / count(*) AS runtime_avg FROM sm WHERE y <> 2001 OR m <> 7 GROUP BY 1),
u AS (SELECT month(sum_date) AS m, sum(rc) AS rc, max(sum_date) AS last_day, row_number() OVER (ORDER BY max(sum_date) DESC) AS row_number
      FROM oh GROUP BY year(sum_date), month(sum_date))
SELECT strftime(last_day, '%b') AS label, rc / 100e0 / 60 AS runtime, b.runtime_avg / 60 AS runtime_avg, 'yes' AS complete, row_number
FROM u JOIN b USING (m) WHERE row_number <= 12""")
def rpt_monthly(spark, sf):
    return charts.year_vs_usual(fx.order_hours(spark, sf), fx.order_hours(spark, sf, live=False), fx.O_AS_OF)


@query("rpt_yearly", f"""
WITH {order_hours()}, p AS (SELECT sum(rc) / 100e0 / 60 AS r FROM oh WHERE year(sum_date) = 2000 AND sum_date <= DATE '2000-07-15')
SELECT year(sum_date) AS label, sum(rc) / 100e0 / 60 AS runtime,
       CASE WHEN year(sum_date) = 2001 THEN (SELECT r FROM p) END AS previous_yeartodate_runtime, 'yes' AS complete
FROM oh GROUP BY 1""")
def rpt_yearly(spark, sf):
    return charts.years(fx.order_hours(spark, sf), fx.O_AS_OF)


CUM_AVG = """mdh AS (SELECT month(sum_date) AS month, day(sum_date) AS day, hour, CAST(sum(rc) / 100e0 / count(*) AS DECIMAL(20,8)) AS a FROM oh GROUP BY 1, 2, 3),
ca AS (SELECT CAST(t AS TIMESTAMP) AS timestamp, CAST(sum(a) OVER (PARTITION BY mdh.month ORDER BY mdh.day, mdh.hour) AS DOUBLE) AS in_month,
              CAST(sum(a) OVER (ORDER BY mdh.month, mdh.day, mdh.hour) AS DOUBLE) AS in_year
       FROM generate_series(TIMESTAMP '2001-01-01 00:00:00', TIMESTAMP '2001-12-31 23:00:00', INTERVAL 1 HOUR) g(t)
       JOIN mdh ON mdh.month = month(t) AND mdh.day = day(t) AND mdh.hour = hour(t))"""


def averages(spark, sf):
    mdh = rollups.with_mean(rollups.by_month_day_hour(fx.order_hours(spark, sf)))
    return forecast.cumulative_averages(mdh, fx.O_AS_OF)


@query("rpt_cumulative_averages", f"""
WITH {order_hours()}, {CUM_AVG}
SELECT timestamp, in_month AS monthly_cum_avg_runtime, in_year AS cum_avg_runtime FROM ca""")
def rpt_cumulative_averages(spark, sf):
    return averages(spark, sf)


PROJECTION = """day AS (SELECT sum(rc) / 100e0 AS r FROM st WHERE sum_date = DATE '2001-07-15' HAVING count(*) > 0),
mon AS (SELECT sum(rc) / 100e0 AS r FROM st WHERE sum_date >= DATE '2001-07-01'),
cs AS (SELECT date, sum(predicted_runtime) OVER (ORDER BY date) AS s FROM pr WHERE date < DATE '2001-08-01'),
pj AS (SELECT CAST(date AS TIMESTAMP) + INTERVAL 86399 SECOND AS timestamp,
              greatest(day.r + s * (1 - 12 / 24e0), s) - day.r + mon.r AS runtime FROM cs, day, mon)"""


def projection(spark, sf):
    hdd = forecast.degree_days(fx.climatology(spark, sf), fx.forecast(spark, sf))
    return forecast.month_projection(
        forecast.predicted_runtime(hdd, fx.O_AS_OF), fx.order_hours(spark, sf, live=False), fx.O_AS_OF)


@query("rpt_month_to_month", f"""
WITH {order_hours()}, {order_hours(live=False, name='st')}, {PREDICTED}, {PROJECTION}, {CUM_AVG},
ms AS (SELECT 'measured ' || CAST(year(sum_date) AS VARCHAR) AS curve,
              CAST(sum_date AS TIMESTAMP) + to_hours(hour) + INTERVAL 3599 SECOND AS timestamp,
              sum(rc) OVER (PARTITION BY year(sum_date) ORDER BY day(sum_date), hour) / 100e0 / 60 AS hours
       FROM oh WHERE month(sum_date) = 7),
al AS (SELECT * FROM ms UNION ALL SELECT 'average', timestamp, in_month / 60 FROM ca WHERE month(timestamp) = 7
       UNION ALL (SELECT 'predicted', timestamp, hours FROM ms ORDER BY timestamp DESC LIMIT 1)
       UNION ALL SELECT 'predicted', timestamp, runtime / 60 FROM pj)
SELECT curve, timestamp, round(hours, 6) AS hours,
       CAST(strftime(timestamp, '2000-%m-%d %H:%M:%S') AS TIMESTAMP) AS plotstamp FROM al""")
def rpt_month_to_month(spark, sf):
    c = charts.month_curves(fx.order_hours(spark, sf), averages(spark, sf), projection(spark, sf), 7)
    return c.withColumn("hours", F.round("hours", 6))


@query("rpt_year_to_year", f"""
WITH {order_hours()}, {order_hours(live=False, name='st')}, {CUM_AVG},
dd AS (SELECT sum_date, sum(rc) AS rc FROM st GROUP BY 1)
SELECT 'measured ' || CAST(year(sum_date) AS VARCHAR) AS curve, sum_date AS date,
       CAST(sum_date + to_years(CAST(2001 - year(sum_date) AS INTEGER)) AS DATE) AS plotstamp,
       round(sum(rc) OVER (PARTITION BY year(sum_date) ORDER BY dayofyear(sum_date)) / 100e0 / 60, 6) AS hours FROM dd
UNION ALL SELECT 'average', CAST(timestamp AS DATE), CAST(timestamp AS DATE), round(max(in_year) / 60, 6) FROM ca GROUP BY 2""")
def rpt_year_to_year(spark, sf):
    c = charts.year_curves(fx.order_hours(spark, sf, live=False), averages(spark, sf), fx.O_AS_OF)
    return c.withColumn("hours", F.round("hours", 6))
