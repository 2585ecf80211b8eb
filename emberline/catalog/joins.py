"""Joins: by time bucket, as of a time, by calendar part, against one-row bounds."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.registry import (
    DEGREES, DELIVERIES, EV, THR, classified, event_hours, order_hours, query, season,
)
from emberline.functions.calendar import dow, month_season, ntz
from emberline.operators import rollups, runs, states
from emberline.plans import charts, forecast
from emberline.sources import fixtures as fx, series
from emberline.sources.files import table


@query("bucket_join", f"""
WITH {EV}, lg AS (SELECT key, date_trunc('day', ts) AS b, arg_max(st, ROW(ts, tie)) AS status
                  FROM ev WHERE st IS NOT NULL GROUP BY ALL)
SELECT e.tie AS event_id, e.key, lg.status FROM ev e LEFT JOIN lg ON e.key = lg.key AND date_trunc('day', e.ts) = lg.b""")
def bucket_join(spark, sf):
    j = states.bucket_join(fx.readings(spark, sf), fx.status_log(spark, sf), fx.KEY, "day")
    return j.select(F.col("tie").alias("event_id"), "key", "status")


@query("asof_initial", f"""
WITH {EV}, {THR}
SELECT key, arg_max(st, ROW(ts, tie)) AS status, max(ts) AS since,
       (SELECT hi FROM thr WHERE change_time < TIMESTAMP '2024-01-30 00:00:00' ORDER BY change_time DESC LIMIT 1) AS threshold
FROM ev WHERE st IS NOT NULL AND ts < TIMESTAMP '2024-01-30 00:00:00' GROUP BY key""")
def asof_initial(spark, sf):
    start = "2024-01-30 00:00:00"
    limit = states.initial_value(fx.thresholds(spark), [], start, "hi", "change_time").select("hi")
    return states.initial_value(fx.status_log(spark, sf), fx.KEY, start, "status").select(
        "key", "status", F.col("ts").alias("since"), limit.scalar().alias("threshold"))


_ASOF = f"WITH {classified('hi')} SELECT tie AS event_id, main_status, threshold FROM cls"


@query("asof_state", _ASOF)
def asof_state(spark, sf):
    rows, _ = runs.known_states(
        fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark), fx.KEY, fx.E_START, fx.E_END)
    return rows.select(F.col("tie").alias("event_id"), "main_status", F.col("hi").alias("threshold"))


@query("asof_state_chunked", _ASOF)
def asof_state_chunked(spark, sf):
    rows, _ = runs.known_states(
        fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark), fx.KEY, fx.E_START, fx.E_END,
        seconds=86400)
    return rows.select(F.col("tie").alias("event_id"), "main_status", F.col("hi").alias("threshold"))


@query("season_join", f"SELECT o_orderkey, {season('month(o_orderdate)')} AS season FROM orders")
def season_join(spark, sf):
    return rollups.with_season(table(spark, sf, "orders"), spark, "o_orderdate").select("o_orderkey", "season")


@query("prior_year_join", f"""
WITH {order_hours(as_of=None)}, d AS (SELECT sum_date, sum(rc) / 100e0 AS r FROM oh GROUP BY 1)
SELECT a.sum_date, a.r AS runtime, b.r AS previous_year
FROM d a LEFT JOIN d b ON CAST(a.sum_date - INTERVAL 1 YEAR AS DATE) = b.sum_date""")
def prior_year_join(spark, sf):
    d = rollups.prior_year(rollups.daily_sums(fx.order_hours(spark, sf, as_of=None)))
    return d.select("sum_date", *[F.col(c).cast("double").alias(c) for c in ("runtime", "previous_year")])


@query("override_join", f"WITH {DEGREES} SELECT doy, hdd FROM hdd")
def override_join(spark, sf):
    return forecast.degree_days(fx.climatology(spark, sf), fx.forecast(spark, sf))


@query("scalar_cross", f"""
WITH {EV}, {THR}, t AS (SELECT hi FROM thr ORDER BY change_time DESC LIMIT 1)
SELECT tie AS event_id, watts >= (SELECT hi FROM t) AS above FROM ev""")
def scalar_cross(spark, sf):
    # the one-row side is a scalar subquery, so no join is planned at all
    limit = rollups.latest(fx.thresholds(spark), ["change_time"], 1).select("hi")
    return fx.readings(spark, sf).select(F.col("tie").alias("event_id"), (F.col("watts") >= limit.scalar()).alias("above"))


@query("theta_since", f"""
WITH {DELIVERIES}, f AS (SELECT min(delivery_date) AS d FROM dl WHERE fill)
SELECT delivery_date, gc / 100e0 AS gallons FROM dl WHERE delivery_date > (SELECT d FROM f)""")
def theta_since(spark, sf):
    d = fx.deliveries(spark, sf)
    first = d.where("fill").agg(F.min("delivery_date"))
    return d.where(F.col("delivery_date") > first.scalar()).select(
        "delivery_date", F.col("gallons").cast("double").alias("gallons"))


@query("spine_fill", f"""
WITH {order_hours()}, {DELIVERIES}
SELECT CAST(t AS TIMESTAMP) AS timestamp, coalesce(dl.gc, 0) / 100e0 AS added, coalesce(oh.rc, 0) / 100e0 AS runtime
FROM (SELECT unnest(generate_series(CAST(min(sum_date) AS TIMESTAMP), TIMESTAMP '2001-07-15 12:00:00', INTERVAL 1 HOUR)) AS t FROM oh) s
LEFT JOIN dl ON CAST(dl.delivery_date AS TIMESTAMP) = t
LEFT JOIN oh ON oh.sum_date = CAST(t AS DATE) AND oh.hour = hour(t)""")
def spine_fill(spark, sf):
    h, d = fx.order_hours(spark, sf), fx.deliveries(spark, sf)
    bounds = h.agg(F.min("sum_date").cast("timestamp_ntz").alias("lo")).withColumn("hi", ntz(fx.O_AS_OF))
    hours = series.spine(bounds, "lo", "hi", "1 HOUR", "timestamp").withColumns(
        {"sum_date": F.to_date("timestamp"), "hour": F.hour("timestamp")})
    d = d.select(F.col("delivery_date").cast("timestamp_ntz").alias("timestamp"), "gallons")
    x = hours.join(d, "timestamp", "left").join(h, ["sum_date", "hour"], "left")
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    return x.select("timestamp", zero("gallons").alias("added"), zero("runtime").alias("runtime"))


_SLOT_DOW = "dayofweek(CASE WHEN hour > 12 THEN DATE '2024-01-29' ELSE DATE '2024-01-30' END)"


@query("slot_key_join", f"""
WITH {event_hours()}, b AS (SELECT hour, dayofweek(sum_date) AS dow, count(*) AS n, sum(rc) AS s FROM hh GROUP BY ALL)
SELECT h.sum_date, h.hour, rc / 100e0 AS runtime, b.n AS count, b.s / 100e0 / b.n AS runtime_avg
FROM (SELECT *, {_SLOT_DOW} AS dow FROM hh) h JOIN b USING (hour, dow)""")
def slot_key_join(spark, sf):
    h = fx.event_hours(spark, sf)
    base = h.groupBy("hour", dow(F.col("sum_date")).alias("dow")).agg(
        F.count("*").alias("count"), F.sum("runtime").alias("_s"))
    h = h.withColumn("dow", dow(charts.slot_day(F.col("hour"), fx.H_AS_OF)))
    return h.join(base, ["hour", "dow"]).select(
        "sum_date", "hour", F.col("runtime").cast("double").alias("runtime"), "count",
        rollups.ratio("_s", "count").alias("runtime_avg"))


@query("season_subquery_join", f"""
WITH {order_hours()}, d AS (SELECT sum_date, sum(rc) AS rc FROM oh GROUP BY 1),
s AS (SELECT sum_date, rc, dayofweek(sum_date) AS dow, {season('month(sum_date)')} AS season FROM d),
b AS (SELECT dow, season, sum(rc) AS t, count(*) AS n FROM s GROUP BY ALL)
SELECT sum_date, rc / 100e0 AS runtime, t / 100e0 / n AS runtime_avg FROM s JOIN b USING (dow, season)""")
def season_subquery_join(spark, sf):
    d = rollups.daily_sums(fx.order_hours(spark, sf))
    base = rollups.with_mean(rollups.by_dow_season(d, spark))
    d = d.withColumn("season", month_season(F.month("sum_date")))
    return d.join(base, ["dow", "season"]).select("sum_date", F.col("runtime").cast("double").alias("runtime"), "runtime_avg")


ACTIVE = """act AS (
  SELECT key, date, last_status, changes FROM (
    SELECT key, date, changes, asked,
           last_value(ls IGNORE NULLS) OVER (PARTITION BY key ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_status
    FROM (SELECT key, CAST(ts AS DATE) AS date, arg_max(st, ROW(ts, tie)) FILTER (WHERE st IS NOT NULL) AS ls,
                 count(st) AS changes, true AS asked FROM ev GROUP BY 1, 2))
  WHERE last_status = 'ON' OR changes > 0)"""


@query("active_day_gate", f"WITH {EV}, {ACTIVE} SELECT key, date, last_status, changes FROM act")
def active_day_gate(spark, sf):
    r = fx.readings(spark, sf)
    days = r.select("key", F.to_date("ts").alias("date")).distinct()
    return states.active_days(days, fx.status_log(spark, sf), fx.KEY)
