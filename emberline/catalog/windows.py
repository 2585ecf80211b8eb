"""Ordered operators, top-k and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.aggregates import DAILY, feed
from emberline.catalog.filters import FILLED, GAPS, filled, with_gaps
from emberline.catalog.registry import (
    DELIVERIES, EV, PREDICTED, classified, event_hours, order_hours, query,
)
from emberline.functions.calendar import instant_order, micros_between
from emberline.operators import chunks, rollups, runs
from emberline.operators.states import fixed_state
from emberline.plans import forecast, inventory
from emberline.sources import fixtures as fx


@query("gap_seconds", f"WITH {GAPS} SELECT tie AS event_id, gap_us / 1e6 AS seconds FROM gp")
def gap_seconds(spark, sf):
    return with_gaps(spark, sf).select(F.col("tie").alias("event_id"), (F.col("gap_us") / 1e6).alias("seconds"))


@query("gap_seconds_chunked", f"WITH {GAPS} SELECT tie AS event_id, gap_us / 1e6 AS seconds FROM gp")
def gap_seconds_chunked(spark, sf):
    return with_gaps(spark, sf, 86400).select(F.col("tie").alias("event_id"), (F.col("gap_us") / 1e6).alias("seconds"))


@query("ffill", f"WITH {FILLED} SELECT tie AS event_id, status FROM fl")
def ffill(spark, sf):
    r = fx.one_device(fx.readings(spark, sf).join(
        fx.status_log(spark, sf).select("tie", "status"), "tie", "left"))
    r = chunks.fill_forward(r, [], ("ts", "tie"), ("status",), chunks.choose_chunk(r, [], "ts") or 86400)
    return r.select(F.col("tie").alias("event_id"), "status")


@query("run_edges", f"WITH {classified('hi')} SELECT key, tie AS event_id, ts FROM cls WHERE edge = 1")
def run_edges(spark, sf):
    c = runs.classify_runs(*feed(spark, sf), "hi", fx.E_START, fx.E_END)
    # the first row of each id above 0 is the edge
    at = instant_order(F.col("ts"), F.col("tie"))
    return c.where((F.col("system_status") == "boiler") & (F.col("run_id") > 0)).groupBy("key", "run_id").agg(
        F.min_by("tie", at).alias("event_id"), F.min("ts").alias("ts")).drop("run_id")


CLASSIFIED = "SELECT key, tie AS event_id, main_status, system_status, gap_us / 1e6 AS tdiff, run_id FROM cls"


def _classified(c):
    return c.select("key", F.col("tie").alias("event_id"), "main_status", "system_status",
                    (F.col("gap_us") / 1e6).alias("tdiff"), "run_id")


@query("run_ids", f"WITH {classified('hi', period='day')} {CLASSIFIED}")
def run_ids(spark, sf):
    return _classified(runs.classify_runs(*feed(spark, sf), "hi", fx.E_START, fx.E_END, period="day"))


@query("run_ids_chunked", f"WITH {classified('hi', period='day')} {CLASSIFIED}")
def run_ids_chunked(spark, sf):
    return _classified(runs.classify_runs(*feed(spark, sf), "hi", fx.E_START, fx.E_END, period="day", seconds=3600))


HEAT = (", CASE WHEN system_status = 'boiler' THEN cap_us * (140000e0*0.666205227383988e0) / 3.6e9 ELSE 0 END AS btu"
        ", CASE WHEN system_status = 'boiler' THEN cap_us * 0.666205227383988e0 / 3.6e9 ELSE 0 END AS gallons FROM cls")


@query("classify_hi", f"WITH {classified('hi')} {CLASSIFIED.replace(' FROM cls', HEAT)}")
def classify_hi(spark, sf):
    c = runs.classify_runs(*feed(spark, sf), "hi", fx.E_START, fx.E_END)
    return c.select(*_classified(c).columns[:1], F.col("tie").alias("event_id"), "main_status", "system_status",
                    (F.col("gap_us") / 1e6).alias("tdiff"), "run_id", "btu", "gallons")


@query("classify_lo", f"WITH {classified('lo')} {CLASSIFIED.replace(' FROM cls', ', CAST(0 AS DOUBLE) AS btu FROM cls')}")
def classify_lo(spark, sf):
    c = runs.classify_runs(*feed(spark, sf), "lo", fx.E_START, fx.E_END)
    return c.select("key", F.col("tie").alias("event_id"), "main_status", "system_status",
                    (F.col("gap_us") / 1e6).alias("tdiff"), "run_id", "btu")


@query("classify_one_device", f"WITH {classified('hi', by='')} {CLASSIFIED.replace('key, ', '')}")
def classify_one_device(spark, sf):
    r, log, thr, _ = feed(spark, sf)
    r = fx.one_device(r)
    seconds = chunks.choose_chunk(r, [], "ts") or 21600
    c = runs.classify_runs(r, fx.one_device(log), thr, [], "hi", fx.E_START, fx.E_END, seconds=seconds)
    return _classified(c.withColumn("key", F.lit(0))).drop("key")


@query("fill_status", f"WITH {FILLED} SELECT tie AS event_id, CAST(watts AS DOUBLE) AS watts, ts, gap_us / 1e6 AS tdiff, status FROM fl")
def fill_status(spark, sf):
    return filled(spark, sf).select(
        F.col("tie").alias("event_id"), F.col("watts").cast("double").alias("watts"), "ts",
        (F.col("gap_us") / 1e6).alias("tdiff"), "status")


@query("debounce", f"""
WITH {EV}, s AS (SELECT *, CASE WHEN watts > 40 THEN 'ON' ELSE 'OFF' END AS raw FROM ev)
SELECT tie AS event_id, raw, CASE WHEN raw = 'OFF' AND lag(raw) OVER w = 'ON' AND lead(raw) OVER w = 'ON' THEN 'ON' ELSE raw END AS status
FROM s WINDOW w AS (PARTITION BY key ORDER BY ts, tie)""")
def debounce(spark, sf):
    r = fx.readings(spark, sf).withColumn("raw", fixed_state(F.col("watts"), 40))
    r = runs.debounce(r.withColumn("status", F.col("raw")), fx.KEY, "status", chunks.choose_chunk(r, fx.KEY, "ts"))
    return r.select(F.col("tie").alias("event_id"), "raw", "status")


@query("recency_rank", f"""
WITH {order_hours()}, {DAILY}
SELECT sum_date, rc / 100e0 AS runtime, row_number() OVER (ORDER BY sum_date DESC) AS row_number FROM d""")
def recency_rank(spark, sf):
    d = rollups.recency(rollups.daily_sums(fx.order_hours(spark, sf)), ["sum_date"])
    return d.select("sum_date", F.col("runtime").cast("double").alias("runtime"), "row_number")


@query("rank_over_agg", f"""
WITH {order_hours()}
SELECT year(sum_date) AS year, month(sum_date) AS month, max(sum_date) AS last_day,
       row_number() OVER (ORDER BY max(sum_date) DESC) AS row_number FROM oh GROUP BY 1, 2""")
def rank_over_agg(spark, sf):
    h = fx.order_hours(spark, sf)
    m = h.groupBy(F.year("sum_date").alias("year"), F.month("sum_date").alias("month")).agg(F.max("sum_date").alias("last_day"))
    return rollups.recency(m, ["last_day"])


@query("cumsum_global", f"""
WITH {EV} SELECT tie AS event_id, CAST(sum(watts) OVER (ORDER BY ts, tie ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS total FROM ev""")
def cumsum_global(spark, sf):
    r = fx.one_device(fx.readings(spark, sf))
    r = chunks.running_sum(r, [], ("ts", "tie"), "watts", "total", chunks.choose_chunk(r, [], "ts") or 21600)
    return r.select(F.col("tie").alias("event_id"), F.col("total").cast("double").alias("total"))


@query("cumsum_partition", f"""
WITH {order_hours()}
SELECT sum_date, hour, sum(rc) OVER (PARTITION BY year(sum_date), month(sum_date) ORDER BY sum_date, hour) / 100e0 AS in_month,
       sum(rc) OVER (PARTITION BY year(sum_date) ORDER BY sum_date, hour) / 100e0 AS in_year FROM oh""")
def cumsum_partition(spark, sf):
    d = F.col("sum_date")
    h = fx.order_hours(spark, sf)
    h = rollups.cumulative(h, ["sum_date", "hour"], "runtime", "in_month", [F.year(d), F.month(d)])
    h = rollups.cumulative(h, ["sum_date", "hour"], "runtime", "in_year", [F.year(d)])
    return h.select("sum_date", "hour", *[F.col(c).cast("double").alias(c) for c in ("in_month", "in_year")])


REMAINING = f"""lf AS (SELECT max(delivery_date) AS d FROM dl WHERE fill),
rem AS (SELECT 260e0 + (SELECT coalesce(sum(gc) / 100e0, 0) FROM dl WHERE delivery_date > (SELECT d FROM lf))
          - (SELECT coalesce(round(sum(rc) / 100e0 / 60 * 0.666205227383988e0, 2), 0) FROM oh
             WHERE sum_date >= (SELECT d FROM lf)) AS g)"""


@query("running_balance", f"""
WITH {PREDICTED}, {DELIVERIES}, {order_hours()}, {REMAINING}
SELECT date, round((SELECT g FROM rem) - sum(predicted_runtime / 60 * 0.666205227383988e0) OVER (ORDER BY date), 3) AS remaining_gallons
FROM pr""")
def running_balance(spark, sf):
    left = inventory.remaining_gallons(fx.deliveries(spark, sf), fx.order_hours(spark, sf))
    hdd = forecast.degree_days(fx.climatology(spark, sf), fx.forecast(spark, sf))
    b = inventory.balance(forecast.predicted_runtime(hdd, fx.O_AS_OF), left)
    return b.select("date", F.round("remaining_gallons", 3).alias("remaining_gallons"))


@query("running_level", f"""
WITH {DELIVERIES}, {order_hours()}, u AS (SELECT sum_date, sum(rc) AS rc FROM oh GROUP BY 1)
SELECT u.sum_date, sum(coalesce(gc, 0) - rc) OVER (ORDER BY u.sum_date) / 100e0 AS level
FROM u LEFT JOIN dl ON dl.delivery_date = u.sum_date""")
def running_level(spark, sf):
    d = rollups.daily_sums(fx.order_hours(spark, sf))
    gal = fx.deliveries(spark, sf).select(F.col("delivery_date").alias("sum_date"), "gallons")
    x = d.join(gal, "sum_date", "left")
    x = x.withColumn("_x", F.coalesce("gallons", F.lit(0).cast("decimal(28,2)")) - F.col("runtime"))
    return rollups.cumulative(x, ["sum_date"], "_x", "level").select("sum_date", F.col("level").cast("double").alias("level"))


@query("first_crossing", f"""
WITH {EV}, g AS (SELECT ts, tie, watts * (epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts, tie))) AS w FROM ev),
c AS (SELECT ts, CAST(sum(w) OVER (ORDER BY ts, tie ROWS UNBOUNDED PRECEDING) AS DOUBLE) / 3.6e12 AS kwh FROM g)
SELECT x AS limit_kwh, min(ts) FILTER (WHERE kwh > x) AS crossed FROM c, (VALUES (1e0), (10e0), (20e0), (99999e0)) v(x) GROUP BY x""")
def first_crossing(spark, sf):
    r = fx.one_device(fx.readings(spark, sf))
    seconds = chunks.choose_chunk(r, [], "ts") or 21600
    r = chunks.previous(r, [], ("ts", "tie"), {"ts": "_before"}, seconds)
    w_us = F.col("watts").cast("decimal(14,2)") * micros_between(F.col("_before"), F.col("ts"))
    return chunks.first_crossing(r, [], ("ts", "tie"), w_us, (1, 10, 20, 99999), seconds, lambda total: total.cast("double") / 3.6e12).select(
        F.col("limit").alias("limit_kwh"), "crossed")


@query("topk_recent", f"WITH {event_hours()} SELECT sum_date, hour, rc / 100e0 AS runtime FROM hh ORDER BY sum_date DESC, hour DESC LIMIT 24")
def topk_recent(spark, sf):
    h = rollups.latest(fx.event_hours(spark, sf), ["sum_date", "hour"], 24)
    return h.orderBy("sum_date", "hour").select("sum_date", "hour", F.col("runtime").cast("double").alias("runtime"))


@query("latest_row", f"WITH {EV} SELECT key, max(ts) AS ts, CAST(arg_max(watts, ROW(ts, tie)) AS DOUBLE) AS watts FROM ev GROUP BY key")
def latest_row(spark, sf):
    return rollups.newest_reading(fx.readings(spark, sf), fx.KEY).withColumn("watts", F.col("watts").cast("double"))


@query("topn_rank", f"""
WITH {order_hours()}, {DAILY}, k AS (SELECT sum_date, rc / 100e0 AS runtime, row_number() OVER (ORDER BY sum_date DESC) AS row_number FROM d)
SELECT * FROM k WHERE row_number < 366""")
def topn_rank(spark, sf):
    d = rollups.latest(rollups.daily_sums(fx.order_hours(spark, sf)), ["sum_date"], 365)
    d = rollups.recency(d, ["sum_date"])
    return d.select("sum_date", F.col("runtime").cast("double").alias("runtime"), "row_number")


@query("union_live", f"""
WITH {event_hours(live=False)}, {event_hours(live=True, name='lv')}
SELECT sum_date, hour, rc / 100e0 AS runtime FROM hh UNION SELECT sum_date, hour, rc / 100e0 FROM lv WHERE sum_date >= DATE '2024-01-29'""")
def union_live(spark, sf):
    live = fx.event_hours(spark, sf).where(F.col("sum_date") >= F.lit("2024-01-29").cast("date"))
    u = rollups.union_live(fx.event_hours(spark, sf, live=False), live)
    return u.withColumn("runtime", F.col("runtime").cast("double"))


@query("bind_prediction", f"""
WITH {PREDICTED}, {order_hours()}, {DAILY}
SELECT 'measured' AS kind, sum_date AS day, rc / 100e0 AS runtime FROM d
UNION ALL SELECT 'predicted', date, round(predicted_runtime, 6) FROM pr""")
def bind_prediction(spark, sf):
    d = rollups.daily_sums(fx.order_hours(spark, sf)).select(
        F.lit("measured").alias("kind"), F.col("sum_date").alias("day"), F.col("runtime").cast("double").alias("runtime"))
    hdd = forecast.degree_days(fx.climatology(spark, sf), fx.forecast(spark, sf))
    p = forecast.predicted_runtime(hdd, fx.O_AS_OF)
    return d.unionByName(p.select(
        F.lit("predicted").alias("kind"), F.col("date").alias("day"), F.round("predicted_runtime", 6).alias("runtime")))
