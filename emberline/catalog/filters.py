"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.registry import BTU, EV, GAL, classified, curve, doy_season, order_hours, query
from emberline.functions import energy
from emberline.functions.calendar import dow, meteorological_season, micros_between
from emberline.operators import chunks, model, rollups, runs, states
from emberline.plans.forecast import curve_value
from emberline.sources import files, fixtures as fx


def events(spark, sf):
    return files.table(spark, sf, "events")


@query("filter_range_closed", """
SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-01 00:00:00' AND ts <= TIMESTAMP '2024-01-29 23:59:59' AND value IS NOT NULL""")
def filter_range_closed(spark, sf):
    e = states.in_range(events(spark, sf), "ts", "2024-01-01 00:00:00", "2024-01-29 23:59:59", closed=True)
    return e.where(F.col("value").isNotNull()).select("event_id", "ts", "value")


@query("filter_range_halfopen", """
SELECT event_id, ts, value FROM events
WHERE ts >= TIMESTAMP '2024-01-02 00:00:00' AND ts < TIMESTAMP '2024-02-01 00:00:00'""")
def filter_range_halfopen(spark, sf):
    return states.in_range(events(spark, sf), "ts", "2024-01-02 00:00:00", fx.E_END).select("event_id", "ts", "value")


@query("filter_calendar", """
SELECT o_orderkey, o_totalprice, CASE WHEN CAST(o_orderdate AS DATE) = DATE '2000-02-29' THEN 'day' ELSE 'month' END AS part
FROM orders WHERE year(o_orderdate) = 2000 AND month(o_orderdate) = 2""")
def filter_calendar(spark, sf):
    # calendar parts written as a range, which prunes row groups and partitions
    o = states.in_range(files.table(spark, sf, "orders"), "o_orderdate", "2000-02-01 00:00:00", "2000-03-01 00:00:00")
    leap_day = F.to_date("o_orderdate") == F.lit("2000-02-29").cast("date")
    return o.select("o_orderkey", "o_totalprice", F.when(leap_day, "day").otherwise("month").alias("part"))


@query("threshold_state", f"""
WITH {classified('hi')}, lo AS (SELECT e.tie, t.lo FROM ev e ASOF LEFT JOIN thr t ON e.ts >= t.change_time)
SELECT c.tie AS event_id, system_status AS hi_state,
       CASE WHEN main_status = 'ON' AND watts < lo THEN 'main power' WHEN main_status = 'ON' AND watts >= lo
            THEN 'circulator' WHEN main_status = 'OFF' THEN 'OFF' END AS lo_state
FROM cls c JOIN lo USING (tie)""")
def threshold_state(spark, sf):
    r, log, thr = fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark)
    rows, _ = runs.known_states(r, log, thr, fx.KEY, fx.E_START, fx.E_END)
    at = lambda which: states.threshold_state(
        F.col("main_status"), F.col("watts"), F.col(which), states.RUNNING[which])
    return rows.select(F.col("tie").alias("event_id"), at("hi").alias("hi_state"), at("lo").alias("lo_state"))


@query("fixed_state", """
SELECT event_id, CASE WHEN value > 490 THEN 'ON' ELSE 'OFF' END AS above_490,
       CASE WHEN value > 50 THEN 'ON' ELSE 'OFF' END AS above_50 FROM events""")
def fixed_state(spark, sf):
    return events(spark, sf).select(
        "event_id", states.fixed_state(F.col("value"), 490).alias("above_490"),
        states.fixed_state(F.col("value"), 50).alias("above_50"))


def filled_sql(by: str = "") -> str:
    """CTEs ending in ``fl``: status and gap of every reading, of one device or of each."""
    part = f"PARTITION BY {by} " if by else ""
    return f"""{EV}, fl AS (
  SELECT *, last_value(st IGNORE NULLS) OVER ({part}ORDER BY ts, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS status,
         epoch_us(ts) - epoch_us(lag(ts) OVER ({part}ORDER BY ts, tie)) AS gap_us FROM ev{f" WHERE {by} IS NOT NULL" if by else ""})"""


FILLED = filled_sql()
MODE = """CASE WHEN status = 'ON' AND watts < 69 THEN 'blower' WHEN status = 'ON' AND gap_us > 600000000 THEN 'unknown'
  WHEN status = 'ON' AND watts > 500 THEN 'dehumidification' ELSE status END"""


def filled(spark, sf):
    """The feed as one device: filled status and gaps."""
    r, log = fx.one_device(fx.readings(spark, sf)), fx.one_device(fx.status_log(spark, sf))
    return states.fill_status(r, log, [], fx.E_START, fx.E_END, chunks.choose_chunk(r, [], "ts"))


@query("status_override", f"""
WITH {FILLED}
SELECT tie AS event_id, {MODE} AS mode,
       CASE WHEN watts > 500 THEN 'dehumidification' WHEN watts < 40 THEN 'off' WHEN watts < 60 THEN 'blower' ELSE 'on' END AS unlogged
FROM fl""")
def status_override(spark, sf):
    return filled(spark, sf).select(
        F.col("tie").alias("event_id"),
        states.furnace_mode(F.col("status"), F.col("watts"), F.col("gap_us") / 1e6).alias("mode"),
        states.furnace_mode_unlogged(F.col("watts")).alias("unlogged"))


def with_gaps(spark, sf, seconds=runs.AUTO):
    r = fx.readings(spark, sf)
    if seconds == runs.AUTO:
        seconds = chunks.choose_chunk(r, fx.KEY, "ts")
    r = chunks.previous(r, fx.KEY, ("ts", "tie"), {"ts": "_before"}, seconds)
    return r.withColumn("gap_us", micros_between(F.col("_before"), F.col("ts"))).drop("_before")


GAPS = f"""{EV}, gp AS (
  SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY ts, tie)) AS gap_us FROM ev)"""


@query("gap_cap", f"""
WITH {GAPS} SELECT tie AS event_id, CASE WHEN gap_us > 600000000 THEN 10 ELSE gap_us / 1e6 END AS seconds FROM gp""")
def gap_cap(spark, sf):
    return with_gaps(spark, sf).select(
        F.col("tie").alias("event_id"), (energy.capped_gap(F.col("gap_us")) / 1e6).alias("seconds"))


@query("interval_energy", f"""
WITH {classified('hi')}
SELECT tie AS event_id,
  CASE WHEN system_status = 'boiler' THEN cap_us * {BTU} / 3.6e9 ELSE 0 END AS btu,
  CASE WHEN system_status = 'boiler' THEN cap_us * {GAL} / 3.6e9 ELSE 0 END AS gallons,
  CAST(watts * gap_us AS DOUBLE) / 3.6e12 AS kwh
FROM cls""")
def interval_energy(spark, sf):
    c = runs.classify_runs(fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark), fx.KEY, "hi",
                           fx.E_START, fx.E_END)
    return c.select(F.col("tie").alias("event_id"), "btu", "gallons",
                    energy.kwh(energy.watt_micros(F.col("watts"), F.col("gap_us"))).alias("kwh"))


@query("degree_day_poly", f"""
SELECT o_orderkey, round({curve('name', 'we', 'h')}, 6) AS runtime
FROM (SELECT o_orderkey, CAST(o_custkey % 60 AS DOUBLE) AS h, {doy_season('dayofyear(o_orderdate)')} AS name,
             dayofweek(o_orderdate) IN (0, 6) AS we FROM orders)""")
def degree_day_poly(spark, sf):
    d = F.col("o_orderdate")
    value = curve_value(meteorological_season(F.dayofyear(d)), dow(d).isin(0, 6), (F.col("o_custkey") % 60).cast("double"))
    return files.table(spark, sf, "orders").select("o_orderkey", F.round(value, 6).alias("runtime"))


@query("clamp_mask", f"""
WITH {FILLED} SELECT tie AS event_id, CASE WHEN status <> 'ON' THEN 0
  ELSE least(greatest(CAST(watts AS DOUBLE), 40), 100) END AS level FROM fl""")
def clamp_mask(spark, sf):
    level = model.clamp_mask(F.col("watts").cast("double"), F.col("status"))
    return filled(spark, sf).select(F.col("tie").alias("event_id"), level.alias("level"))


@query("null_handling", """
SELECT l_orderkey, l_linenumber, coalesce(CASE WHEN l_quantity < 40 THEN l_quantity END, 0) AS quantity, l_discount, tax
FROM (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_tax END AS tax FROM lineitem) WHERE l_discount <> 0 AND tax <> 0""")
def null_handling(spark, sf):
    x = files.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_quantity") < 40, F.col("l_quantity")).alias("quantity"),
        "l_discount", F.when(F.col("l_returnflag") != "R", F.col("l_tax")).alias("tax"))
    return model.drop_zero(x, ["l_discount", "tax"]).fillna(0.0, ["quantity"])


@query("greatest_est", f"""
WITH {order_hours()}, d AS (SELECT sum_date, sum(rc) / 100e0 AS r FROM oh GROUP BY 1)
SELECT a.sum_date, greatest(a.r, b.r) AS estimate FROM d a LEFT JOIN d b ON CAST(a.sum_date - INTERVAL 1 YEAR AS DATE) = b.sum_date""")
def greatest_est(spark, sf):
    d = rollups.prior_year(rollups.daily_sums(fx.order_hours(spark, sf)))
    return d.select("sum_date", F.greatest("runtime", "previous_year").cast("double").alias("estimate"))
