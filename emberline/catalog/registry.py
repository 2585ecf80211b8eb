"""Query registry and the SQL pieces that several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from emberline.functions.calendar import HEATING_SEASON
from emberline.plans.forecast import RUNTIME_CURVES
from emberline.sources.fixtures import H_AS_OF, O_AS_OF, THRESHOLDS

Query = Callable[[SparkSession, str], DataFrame]
# Columns that SQL calendar functions and row numbers give as BIGINT where Spark has int.
INT_COLUMNS = {
    "sums_monthly": "year month",
    "sums_yearly": "year",
    "base_dow": "dow",
    "base_doy": "month day",
    "base_hourly": "dow",
    "base_monthly": "month",
    "weighted_mean": "dow",
    "base_mdh": "month day",
    "running_mean_merge": "dow",
    "rpt_daily": "row_number",
    "rpt_daily_1year": "row_number",
    "rpt_daily_by_device": "row_number",
    "rpt_monthly": "row_number",
    "rpt_yearly": "label",
    "rpt_close_hour_sums": "hour",
    "rpt_gas_hour": "hour",
    "rpt_gas_dow": "dow",
    "rpt_gas_doy": "doy",
    "rpt_gas_month": "month",
    "rpt_gas_year": "year",
    "fn_calendar": "h d m y dow doy days",
    "override_join": "doy",
    "recency_rank": "row_number",
    "rank_over_agg": "year month row_number",
    "topn_rank": "row_number",
    "rpt_degree_days": "doy",
    "rpt_predicted_runtime": "doy",
    "rpt_daylight": "hour",
    "calendar_doy": "month day doy_noleap doy_leap",
    "keyed_update": "year month",
    "year_roll": "month day",
    "hour_close_gaps": "hour",
}

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ints = ", ".join(f"CAST({c} AS INTEGER) AS {c}" for c in INT_COLUMNS.get(name, "").split())
            ORACLES[name] = f"SELECT * REPLACE ({ints}) FROM ({sql})" if ints else sql
        return fn

    return keep


# ---- shared SQL ---------------------------------------------------------------------------

SEASON_CASE = "CASE {m} " + " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(HEATING_SEASON, 1)) + " END"
DOY_SEASON = ("CASE WHEN {d} < 60 THEN 'winter' WHEN {d} < 152 THEN 'spring' WHEN {d} < 244 THEN 'summer' "
              "WHEN {d} < 335 THEN 'fall' ELSE 'winter' END")
BTU = "(140000e0*0.666205227383988e0)"
GAL = "0.666205227383988e0"


def season(month: str) -> str:
    return SEASON_CASE.format(m=month)


def doy_season(doy: str) -> str:
    return DOY_SEASON.format(d=doy)


EV = """ev AS (
  SELECT user_id AS key, ts, event_id AS tie, CAST(value AS DECIMAL(10,2)) AS watts,
         CASE event_type WHEN 'signup' THEN 'ON' WHEN 'error' THEN 'OFF' END AS st
  FROM events)"""
THR = "thr(change_time, hi, lo) AS (VALUES " + ", ".join(
    f"(TIMESTAMP '{t}', {hi}, {lo})" for t, hi, lo in THRESHOLDS) + ")"
RUNNING = {"hi": "boiler", "lo": "circulator"}


def classified(which: str = "hi", by: str = "key", period: str | None = None, until: str | None = None) -> str:
    """CTEs ending in ``cls``: the plain global-window form over the whole feed."""
    run = RUNNING[which]
    part = f"PARTITION BY {by}" if by else ""
    cut = f", date_trunc('{period}', ts)" if period else ""
    within = (f"PARTITION BY {by}{cut}" if by else (f"PARTITION BY {cut[2:]}" if cut else ""))
    limit = f"WHERE ts < TIMESTAMP '{until}'" if until else ""
    return f"""{EV}, {THR},
filled AS (
  SELECT e.*, last_value(st IGNORE NULLS) OVER ({part} ORDER BY ts, tie
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS main_status, t.{which} AS threshold
  FROM ev e ASOF LEFT JOIN thr t ON e.ts >= t.change_time {limit}),
known AS (
  SELECT *, CASE WHEN main_status = 'ON' AND watts < threshold THEN 'main power'
                 WHEN main_status = 'ON' AND watts >= threshold THEN '{run}'
                 WHEN main_status = 'OFF' THEN 'OFF' END AS system_status
  FROM filled),
lagged AS (
  SELECT *, lag(ts) OVER w AS pts, lag(system_status) OVER w AS ps
  FROM known WINDOW w AS ({within} ORDER BY ts, tie)),
edges AS (
  SELECT *, epoch_us(ts) - epoch_us(pts) AS gap_us,
         CASE WHEN system_status = '{run}' AND ps <> '{run}' THEN 1 ELSE 0 END AS edge FROM lagged),
cls AS (
  SELECT *, CASE WHEN system_status <> '{run}' THEN NULL
                 ELSE CAST(sum(edge) OVER ({within} ORDER BY ts, tie
                        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) END AS run_id,
         CASE WHEN gap_us > 600000000 THEN 10000000 ELSE gap_us END AS cap_us
  FROM edges)"""


def run_totals(which: str = "hi", by: str = "key", period: str | None = None, cap: bool = True,
               until: str | None = None) -> str:
    """CTEs ending in ``tot``: totals over runs per key (and period), all zero without runs."""
    run = RUNNING[which]
    cols = ", ".join(c for c in (by, "period_start" if period else "") if c)
    src = "cls" if not period else f"(SELECT *, date_trunc('{period}', ts) AS period_start FROM cls)"
    us = "cap_us" if cap else "gap_us"
    lead = f"{cols}, " if cols else ""
    group = f"GROUP BY {cols}" if cols else ""
    return f"""{classified(which, by, period, until)},
r AS (
  SELECT {lead}run_id, system_status, CAST(sum({us}) AS BIGINT) AS us, sum(watts * gap_us) AS w_us
  FROM {src} GROUP BY {lead}run_id, system_status),
tot AS (
  SELECT {lead}
    CAST(sum(w_us) AS DOUBLE) AS w_us,
    CAST(count(*) FILTER (WHERE system_status = '{run}') AS INTEGER) AS cycles,
    CAST(sum(us) FILTER (WHERE system_status = '{run}') AS BIGINT) AS us,
    count(us) FILTER (WHERE system_status = '{run}') AS timed,
    min(us) FILTER (WHERE system_status = '{run}') AS min_us,
    max(us) FILTER (WHERE system_status = '{run}') AS max_us
  FROM r {group})"""


# hourly sums of the feed; rc is in hundredths
def event_hours(live: bool = True, as_of: str | None = H_AS_OF, name: str = "hh") -> str:
    cond = ""
    if as_of:
        cond = (f"WHERE ts <= TIMESTAMP '{as_of}'" if live else f"WHERE ts < date_trunc('hour', TIMESTAMP '{as_of}')")
    return f"""{name} AS (
  SELECT CAST(ts AS DATE) AS sum_date, CAST(hour(ts) AS INTEGER) AS hour,
         sum(CAST(round(value * 100) AS BIGINT)) AS rc
  FROM events {cond} GROUP BY ALL)"""


def order_hours(live: bool = True, as_of: str | None = O_AS_OF, name: str = "oh") -> str:
    cond = ""
    if as_of:
        op = "<=" if live else "<"
        cond = (f"WHERE o_orderdate < DATE '{as_of[:10]}' OR (o_orderdate = DATE '{as_of[:10]}' "
                f"AND o_orderkey % 24 {op} {int(as_of[11:13])})")
    return f"""{name} AS (
  SELECT CAST(o_orderdate AS DATE) AS sum_date, CAST(o_orderkey % 24 AS INTEGER) AS hour,
         sum(CAST(floor(o_totalprice / 100) AS BIGINT)) AS rc
  FROM orders {cond} GROUP BY ALL)"""


CLIMATE = """climate AS (
  SELECT dayofyear(o_orderdate) AS doy,
         sum(floor(abs(183 - dayofyear(o_orderdate)) * 40 / 183) + o_custkey % 11) / count(*) AS hdd_avg
  FROM orders GROUP BY 1)"""
FORECAST = f"""fc AS (
  SELECT dayofyear(o_orderdate) AS doy, CAST(round(sum(o_custkey % 30) / count(*)) AS INTEGER) AS hdd
  FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '{O_AS_OF[:10]}'
    AND CAST(o_orderdate AS DATE) <= DATE '{O_AS_OF[:10]}' + 10
  GROUP BY CAST(o_orderdate AS DATE), 1)"""
DEGREES = f"""{CLIMATE}, {FORECAST}, hdd AS (
  SELECT c.doy, coalesce(f.hdd, CAST(round(c.hdd_avg) AS INTEGER)) AS hdd FROM climate c LEFT JOIN fc f USING (doy))"""


def curve(name: str, weekend: str, x: str) -> str:
    """The runtime curves as plain powers, from the same fixed values."""
    def powers(coefficients):
        return " + ".join(f"({c:.10f}e0) * pow({x}, {i})" for i, c in enumerate(coefficients))

    return "CASE " + " ".join(
        f"WHEN {name} = '{season_name}' AND {'' if part == 'weekend' else 'NOT '}{weekend} THEN {powers(c)}"
        for (season_name, part), c in RUNTIME_CURVES.items()) + " END"


PREDICTED = f"""{DEGREES}, pr AS (
  SELECT d AS date, doy, {curve('name', 'dayofweek(d) IN (0, 6)', 'h')} AS predicted_runtime
  FROM (SELECT CAST(d AS DATE) AS d, hdd.doy, {doy_season('hdd.doy')} AS name, CAST(hdd.hdd AS DOUBLE) AS h
        FROM generate_series(DATE '{O_AS_OF[:10]}', DATE '{O_AS_OF[:10]}' + 365, INTERVAL 1 DAY) g(d)
        JOIN hdd ON dayofyear(d) = hdd.doy))"""
DELIVERIES = f"""dl AS (
  SELECT CAST(o_orderdate AS DATE) AS delivery_date, arg_max(o_orderstatus, o_orderkey) = 'F' AS fill,
         sum(CAST(floor(o_totalprice / 100) AS BIGINT)) * 5 AS gc
  FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate <= DATE '{O_AS_OF[:10]}' GROUP BY 1)"""
