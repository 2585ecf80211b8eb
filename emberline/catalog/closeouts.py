"""Hour, day and month close-out, and gas usage by period."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.models import HEAT_SQL, SCORED, SCORED_EACH
from emberline.catalog.registry import BTU, doy_season, query, run_totals
from emberline.plans import closeout, gas
from emberline.sources import fixtures as fx

MONTH_AS_OF = "2024-02-01 00:05:00"
YEAR_AS_OF = "2025-01-01 00:05:00"


def closed_sql(period: str, end: str, last: str) -> str:
    """CTEs ending in ``cl``: every closed period with its run time and completeness."""
    return f"""{run_totals('hi', by='', period=period, until=end)},
gaps AS (SELECT ts, watts, epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts, tie)) AS gap_us FROM ev WHERE ts < TIMESTAMP '{end}'),
ok AS (SELECT date_trunc('{period}', ts) AS p, bool_or(coalesce(gap_us >= 300000000 AND gap_us * watts > 0, false)) AS bad FROM gaps GROUP BY 1),
cl AS (SELECT CAST(g AS TIMESTAMP) AS p, coalesce(tot.us, 0) AS us, CASE WHEN coalesce(bad, false) THEN 'no' ELSE 'yes' END AS complete,
              CAST(g + INTERVAL 1 {period} AS TIMESTAMP) AS updated, hour(g) AS hour, dayofweek(g) AS dow, month(g) AS month, day(g) AS day,
              {doy_season('dayofyear(g)')} AS season
       FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '{last}', INTERVAL 1 {period}) s(g)
       LEFT JOIN tot ON tot.period_start = g LEFT JOIN ok ON ok.p = g)"""


def slot_sql(grid: str, slot: str, starting: str, stamp: str) -> str:
    """CTEs ``sl`` (newest closed value per slot, reset applied) and ``bs`` (running mean)."""
    return f"""grid AS ({grid}),
nw AS (SELECT {slot}, arg_max(us, p) AS us, arg_max(complete, p) AS complete, max(updated) AS updated, count(*) AS n, sum(us) AS total
       FROM cl GROUP BY {slot}),
sl AS (SELECT {slot}, CASE WHEN {starting} THEN 0 ELSE coalesce(us * {BTU} / 3.6e9, 0) END AS btu,
              CASE WHEN {starting} THEN 'no' ELSE coalesce(complete, 'no') END AS complete,
              CASE WHEN {starting} THEN TIMESTAMP '{stamp}' ELSE updated END AS updated,
              CAST(coalesce(n, 0) AS INTEGER) AS count, coalesce(CAST(total AS BIGINT) * {BTU} / 3.6e9 / n, 0) AS btu_avg
       FROM grid LEFT JOIN nw USING ({slot}))"""


HOUR_CLOSED = closed_sql("hour", "2024-01-30 12:00:00", "2024-01-30 11:00:00")
DAY_CLOSED = closed_sql("day", "2024-01-30 00:00:00", "2024-01-29 00:00:00")
MONTH_CLOSED = closed_sql("month", "2024-02-01 00:00:00", "2024-01-01 00:00:00")
HOURS = "SELECT CAST(range AS INTEGER) AS hour FROM range(24)"
DAYS = "SELECT CAST(range AS INTEGER) AS dow FROM range(7)"
CAL = ("SELECT CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day "
       "FROM generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY) g(d)")
MONTHS = "SELECT CAST(range AS INTEGER) AS month FROM range(1, 13)"


def _closed(spark, sf, period, as_of):
    r, log = fx.one_device(fx.readings(spark, sf)), fx.one_device(fx.status_log(spark, sf))
    return closeout.closed_periods(r, log, fx.thresholds(spark), period, fx.E_START, as_of)


@query("rpt_close_hour", f"""
WITH {HOUR_CLOSED}, {slot_sql(HOURS, 'hour', 'hour = 12', '2024-01-30 12:00:00')} SELECT * FROM sl""")
def rpt_close_hour(spark, sf):
    return closeout.hour_table(_closed(spark, sf, "hour", fx.H_AS_OF), fx.H_AS_OF)


def _baseline_sql(slots, keys=()):
    names = "+".join(slots)
    cols = ", ".join(f"g.{c} AS {c}" if c in (*keys, *slots) else f"CAST(NULL AS {'VARCHAR' if c == 'season' else 'INTEGER'}) AS {c}"
                     for c in (*keys, "hour", "dow", "season"))
    key = ", ".join([*keys, *slots])
    return f"""SELECT '{names}' AS baseline, {cols}, CAST(coalesce(n, 0) AS INTEGER) AS count,
  coalesce(total * {BTU} / 3.6e9 / n, 0) AS btu_avg
FROM (SELECT DISTINCT {key} FROM full_grid) g LEFT JOIN (SELECT {key}, count(*) AS n, CAST(sum(us) AS BIGINT) AS total FROM cl GROUP BY {key}) b USING ({key})"""


GRID = """SELECT CAST(h AS INTEGER) AS hour, CAST(w AS INTEGER) AS dow, s AS season
  FROM range(24) a(h), range(7) b(w), (VALUES ('winter'), ('spring'), ('summer'), ('fall')) c(s)"""
BASELINE_SLOTS = (["hour"], ["hour", "dow"], ["hour", "season"], ["hour", "dow", "season"])


@query("rpt_close_hour_baselines", f"""
WITH {HOUR_CLOSED}, full_grid AS ({GRID})
""" + " UNION ALL ".join(_baseline_sql(s) for s in BASELINE_SLOTS))
def rpt_close_hour_baselines(spark, sf):
    return closeout.hour_baselines(_closed(spark, sf, "hour", fx.H_AS_OF))


@query("rpt_close_hour_sums", f"""
WITH {HOUR_CLOSED}
SELECT CAST(p AS DATE) AS sum_date, hour, us / 6e7 AS runtime, us * {BTU} / 3.6e9 AS btu, complete FROM cl""")
def rpt_close_hour_sums(spark, sf):
    return closeout.period_sums(_closed(spark, sf, "hour", fx.H_AS_OF), "hour")


@query("rpt_close_day_sums", f"""
WITH {DAY_CLOSED}
SELECT CAST(p AS DATE) AS sum_date, us / 6e7 AS runtime, us * {BTU} / 3.6e9 AS btu, complete FROM cl""")
def rpt_close_day_sums(spark, sf):
    return closeout.period_sums(_closed(spark, sf, "day", fx.H_AS_OF), "day")


@query("rpt_close_month_sums", f"""
WITH {MONTH_CLOSED}
SELECT CAST(p AS DATE) AS sum_date, month, us / 6e7 AS runtime, us * {BTU} / 3.6e9 AS btu, complete FROM cl""")
def rpt_close_month_sums(spark, sf):
    return closeout.period_sums(_closed(spark, sf, "month", MONTH_AS_OF), "month")


@query("rpt_close_day", f"""
WITH {DAY_CLOSED}, {slot_sql(DAYS, 'dow', 'dow = 2', '2024-01-30 00:00:00')} SELECT * FROM sl""")
def rpt_close_day(spark, sf):
    return closeout.dow_table(_closed(spark, sf, "day", fx.H_AS_OF), fx.H_AS_OF)


@query("rpt_close_day_season", f"""
WITH {DAY_CLOSED}
SELECT CAST(w AS INTEGER) AS dow, s AS season, CAST(coalesce(n, 0) AS INTEGER) AS count, coalesce(total * {BTU} / 3.6e9 / n, 0) AS btu_avg
FROM range(7) b(w) CROSS JOIN (VALUES ('winter'), ('spring'), ('summer'), ('fall')) c(s)
LEFT JOIN (SELECT dow, season, count(*) AS n, CAST(sum(us) AS BIGINT) AS total FROM cl GROUP BY 1, 2) b ON b.dow = w AND b.season = s""")
def rpt_close_day_season(spark, sf):
    return closeout.dow_season_table(_closed(spark, sf, "day", fx.H_AS_OF))


@query("rpt_close_day_doy", f"""
WITH {DAY_CLOSED}, {slot_sql(CAL, 'month, day', 'month = 1 AND day = 30', '2024-01-30 00:00:00')}
SELECT sl.*, CASE WHEN month = 1 AND day = 30 THEN coalesce(cur, 0) ELSE 0 END AS previous_year,
       CASE WHEN month = 1 AND day = 30 THEN NULL ELSE coalesce(cur, 0) END AS current_year
FROM sl LEFT JOIN (SELECT month, day, us * {BTU} / 3.6e9 AS cur FROM cl) c USING (month, day)""")
def rpt_close_day_doy(spark, sf):
    return closeout.doy_table(_closed(spark, sf, "day", fx.H_AS_OF), fx.H_AS_OF)


@query("rpt_close_month", f"""
WITH {MONTH_CLOSED}, {slot_sql(MONTHS, 'month', 'month = 2', '2024-02-01 00:00:00')}
SELECT sl.*, coalesce(py, 0) AS previous_year FROM sl LEFT JOIN (SELECT month, us * {BTU} / 3.6e9 AS py FROM cl) c USING (month)""")
def rpt_close_month(spark, sf):
    return closeout.month_table(_closed(spark, sf, "month", MONTH_AS_OF), MONTH_AS_OF)


# ---- every device apart -------------------------------------------------------------------


def device_closed_sql(period: str, end: str) -> str:
    """CTEs ending in ``cl``: the closed periods of each device from its first to its last reading."""
    return f"""{run_totals('hi', by='key', period=period, until=end)},
gaps AS (SELECT key, ts, watts, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY ts, tie)) AS gap_us
         FROM ev WHERE key IS NOT NULL AND ts >= TIMESTAMP '{fx.E_START}' AND ts < TIMESTAMP '{end}'),
ok AS (SELECT key, date_trunc('{period}', ts) AS p, bool_or(coalesce(gap_us >= 300000000 AND gap_us * watts > 0, false)) AS bad FROM gaps GROUP BY 1, 2),
seen AS (SELECT key, unnest(generate_series(CAST(date_trunc('{period}', min(ts)) AS TIMESTAMP), max(ts), INTERVAL 1 {period})) AS g FROM gaps GROUP BY key),
cl AS (SELECT seen.key, g AS p, coalesce(tot.us, 0) AS us, CASE WHEN coalesce(bad, false) THEN 'no' ELSE 'yes' END AS complete,
              CAST(g + INTERVAL 1 {period} AS TIMESTAMP) AS updated, CAST(hour(g) AS INTEGER) AS hour, CAST(dayofweek(g) AS INTEGER) AS dow,
              CAST(month(g) AS INTEGER) AS month, CAST(day(g) AS INTEGER) AS day, {doy_season('dayofyear(g)')} AS season
       FROM seen LEFT JOIN tot ON tot.key = seen.key AND tot.period_start = g LEFT JOIN ok ON ok.key = seen.key AND ok.p = g)"""


DEVICE_HOURS = device_closed_sql("hour", "2024-01-30 12:00:00")
DEVICE_DAYS = device_closed_sql("day", "2024-01-30 00:00:00")
DEVICE_MONTHS = device_closed_sql("month", "2024-02-01 00:00:00")


def device_grid(grid: str) -> str:
    return f"SELECT * FROM (SELECT DISTINCT key FROM cl) CROSS JOIN ({grid})"


def _closed_each(spark, sf, period, as_of):
    return closeout.closed_periods(
        fx.readings(spark, sf), fx.status_log(spark, sf), fx.thresholds(spark), period, fx.E_START, as_of, keys=fx.KEY)


@query("rpt_close_hour_by_device", f"""
WITH {DEVICE_HOURS}, {slot_sql(device_grid(HOURS), 'key, hour', 'hour = 12', '2024-01-30 12:00:00')} SELECT * FROM sl""")
def rpt_close_hour_by_device(spark, sf):
    return closeout.hour_table(_closed_each(spark, sf, "hour", fx.H_AS_OF), fx.H_AS_OF, fx.KEY)


@query("rpt_close_hour_sums_by_device", f"""
WITH {DEVICE_HOURS}
SELECT key, CAST(p AS DATE) AS sum_date, hour, us / 6e7 AS runtime, us * {BTU} / 3.6e9 AS btu, complete FROM cl""")
def rpt_close_hour_sums_by_device(spark, sf):
    return closeout.period_sums(_closed_each(spark, sf, "hour", fx.H_AS_OF), "hour", fx.KEY)


@query("rpt_close_hour_baselines_by_device", f"""
WITH {DEVICE_HOURS}, full_grid AS ({device_grid(GRID)})
""" + " UNION ALL ".join(_baseline_sql(s, ["key"]) for s in BASELINE_SLOTS))
def rpt_close_hour_baselines_by_device(spark, sf):
    return closeout.hour_baselines(_closed_each(spark, sf, "hour", fx.H_AS_OF), fx.KEY)


@query("rpt_close_day_by_device", f"""
WITH {DEVICE_DAYS}, {slot_sql(device_grid(DAYS), 'key, dow', 'dow = 2', '2024-01-30 00:00:00')} SELECT * FROM sl""")
def rpt_close_day_by_device(spark, sf):
    return closeout.dow_table(_closed_each(spark, sf, "day", fx.H_AS_OF), fx.H_AS_OF, fx.KEY)


@query("rpt_close_day_season_by_device", f"""
WITH {DEVICE_DAYS}, grid AS ({device_grid("SELECT DISTINCT dow, season FROM (" + GRID + ")")})
SELECT key, dow, season, CAST(coalesce(n, 0) AS INTEGER) AS count, coalesce(total * {BTU} / 3.6e9 / n, 0) AS btu_avg
FROM grid LEFT JOIN (SELECT key, dow, season, count(*) AS n, CAST(sum(us) AS BIGINT) AS total FROM cl GROUP BY ALL) USING (key, dow, season)""")
def rpt_close_day_season_by_device(spark, sf):
    return closeout.dow_season_table(_closed_each(spark, sf, "day", fx.H_AS_OF), fx.KEY)


@query("rpt_close_day_doy_by_device", f"""
WITH {DEVICE_DAYS}, {slot_sql(device_grid(CAL), 'key, month, day', 'month = 1 AND day = 30', '2024-01-30 00:00:00')}
SELECT sl.*, CASE WHEN month = 1 AND day = 30 THEN coalesce(cur, 0) ELSE 0 END AS previous_year,
       CASE WHEN month = 1 AND day = 30 THEN NULL ELSE coalesce(cur, 0) END AS current_year
FROM sl LEFT JOIN (SELECT key, month, day, us * {BTU} / 3.6e9 AS cur FROM cl) c USING (key, month, day)""")
def rpt_close_day_doy_by_device(spark, sf):
    return closeout.doy_table(_closed_each(spark, sf, "day", fx.H_AS_OF), fx.H_AS_OF, fx.KEY)


@query("rpt_close_month_by_device", f"""
WITH {DEVICE_MONTHS}, {slot_sql(device_grid(MONTHS), 'key, month', 'month = 2', '2024-02-01 00:00:00')}
SELECT sl.*, coalesce(py, 0) AS previous_year
FROM sl LEFT JOIN (SELECT key, month, us * {BTU} / 3.6e9 AS py FROM cl) c USING (key, month)""")
def rpt_close_month_by_device(spark, sf):
    return closeout.month_table(_closed_each(spark, sf, "month", MONTH_AS_OF), MONTH_AS_OF, fx.KEY)


# ---- gas ----------------------------------------------------------------------------------

_GAS_AS_OF = {"hour": fx.H_AS_OF, "dow": fx.H_AS_OF, "doy": fx.H_AS_OF, "month": MONTH_AS_OF, "year": YEAR_AS_OF}
_GAS_SLOT = {"hour": "hour(p)", "dow": "dayofweek(p)", "doy": "dayofyear(p)", "month": "month(p)", "year": "year(p)"}


def _gas_sql(slot, key=""):
    period = gas.SLOTS[slot]
    end = closeout.closed_end(period, _GAS_AS_OF[slot])
    reach = {"month": "day(min(ts)) = 1 AND day(max(ts)) = day(last_day(max(ts))) AND ",
             "year": "dayofyear(min(ts)) = 1 AND month(max(ts)) = 12 AND day(max(ts)) = 31 AND "}.get(period, "")
    now = _GAS_SLOT[slot].split("(")[0] + f"(TIMESTAMP '{end}')"
    lead = f"{key}, " if key else ""
    return f"""
WITH {SCORED_EACH if key else SCORED},
pd AS (SELECT {lead}date_trunc('{period}', ts) AS p, coalesce(sum({HEAT_SQL}), 0) AS btu,
              CASE WHEN {reach}max(gap_us) < 300000000 THEN 'yes' ELSE 'no' END AS complete
       FROM sc WHERE ts < TIMESTAMP '{end}' GROUP BY ALL),
nw AS (SELECT {lead}{_GAS_SLOT[slot]} AS {slot}, arg_max(btu, p) AS btu, arg_max(complete, p) AS complete,
              CAST(max(p) + INTERVAL 1 {period} AS TIMESTAMP) AS updated FROM pd GROUP BY ALL)
SELECT {lead}CAST({slot} AS INTEGER) AS {slot}, round(btu, 3) AS btu, complete, updated FROM nw WHERE {slot} <> {now}
UNION ALL SELECT {lead}CAST({now} AS INTEGER), 0, 'no', TIMESTAMP '{end}'{" FROM (SELECT DISTINCT key FROM pd)" if key else ""}"""


def _gas(slot):
    @query(f"rpt_gas_{slot}", _gas_sql(slot))
    def report(spark, sf):
        r, log = fx.one_device(fx.readings(spark, sf)), fx.one_device(fx.status_log(spark, sf))
        x = gas.scored(r, log, fx.E_START, YEAR_AS_OF)
        return gas.gas_usage(x, slot, _GAS_AS_OF[slot]).withColumn("btu", F.round("btu", 3))

    @query(f"rpt_gas_{slot}_by_device", _gas_sql(slot, "key"))
    def each(spark, sf):
        x = gas.scored(fx.readings(spark, sf), fx.status_log(spark, sf), fx.E_START, YEAR_AS_OF, keys=fx.KEY)
        return gas.gas_usage(x, slot, _GAS_AS_OF[slot], fx.KEY).withColumn("btu", F.round("btu", 3))

    return report, each


for _slot in gas.SLOTS:
    _gas(_slot)


@query("rpt_last_hour", f"""
WITH {SCORED} SELECT ts, CAST(watts AS DOUBLE) AS watts, mode AS status, round(heatcall, 6) AS heatcall,
  CAST(round(heatcall / 100 * 60000) AS INTEGER) AS btuph
FROM sc WHERE ts >= TIMESTAMP '2024-01-30 11:00:00' AND ts <= TIMESTAMP '2024-01-30 12:34:00'""")
def rpt_last_hour(spark, sf):
    r, log = fx.one_device(fx.readings(spark, sf)), fx.one_device(fx.status_log(spark, sf))
    f = gas.firing_rate(r, log, fx.H_AS_OF)
    return f.withColumns({"watts": F.col("watts").cast("double"), "heatcall": F.round("heatcall", 6)})
