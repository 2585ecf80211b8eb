"""Scalar functions, one query per theme."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.registry import query
from emberline.functions import calendar as cal
from emberline.functions import energy, labels
from emberline.plans import charts
from emberline.sources.files import table


@query("fn_calendar", """
SELECT event_id, hour(ts) AS h, day(ts) AS d, month(ts) AS m, year(ts) AS y, dayofweek(ts) AS dow, dayofyear(ts) AS doy,
       CAST(date_trunc('hour', ts) AS TIMESTAMP) AS hour_start, CAST(date_trunc('month', ts) AS TIMESTAMP) AS month_start,
       CAST(date_trunc('year', ts) AS TIMESTAMP) AS year_start, day(last_day(ts)) AS days,
       CAST(date_trunc('hour', ts) - INTERVAL 1 HOUR AS TIMESTAMP) AS last_hour,
       CAST(date_trunc('day', ts) - INTERVAL 1 DAY AS TIMESTAMP) AS last_day,
       CAST(date_trunc('month', ts) - INTERVAL 1 MONTH AS TIMESTAMP) AS last_month,
       CAST(date_trunc('year', ts) - INTERVAL 1 YEAR AS TIMESTAMP) AS last_year, true AS leap
FROM events""")
def fn_calendar(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select(
        "event_id", F.hour(ts).alias("h"), F.dayofmonth(ts).alias("d"), F.month(ts).alias("m"), F.year(ts).alias("y"),
        cal.dow(ts).alias("dow"), F.dayofyear(ts).alias("doy"), cal.period_start("hour", ts).alias("hour_start"),
        cal.period_start("month", ts).alias("month_start"), cal.period_start("year", ts).alias("year_start"),
        cal.days_in_month(ts).alias("days"),
        *[cal.previous_period(p, ts)[0].alias(f"last_{p}") for p in cal.PERIODS],
        cal.is_leap(F.year(ts)).alias("leap"))


@query("fn_time_math", """
SELECT event_id, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6 AS seconds,
       CAST(date_trunc('minute', ts) AS TIMESTAMP) AS minute_start, ts + INTERVAL 1 HOUR AS next_hour,
       ts - INTERVAL 1 DAY AS yesterday, CAST(CAST(ts AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month,
       CAST(CAST(ts AS DATE) - INTERVAL 1 YEAR AS DATE) AS year_ago,
       CAST(CAST(ts AS DATE) - DATE '2023-12-25' AS INTEGER) AS days, 1 - hour(ts) / 24e0 AS day_left,
       CAST(floor(epoch(ts)) AS BIGINT) AS epoch_s
FROM events""")
def fn_time_math(spark, sf):
    ts, d = F.col("ts"), F.to_date("ts")
    return table(spark, sf, "events").select(
        "event_id", (cal.micros_between(cal.ntz("2024-01-01 00:00:00"), ts) / 1e6).alias("seconds"),
        cal.period_start("minute", ts).alias("minute_start"),
        (ts + F.expr("INTERVAL 1 HOUR")).alias("next_hour"), (ts - F.expr("INTERVAL 1 DAY")).alias("yesterday"),
        F.add_months(d, 1).alias("next_month"), F.add_months(d, -12).alias("year_ago"),
        F.datediff(d, F.lit("2023-12-25").cast("date")).alias("days"),
        (1 - F.hour(ts) / F.lit(24.0)).alias("day_left"), cal.epoch_seconds(ts).alias("epoch_s"))


@query("fn_align", """
SELECT o_orderkey, make_date(2000, month(o_orderdate), day(o_orderdate)) AS in_2000,
       CAST(CAST(o_orderdate AS DATE) + to_years(CAST(2001 - year(o_orderdate) AS INTEGER)) AS DATE) AS this_year,
       CAST(o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + INTERVAL 3599 SECOND AS TIMESTAMP) AS end_of_hour,
       CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 23:59:59' AS TIMESTAMP) AS end_of_day,
       CAST(o_orderkey % 24 AS INTEGER) AS clock_hour
FROM orders""")
def fn_align(spark, sf):
    o = table(spark, sf, "orders")
    d, hour = F.to_date("o_orderdate"), (F.col("o_orderkey") % 24).cast("int")
    clock = F.format_string("%02d:15:00", hour)
    return o.select(
        "o_orderkey", F.make_date(F.lit(2000), F.month(d), F.dayofmonth(d)).alias("in_2000"),
        F.to_date(charts.plot_stamp(d.cast("timestamp_ntz"), 2001)).alias("this_year"),
        F.timestamp_add("SECOND", F.lit(3599), cal.at_hour(d, hour)).alias("end_of_hour"),
        F.to_timestamp_ntz(F.concat(d.cast("string"), F.lit(" 23:59:59"))).alias("end_of_day"),
        F.hour(F.to_timestamp_ntz(F.concat(F.lit("2000-01-01 "), clock))).alias("clock_hour"))


@query("fn_labels", """
SELECT o_orderkey, strftime(o_orderdate, '%b') || ' - ' || strftime(o_orderdate, '%d') AS day_label,
       strftime(o_orderdate, '%A') AS weekday, strftime(o_orderdate, '%b') AS month_name,
       printf('Order of %s: %d on day %02d', o_orderstatus, o_custkey, dayofyear(o_orderdate) % 100) AS line
FROM orders""")
def fn_labels(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", labels.day_label(d).alias("day_label"), labels.weekday_name(d).alias("weekday"),
        labels.month_name(d).alias("month_name"),
        F.format_string("Order of %s: %d on day %02d", "o_orderstatus", "o_custkey", F.dayofyear(d) % 100).alias("line"))


@query("fn_math", """
SELECT l_orderkey, l_linenumber, CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) / 100, 0) AS BIGINT) AS hundreds,
       CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)), 1) AS DOUBLE) AS tenths,
       pow(l_quantity, 3) AS cubed, l_extendedprice / 60 AS hours, l_extendedprice / 60 * 0.666205227383988e0 AS gallons
FROM lineitem""".replace("CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)) / 100, 0) AS BIGINT)",
                         "CAST(round(CAST(l_extendedprice AS DECIMAL(12,2)), -2) AS BIGINT) // 100"))
def fn_math(spark, sf):
    price = F.col("l_extendedprice")
    exact = price.cast("decimal(12,2)")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(exact / 100, 0).cast("long").alias("hundreds"),
        energy.rounded(exact, 1).cast("double").alias("tenths"), F.pow("l_quantity", F.lit(3)).alias("cubed"),
        (price / 60).alias("hours"), energy.gallons_of_minutes(price).alias("gallons"))
