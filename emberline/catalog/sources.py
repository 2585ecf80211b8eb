"""Sources, sinks and table maintenance."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from emberline.catalog.registry import doy_season, event_hours, order_hours, query
from emberline.functions.calendar import dow, meteorological_season, ntz
from emberline.operators import chunks, quality, rollups, snapshots, tables
from emberline.plans import charts
from emberline.session import scratch_path
from emberline.sources import files, fixtures as fx, series

SPLIT = "2024-01-20"


@query("src_tsv", """
SELECT c_custkey, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment END AS segment, c_acctbal, c_name
FROM customer""")
def src_tsv(spark, sf):
    path = scratch_path(spark, "tsv")
    files.write_tsv(files.table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment")).alias("segment"),
        "c_acctbal", "c_name"), path)
    return files.read_tsv(spark, path, "c_custkey LONG, segment STRING, c_acctbal DOUBLE, c_name STRING")


@query("src_csv", """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate + INTERVAL 90 MINUTE AS stamp FROM orders""")
def src_csv(spark, sf):
    path = scratch_path(spark, "csv")
    o = files.table(spark, sf, "orders")
    text = F.date_format(F.timestamp_add("MINUTE", F.lit(90), F.col("o_orderdate")), "yyyy/MM/dd HH:mm:ss")
    files.write_csv(o.select("o_orderkey", "o_orderstatus", "o_totalprice", text.alias("stamp")), path)
    back = files.read_csv(spark, path)
    return back.withColumns({
        "o_orderkey": F.col("o_orderkey").cast("long"),
        "stamp": F.to_timestamp_ntz(F.col("stamp").cast("string"), F.lit("yyyy/MM/dd HH:mm:ss")),
    })


@query("json_extract", """
SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER) AS k FROM events""")
def json_extract(spark, sf):
    doc = F.from_json("props", "k INT")
    return files.table(spark, sf, "events").select("event_id", doc["k"].alias("k"))


@query("series_int", """
SELECT CAST(h AS INTEGER) AS hour, count(e.event_id) AS n
FROM range(24) g(h) LEFT JOIN events e ON hour(e.ts) = h GROUP BY 1""")
def series_int(spark, sf):
    n = files.table(spark, sf, "events").groupBy(F.hour("ts").alias("hour")).agg(F.count("event_id").alias("n"))
    return series.integers(spark, 0, 23, "hour").join(n, "hour", "left").fillna(0, ["n"])


@query("series_time", """
SELECT CAST(t AS TIMESTAMP) AS hour_start, count(e.event_id) AS n
FROM (SELECT unnest(generate_series(date_trunc('hour', min(ts)), max(ts), INTERVAL 1 HOUR)) AS t FROM events) g
LEFT JOIN events e ON date_trunc('hour', e.ts) = t GROUP BY 1""")
def series_time(spark, sf):
    e = files.table(spark, sf, "events")
    at = F.timestamp_add("HOUR", F.hour("ts"), F.to_date("ts").cast("timestamp_ntz"))
    n = e.groupBy(at.alias("hour_start")).agg(F.count("event_id").alias("n"))
    bounds = n.agg(F.min("hour_start").alias("lo"), F.max("hour_start").alias("hi"))
    return series.spine(bounds, "lo", "hi", "1 HOUR", "hour_start").join(n, "hour_start", "left").fillna(0, ["n"])


@query("calendar_doy", """
WITH c AS (SELECT CAST(d AS DATE) AS d FROM generate_series(DATE '2000-01-01', DATE '2000-12-31', INTERVAL 1 DAY) g(d)),
k AS (SELECT month(d) AS month, day(d) AS day, dayofyear(d) AS doy_leap,
             CASE WHEN strftime(d, '%m%d') = '0229' THEN NULL
                  ELSE dayofyear(make_date(2001, month(d), day(d))) END AS doy_noleap
      FROM c),
o AS (SELECT month(o_orderdate) AS month, day(o_orderdate) AS day, count(*) AS n FROM orders GROUP BY ALL)
SELECT k.*, coalesce(n, 0) AS n FROM k LEFT JOIN o USING (month, day)""".replace(
    "dayofyear(make_date(2001, month(d), day(d)))",
    "dayofyear(TRY_CAST('2001-' || strftime(d, '%m-%d') AS DATE))"))
def calendar_doy(spark, sf):
    d = F.col("o_orderdate")
    n = files.table(spark, sf, "orders").groupBy(F.month(d).alias("month"), F.dayofmonth(d).alias("day")).agg(
        F.count("*").alias("n"))
    return series.calendar(spark).join(n, ["month", "day"], "left").fillna(0, ["n"])


@query("slot_grid", f"""
WITH {order_hours(as_of=None)},
n AS (SELECT hour, dayofweek(sum_date) AS dow, {doy_season('dayofyear(sum_date)')} AS season, count(*) AS n
      FROM oh GROUP BY ALL)
SELECT CAST(h AS INTEGER) AS hour, CAST(w AS INTEGER) AS dow, s AS season, coalesce(n, 0) AS n
FROM range(24) a(h), range(7) b(w), (VALUES ('winter'), ('spring'), ('summer'), ('fall')) c(s)
LEFT JOIN n ON n.hour = h AND n.dow = w AND n.season = s""")
def slot_grid(spark, sf):
    h = fx.order_hours(spark, sf, as_of=None)
    n = h.groupBy("hour", dow(F.col("sum_date")).alias("dow"),
                  meteorological_season(F.dayofyear("sum_date")).alias("season")).agg(F.count("*").alias("n"))
    return series.slot_grid(spark).join(n, ["hour", "dow", "season"], "left").fillna(0, ["n"])


def _hours(spark, sf):
    return fx.event_hours(spark, sf, as_of=None)


def _money(df, *cols):
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


@query("append_rows", f"WITH {event_hours(as_of=None)} SELECT sum_date, hour, rc / 100e0 AS runtime FROM hh")
def append_rows(spark, sf):
    path = scratch_path(spark, "append")
    h = _hours(spark, sf)
    early = F.col("sum_date") < F.lit(SPLIT).cast("date")
    for part in (h.where(early), h.where(~early)):
        part.write.mode("append").parquet(path)
    return _money(spark.read.parquet(path), "runtime")


@query("upsert_hourly", f"""
WITH {event_hours(as_of=None)}
SELECT sum_date, hour, CASE WHEN sum_date >= DATE '{SPLIT}' THEN 2 * rc ELSE rc END / 100e0 AS runtime
FROM hh WHERE sum_date < DATE '2024-01-25' OR sum_date >= DATE '{SPLIT}'""")
def upsert_hourly(spark, sf):
    path = scratch_path(spark, "upsert")
    h = _hours(spark, sf).withColumn("runtime", F.col("runtime").cast("decimal(28,2)"))
    snapshots.create(spark, path, h.schema)
    snapshots.upsert_days(path, h.where(F.col("sum_date") < F.lit("2024-01-25").cast("date")), ["sum_date", "hour"])
    new = h.where(F.col("sum_date") >= F.lit(SPLIT).cast("date"))
    new = new.withColumn("runtime", (F.col("runtime") * 2).cast("decimal(28,2)"))
    snapshots.upsert_days(path, new, ["sum_date", "hour"])
    return _money(snapshots.read(spark, path), "runtime")


@query("insert_ignore", f"""
WITH {event_hours(as_of=None)}
SELECT sum_date, hour, CASE WHEN sum_date < DATE '{SPLIT}' THEN rc ELSE rc + 100 END / 100e0 AS runtime FROM hh""")
def insert_ignore(spark, sf):
    h = _hours(spark, sf)
    old = h.where(F.col("sum_date") < F.lit(SPLIT).cast("date"))
    new = h.withColumn("runtime", F.col("runtime") + 1)
    return _money(tables.insert_ignore(old, new, ["sum_date", "hour"]), "runtime")


_MONTHS = "SELECT year(sum_date) AS year, month(sum_date) AS month, sum(rc) AS rc FROM oh GROUP BY ALL"


@query("keyed_update", f"""
WITH {order_hours()}, m AS ({_MONTHS})
SELECT year, month, CASE WHEN year >= 2000 THEN (rc + 50000) / 100e0 ELSE rc / 100e0 END AS runtime,
       year >= 2000 AS changed FROM m""")
def keyed_update(spark, sf):
    m = rollups.monthly_sums(fx.order_hours(spark, sf))
    new = m.where(F.col("year") >= 2000).withColumn("runtime", F.col("runtime") + 500)
    return _money(tables.keyed_update(m, new, ["year", "month"], ["runtime"]), "runtime")


_SLOTS = """s AS (SELECT hour, arg_max(rc, sum_date) AS rc, max(sum_date) AS d FROM oh GROUP BY hour)"""


@query("slot_reset", f"""
WITH {order_hours()}, {_SLOTS}
SELECT hour, CASE WHEN hour = 12 THEN 0 ELSE rc / 100e0 END AS btu,
       CASE WHEN hour = 12 THEN 'no' ELSE 'yes' END AS complete,
       CASE WHEN hour = 12 THEN TIMESTAMP '2001-07-15 12:00:00' ELSE CAST(d AS TIMESTAMP) END AS updated FROM s""")
def slot_reset(spark, sf):
    s = fx.order_hours(spark, sf).groupBy("hour").agg(F.max_by(F.struct("runtime", "sum_date"), "sum_date").alias("n"))
    s = s.select("hour", F.col("n.runtime").cast("double").alias("btu"), F.lit("yes").alias("complete"),
                 F.col("n.sum_date").cast("timestamp_ntz").alias("updated"))
    return tables.reset_slot(s, F.col("hour") == F.hour(ntz(fx.O_AS_OF)), fx.O_AS_OF[:13] + ":00:00")


@query("year_roll", f"""
WITH {order_hours()},
d AS (SELECT sum_date, sum(rc) / 100e0 AS v FROM oh GROUP BY 1),
p AS (SELECT month(sum_date) AS month, day(sum_date) AS day, sum_date, v,
             lag(v) OVER (PARTITION BY month(sum_date), day(sum_date) ORDER BY sum_date) AS b FROM d),
l AS (SELECT month, day, arg_max(v, sum_date) AS v, (list(b ORDER BY sum_date DESC))[1] AS b FROM p GROUP BY 1, 2)
SELECT month, day, CASE WHEN month = 7 AND day = 15 THEN v ELSE b END AS previous_year,
       CASE WHEN month = 7 AND day = 15 THEN NULL ELSE v END AS current_year FROM l""")
def year_roll(spark, sf):
    d = rollups.daily_sums(fx.order_hours(spark, sf)).withColumns({
        "month": F.month("sum_date"), "day": F.dayofmonth("sum_date"), "v": F.col("runtime").cast("double")})
    d = d.withColumn("b", F.lag("v").over(Window.partitionBy("month", "day").orderBy("sum_date")))
    t = d.groupBy("month", "day").agg(F.max_by(F.struct("v", "b"), "sum_date").alias("n")).select(
        "month", "day", F.col("n.b").alias("previous_year"), F.col("n.v").alias("current_year"))
    return tables.roll_year(t, (F.col("month") == 7) & (F.col("day") == 15))


@query("constraint_report", """
SELECT 'value known' AS rule, count(*) FILTER (WHERE value IS NULL) AS violations FROM events
UNION ALL SELECT 'type known', count(*) FILTER (WHERE event_type NOT IN ('signup', 'error', 'click', 'view')) FROM events
UNION ALL SELECT 'value in range', count(*) FILTER (WHERE NOT value BETWEEN 0 AND 300) FROM events
UNION ALL SELECT 'hour in range', count(*) FILTER (WHERE NOT hour(ts) BETWEEN 0 AND 23) FROM events
UNION ALL SELECT 'id unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) n FROM events GROUP BY event_id)
UNION ALL SELECT 'device and hour unique', CAST(coalesce(sum(n - 1), 0) AS BIGINT)
  FROM (SELECT count(*) n FROM events GROUP BY user_id, date_trunc('hour', ts))""")
def constraint_report(spark, sf):
    e = files.table(spark, sf, "events").withColumns({"day": F.to_date("ts"), "hour": F.hour("ts")})
    return quality.rule_violations(e, {
        "value known": F.col("value").isNotNull(),
        "type known": F.col("event_type").isin("signup", "error", "click", "view"),
        "value in range": F.col("value").between(0, 300),
        "hour in range": F.col("hour").between(0, 23),
    }, {"id unique": ["event_id"], "device and hour unique": ["user_id", "day", "hour"]})


@query("surrogate_key", """
SELECT row_number() OVER (ORDER BY ts, event_id) AS id, event_id,
       coalesce(CASE WHEN event_type <> 'click' THEN event_type END, 'none') AS status FROM events""")
def surrogate_key(spark, sf):
    e = files.table(spark, sf, "events").select(
        "event_id", "ts", F.coalesce(F.when(F.col("event_type") != "click", F.col("event_type")), F.lit("none")).alias("status"))
    span = chunks.chunk_of(F.col("ts"), chunks.choose_chunk(e, [], "ts") or 86400)
    return tables.with_surrogate_key(e, "id", span, ["ts", "event_id"]).drop("ts")


@query("chart_export", f"""
WITH {order_hours()}
SELECT 'daily' AS chart, strftime(sum_date, '%Y-%m-%d') AS label, sum(rc) / 100e0 AS runtime FROM oh GROUP BY 2
UNION ALL SELECT 'yearly', CAST(year(sum_date) AS VARCHAR), sum(rc) / 100e0 / 60 FROM oh GROUP BY 2""")
def chart_export(spark, sf):
    path = scratch_path(spark, "charts")
    h = fx.order_hours(spark, sf)
    files.export_chart(charts.daily_vs_last_year(h).select(
        F.date_format("sum_date", "yyyy-MM-dd").alias("label"), "runtime"), path, "daily")
    files.export_chart(charts.years(h, fx.O_AS_OF).select(F.col("label").cast("string"), "runtime"), path, "yearly")
    return spark.read.parquet(path).select("chart", "label", "runtime")
