"""Structured Streaming: each query drives a stream over the feed to its end and reads its sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from emberline.catalog.aggregates import totals_sql
from emberline.catalog.registry import classified, query, run_totals
from emberline.session import scratch_path
from emberline.sources import fixtures as fx
from emberline.streaming import hourly, keyed, rollup, runs


WHOLE = "40 days"  # the files of the feed may be in any order


def _windows(spark, sf):
    feed = hourly.feed(spark, sf, "events.parquet")
    return hourly.hourly(feed, "ts", F.col("value").cast("decimal(10,2)"))


_HOURS = """h AS (SELECT CAST(ts AS DATE) AS sum_date, hour(ts) AS hour,
  sum(CAST(round(value * 100) AS BIGINT)) / 100e0 AS runtime, count(*) AS n,
  CAST(date_trunc('hour', min(ts)) + INTERVAL 1 HOUR AS TIMESTAMP) AS he FROM events GROUP BY 1, 2),
wm AS (SELECT max(ts) - INTERVAL 1 HOUR AS m FROM events)"""


def _plain(df):
    return df.withColumn("runtime", F.col("runtime").cast("double"))


@query("stream_hourly", f"WITH {_HOURS} SELECT sum_date, hour, runtime, n FROM h, wm WHERE he <= m")
def stream_hourly(spark, sf):
    return _plain(hourly.closed_hours(_windows(spark, sf)))


@query("stream_upsert", f"WITH {_HOURS} SELECT sum_date, hour, runtime, n FROM h")
def stream_upsert(spark, sf):
    return _plain(hourly.upserted_hours(_windows(spark, sf))).select("sum_date", "hour", "runtime", "n")


@query("stream_live_hour", f"WITH {_HOURS} SELECT sum_date, hour, runtime, n, he <= m AS closed FROM h, wm")
def stream_live_hour(spark, sf):
    live = hourly.live_hours(_windows(spark, sf))
    return _plain(live).select("sum_date", "hour", "runtime", "n", "closed")


@query("hour_close_gaps", """
WITH h AS (SELECT user_id AS key, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS t0, count(*) AS n FROM events GROUP BY 1, 2),
x AS (SELECT *, lead(t0) OVER (PARTITION BY key ORDER BY t0) AS next_at FROM h)
SELECT key, CAST(t0 AS DATE) AS sum_date, hour(t0) AS hour, n, next_at,
       CAST(date_diff('hour', t0, next_at) - 1 AS INTEGER) AS hours_skipped, hour(next_at) = (hour(t0) + 1) % 24 AS trigger_fires
FROM x WHERE date_diff('hour', t0, next_at) > 1 OR hour(next_at) <> (hour(t0) + 1) % 24""")
def hour_close_gaps(spark, sf):
    return hourly.hour_close_gaps(fx.readings(spark, sf), fx.KEY)


@query("stream_runs", f"""
WITH {classified('hi')} SELECT key, tie AS event_id, main_status, system_status, gap_us / 1e6 AS tdiff, run_id FROM cls""")
def stream_runs(spark, sf):
    feed = hourly.feed(spark, sf, "events.parquet")
    r = feed.select(F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
                    F.col("value").cast("decimal(10,2)").alias("watts"))
    log = feed.where(F.col("event_type").isin("signup", "error")).select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
        F.when(F.col("event_type") == "signup", "ON").otherwise("OFF").alias("status"))
    out = runs.stream_runs(r, log, fx.thresholds(spark), "hi", fx.E_END, delay=WHOLE)
    return out.select("key", F.col("tie").alias("event_id"), "main_status", "system_status",
                      (F.col("gap_us") / 1e6).alias("tdiff"), "run_id")


@query("stream_runs_by_batch", f"""
WITH {classified('hi')} SELECT key, tie AS event_id, main_status, system_status, gap_us / 1e6 AS tdiff, run_id FROM cls""")
def stream_runs_by_batch(spark, sf):
    feed = hourly.feed(spark, sf, "events.parquet").select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
        F.col("value").cast("decimal(10,2)").alias("watts"),
        F.when(F.col("event_type") == "signup", "ON").when(F.col("event_type") == "error", "OFF").alias("status"))
    out = runs.stream_runs_by_batch(feed, fx.thresholds(spark), "hi", fx.E_START, fx.E_END, delay=WHOLE)
    return out.select("key", F.col("tie").alias("event_id"), "main_status", "system_status",
                      (F.col("gap_us") / 1e6).alias("tdiff"), "run_id")


@query("stream_runs_keyed", f"""
WITH {classified('hi')} SELECT key, tie AS event_id, main_status, system_status, gap_us / 1e6 AS tdiff, run_id FROM cls""")
def stream_runs_keyed(spark, sf):
    feed = hourly.feed(spark, sf, "events.parquet").select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
        F.col("value").cast("decimal(10,2)").alias("watts"), F.lit(None).cast("string").alias("status"),
        F.when(F.col("event_type") == "signup", "ON").when(F.col("event_type") == "error", "OFF").alias("mark"))
    entry = F.struct("key", "ts", "tie", F.lit(None).cast("decimal(10,2)").alias("watts"), F.col("mark").alias("status"))
    both = F.filter(F.array(F.struct("key", "ts", "tie", "watts", "status"), entry), lambda r: r.watts.isNotNull() | r.status.isNotNull())
    rows = feed.select(F.explode(both).alias("r")).select("r.*")  # an event is a reading, and some are log entries, too
    out = keyed.stream_runs(rows, fx.thresholds(spark), "hi", fx.E_START, fx.E_END, scratch_path(spark, "run-rows"),
                            scratch_path(spark, "run-state"), delay=WHOLE)
    return out.select("key", F.col("tie").alias("event_id"), "main_status", "system_status", (F.col("gap_us") / 1e6).alias("tdiff"), "run_id")


@query("stream_hour_summary", f"WITH {run_totals('hi', period='hour')} {totals_sql('key, period_start, ')}")
def stream_hour_summary(spark, sf):
    feed = hourly.feed(spark, sf, "events.parquet").select(
        F.col("user_id").alias("key"), "ts", F.col("event_id").alias("tie"),
        F.col("value").cast("decimal(10,2)").alias("watts"),
        F.when(F.col("event_type") == "signup", "ON").when(F.col("event_type") == "error", "OFF").alias("status"))
    out = runs.stream_hour_summaries(feed, fx.thresholds(spark), "hi", fx.E_START, fx.E_END, delay=WHOLE)
    return out.drop("run_us")


@query("stream_rollup", f"WITH {_HOURS} SELECT sum_date, hour, runtime, n FROM h")
def stream_rollup(spark, sf):
    """The stored rollup, fed by a stream; then its last batch comes once more."""
    feed = hourly.feed(spark, sf, "events.parquet")
    amount = F.col("value").cast("decimal(10,2)")
    path = scratch_path(spark, "rollup")
    rollup.maintain(feed, path, "ts", amount)
    rollup.add_batch(path, fx.table(spark, sf, "events"), 0, "ts", amount)
    return _plain(rollup.stored_hours(spark, path)).select("sum_date", "hour", "runtime", "n")
