"""The stored hourly rollup: fed by batches, read by reports."""

import frames
from pyspark.sql import functions as F

from emberline.operators import snapshots
from emberline.plans import charts
from emberline.session import scratch_path
from emberline.sources import fixtures as fx
from emberline.streaming import rollup

WATTS = "watts"


def _rows(df):
    return sorted(map(str, df.collect()))


def _readings(spark):
    return frames.readings(spark, [(1, f"1{h}:{m:02d}:00", h + m) for h in range(5) for m in (0, 20, 40)] + [(2, "2024-01-06 00:10:00", 7), (None, "10:05:00", 1)])


def test_batches_add_up_once_each(spark):
    r, path = _readings(spark), scratch_path(spark, "rollup")
    totals = rollup.hour_totals(r, "ts", WATTS, ["key"])
    want, want_columns = _rows(totals), totals.columns
    for number in (0, 1, 1, 0, 2):  # an hour is touched by all three
        rollup.add_batch(path, r.where(F.col("tie") % 3 == number), number, "ts", WATTS, ["key"])
    assert _rows(snapshots.read(spark, path).select(want_columns)) == want
    assert snapshots.snapshot(spark, path, snapshots.numbers(spark, path)[-1])["batch"] == 2


def test_a_batch_that_fails_is_added_once(spark, monkeypatch):
    r, path, real, calls = _readings(spark), scratch_path(spark, "rollup"), snapshots.commit, []

    def fails_after(*how):
        done = real(*how)
        calls.append(done)
        if len(calls) == 2:
            raise RuntimeError("lost after the change was in place")
        return done

    monkeypatch.setattr(snapshots, "commit", fails_after)
    try:
        rollup.add_batch(path, r, 0, "ts", WATTS)
    except RuntimeError:
        rollup.add_batch(path, r, 0, "ts", WATTS)
    assert len(calls) == 2 and _rows(rollup.stored_hours(spark, path)) == _rows(rollup.hour_totals(r, "ts", WATTS).drop(rollup.MONTH))


def test_a_stream_goes_on_and_counts_late_rows(spark):
    r = _readings(spark)
    feed, path, checkpoint = scratch_path(spark, "feed"), scratch_path(spark, "rollup"), scratch_path(spark, "state")
    r.where("hour(ts) >= 12").coalesce(1).write.parquet(feed)
    run = lambda: rollup.maintain(spark.readStream.schema(r.schema).option("maxFilesPerTrigger", 1).parquet(feed), path, "ts", WATTS, checkpoint=checkpoint)
    run()
    r.where("hour(ts) < 12").repartition(2).write.mode("append").parquet(feed)
    assert _rows(run()) == _rows(rollup.hour_totals(r, "ts", WATTS).drop(rollup.MONTH))
    assert _rows(run()) == _rows(rollup.hour_totals(r, "ts", WATTS).drop(rollup.MONTH))


def test_reports_from_the_rollup_scan_no_readings(spark, small):
    raw = fx.order_hours(spark, small)
    at = F.timestamp_add("HOUR", (F.col("o_orderkey") % 24).cast("int"), F.to_date("o_orderdate").cast("timestamp_ntz"))
    orders = fx.table(spark, small, "orders").withColumn("ts", at).where(F.col("ts") <= F.lit(fx.O_AS_OF).cast("timestamp_ntz"))
    path = scratch_path(spark, "rollup")
    for number in (0, 1):
        rollup.add_batch(path, orders.where(F.col("o_custkey") % 2 == number), number, "ts", fx.order_minutes())
    stored = rollup.stored_hours(spark, path)
    for report in (lambda h: charts.daily_vs_last_year(h, 30), lambda h: charts.week_vs_usual(h, h, True), lambda h: charts.week_vs_usual(h, h, False)):
        assert _rows(report(stored)) == _rows(report(raw))
        assert "orders.parquet" not in report(stored)._jdf.queryExecution().toString()
