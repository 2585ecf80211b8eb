"""Streams over several files against the batch forms."""

import random

import frames
import pytest
from pyspark.sql import functions as F

from emberline.operators import runs as batch
from emberline.session import scratch_path
from emberline.streaming import hourly, runs


def _folder(spark, parts):
    path = scratch_path(spark, "feed")
    for df in parts:
        df.coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, path):
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _feed(spark):
    """Readings and log entries of two devices, cut into three micro-batches."""
    r = frames.readings(spark, [(1, "10:00:00", 80), (1, "10:01:00", 5), (2, "10:01:00", 80), (1, "10:02:00", 90),
                                (1, "10:03:00", 91), (2, "10:04:00", 10), (1, "10:05:00", 3), (1, "10:06:00", 70)])
    lg = frames.log(spark, [(1, "09:00:00", "ON"), (1, "10:01:10", "OFF"), (1, "10:01:40", "ON"), (2, "10:02:00", "ON"), (1, "10:05:30", "OFF")])
    feed = r.withColumn("status", F.lit(None).cast("string")).unionByName(
        lg.withColumn("watts", F.lit(None).cast("decimal(10,2)")))
    cuts = [("09:00:00", "10:01:30"), ("10:01:30", "10:02:30"), ("10:02:30", "11:00:00")]
    parts = [feed.where((F.col("ts") >= F.lit(f"2024-01-05 {a}").cast("timestamp_ntz"))
                        & (F.col("ts") < F.lit(f"2024-01-05 {b}").cast("timestamp_ntz"))) for a, b in cuts]
    want = batch.classify_runs(r, lg, frames.thresholds(spark), ["key"], "hi", "2024-01-01 00:00:00",
                               "2024-02-01 00:00:00", seconds=None)
    return _stream(spark, _folder(spark, parts)), want


def _sorted(df):
    cols = ("key", "ts", "gap_us", "main_status", "system_status", "run_id")
    return sorted((tuple(x) for x in df.select(*cols).collect()), key=lambda t: t[:2])


def test_runs_carry_over_micro_batches(spark):
    s, want = _feed(spark)
    got = runs.stream_runs(s.where("status IS NULL").select("key", "ts", "tie", "watts"),
                           s.where("status IS NOT NULL").select("key", "ts", "tie", "status"),
                           frames.thresholds(spark), "hi", "2024-02-01 00:00:00")
    assert _sorted(got) == _sorted(want)


def test_runs_by_batch_carry_over_micro_batches(spark):
    for seconds in (None, 60):
        s, want = _feed(spark)
        got = runs.stream_runs_by_batch(
            s, frames.thresholds(spark), "hi", "2024-01-01 00:00:00", "2024-02-01 00:00:00", seconds)
        assert _sorted(got) == _sorted(want)


def _long_feed(spark):
    """Two devices over five hours, with log entries at, before and between readings."""
    rng = random.Random(3)
    rows = [(rng.randint(1, 2), f"1{h}:{m:02d}:{rng.randint(0, 59):02d}", rng.choice([0, 5, 30, 70, 90])) for h in range(5) for m in range(0, 60, 4)]
    marks = [(rng.randint(1, 2), f"1{h}:{m:02d}:30", rng.choice(["ON", "ON", "OFF"])) for h in range(5) for m in range(1, 60, 9)]
    r, lg = frames.readings(spark, rows), frames.log(spark, marks)
    feed = r.withColumn("status", F.lit(None).cast("string")).unionByName(lg.withColumn("watts", F.lit(None).cast("decimal(10,2)")))
    return r, lg, feed


SPAN = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")


@pytest.mark.parametrize("cut", ["by id", "reverse", "log ahead"])
def test_runs_do_not_depend_on_how_the_feed_is_cut(spark, cut):
    r, lg, feed = _long_feed(spark)
    want = batch.classify_runs(r, lg, frames.thresholds(spark), ["key"], "hi", *SPAN, seconds=None)
    hour = lambda *h: feed.where(F.hour("ts").isin(*h))
    parts = {"by id": [feed.where("tie % 2 = 0"), feed.where("tie % 2 = 1")], "reverse": [hour(13, 14), hour(12), hour(10, 11)],
             "log ahead": [feed.where("status IS NOT NULL"), hour(10, 11).where("status IS NULL"), hour(12, 13, 14).where("status IS NULL")]}[cut]
    got = runs.stream_runs_by_batch(_stream(spark, _folder(spark, parts)), frames.thresholds(spark), "hi", *SPAN, None, delay="1 day")
    assert _sorted(got) == _sorted(want)


def test_late_rows_are_counted_and_kept(spark):
    r, lg, feed = _long_feed(spark)
    parts = [feed.where("hour(ts) >= 13"), feed.where("hour(ts) < 11")]
    sink = scratch_path(spark, "sink")
    runs.stream_runs_by_batch(_stream(spark, _folder(spark, parts)), frames.thresholds(spark), "hi", *SPAN, None, delay="1 hour", sink=sink)
    n = feed.where("hour(ts) < 11").count()
    assert runs.late_rows(spark, sink, 1) == n == spark.read.parquet(f"{sink}/late").count()


def test_rows_of_an_open_hour_are_not_late(spark):
    """The watermark may stand inside an hour; what comes for that hour still counts, however the feed is cut."""
    first, second = [(1, "10:00:30", 80), (1, "10:10:00", 80), (1, "10:50:00", 80)], [(1, "10:15:00", 90), (1, "10:20:00", 90), (1, "12:30:00", 5)]
    mark = frames.log(spark, [(1, "09:00:00", "ON")]).withColumn("watts", F.lit(None).cast("decimal(10,2)"))
    part = lambda rows: frames.readings(spark, rows).withColumn("status", F.lit(None).cast("string"))
    totals = []
    for parts in ([part(first + second).unionByName(mark)], [part(first).unionByName(mark), part(second)]):
        sink = scratch_path(spark, "sink")
        got = runs.stream_hour_summaries(_stream(spark, _folder(spark, parts)), frames.thresholds(spark), "hi", *SPAN, None, "10 minutes", sink)
        totals.append(sorted(map(str, got.collect())))
        assert runs.late_rows(spark, sink, len(parts) - 1) == 0
    assert totals[0] == totals[1]
    r = frames.readings(spark, first + second)
    want = batch.summary(r, mark.drop("watts"), frames.thresholds(spark), ["key"], "hi", *SPAN, period="hour", seconds=None)
    assert totals[0] == sorted(map(str, want.collect()))


def test_a_stopped_stream_goes_on(spark):
    r, lg, feed = _long_feed(spark)
    want = batch.summary(r, lg, frames.thresholds(spark), ["key"], "hi", *SPAN, period="hour", seconds=None)
    sink, path = scratch_path(spark, "sink"), _folder(spark, [feed.where("hour(ts) < 12")])
    again = lambda: runs.stream_hour_summaries(_stream(spark, path), frames.thresholds(spark), "hi", *SPAN, None, "10 minutes", sink, flush=False)
    closed = {x.period_start.hour for x in again().collect()}
    assert closed == {10}  # the open hour waits
    feed.where("hour(ts) >= 12").coalesce(1).write.mode("append").parquet(path)
    got = sorted(map(str, again().collect()))
    assert got == sorted(map(str, want.where("hour(period_start) < 14").collect()))


def test_a_table_of_part_files_is_a_feed(spark):
    r, _, _ = _long_feed(spark)
    folder = scratch_path(spark, "tables")
    r.repartition(3).write.parquet(f"{folder}/readings.parquet")
    windows = hourly.hourly(hourly.feed(spark, folder, "readings.parquet"), "ts", F.col("watts"))
    assert sum(x.n for x in hourly.upserted_hours(windows).collect()) == r.count()


def test_hours_over_several_files(spark):
    r = frames.readings(spark, [(1, f"1{h}:{m:02d}:00", h + m) for h in range(5) for m in (0, 20, 40)])
    hour = lambda a, b: r.where(F.hour("ts").between(a, b))
    path = _folder(spark, [hour(10, 11), hour(12, 12), hour(13, 14)])
    windows = lambda: hourly.hourly(_stream(spark, path), "ts", F.col("watts"))
    live = hourly.live_hours(windows())
    got = {x.hour: (float(x.runtime), x.n, x.closed) for x in live.collect()}
    assert got == {10 + h: (float(3 * h + 60), 3, h < 3) for h in range(5)}
    closed = {x.hour for x in hourly.closed_hours(windows()).collect()}
    assert closed == {10, 11, 12}


def test_hours_a_rollover_trigger_skips(spark):
    r = frames.readings(spark, [("01:00:00", 1), ("02:00:00", 1), ("05:00:00", 1), ("2024-01-06 06:00:00", 1)])
    got = [(x.hour, x.hours_skipped, x.trigger_fires) for x in hourly.hour_close_gaps(r).orderBy("sum_date", "hour").collect()]
    # a day later the hour of day fits, so the trigger fires although a day is missing
    assert got == [(2, 2, False), (5, 24, True)]
