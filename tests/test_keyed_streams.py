"""Run detection in the keyed state store against the batch form."""

import frames
import pytest
from pyspark.sql import functions as F
from test_streams import SPAN, _feed, _folder, _long_feed, _sorted, _stream

from emberline.operators import runs as batch
from emberline.session import scratch_path
from emberline.streaming import keyed


def _run(spark, path, which="hi", delay="10 minutes", sink=None, checkpoint=None, **how):
    return keyed.stream_runs(_stream(spark, path), frames.thresholds(spark), which, *SPAN, sink or scratch_path(spark, "rows"),
                             checkpoint or scratch_path(spark, "state"), delay, **how)


@pytest.fixture(autouse=True)
def few_state_stores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("delay, which", [("0 seconds", "hi"), ("30 minutes", "lo")])
def test_keyed_runs_are_those_of_the_batch_form(spark, delay, which):
    r, lg, feed = _long_feed(spark)
    want = batch.classify_runs(r, lg, frames.thresholds(spark), ["key"], which, *SPAN, seconds=None)
    path = _folder(spark, [feed.where(F.hour("ts").isin(h, h + 1)) for h in (10, 12, 14)])
    assert _sorted(_run(spark, path, which, delay)) == _sorted(want)


def test_keyed_runs_do_not_depend_on_how_the_feed_is_cut(spark):
    r, lg, feed = _long_feed(spark)
    want = _sorted(batch.classify_runs(r, lg, frames.thresholds(spark), ["key"], "hi", *SPAN, seconds=None))
    parts = [feed.where("status IS NOT NULL"), feed.where("status IS NULL AND tie % 2 = 0"), feed.where("status IS NULL AND tie % 2 = 1")]
    assert _sorted(_run(spark, _folder(spark, parts), delay="1 day")) == want


def test_a_stopped_keyed_stream_goes_on(spark):
    r, lg, feed = _long_feed(spark)
    want = _sorted(batch.classify_runs(r, lg, frames.thresholds(spark), ["key"], "hi", *SPAN, seconds=None))
    path, sink, checkpoint = _folder(spark, [feed.where("hour(ts) < 12")]), scratch_path(spark, "rows"), scratch_path(spark, "state")
    first = _sorted(_run(spark, path, sink=sink, checkpoint=checkpoint, flush=False))
    assert 0 < len(first) < len(want) and first == [w for w in want if w[:2] in {f[:2] for f in first}]
    feed.where("hour(ts) >= 12").coalesce(1).write.mode("append").parquet(path)
    assert _sorted(_run(spark, path, sink=sink, checkpoint=checkpoint)) == want


def test_a_batch_touches_only_its_own_devices(spark):
    s, want = _feed(spark)
    r, _, feed = _long_feed(spark)
    parts = [feed.where("hour(ts) < 12"), feed.where("hour(ts) = 12 AND key = 1"), feed.where("hour(ts) > 12 AND key = 1")]
    sink, checkpoint = scratch_path(spark, "rows"), scratch_path(spark, "state")
    _run(spark, _folder(spark, parts), sink=sink, checkpoint=checkpoint, delay="0 seconds", flush=False)
    last = {x["key"]: x for x in keyed.stored(spark, checkpoint, "last").select("key.key", "value.last_us").collect()}
    assert set(last) == {1, 2} and last[1]["last_us"] > last[2]["last_us"]


def test_rows_that_belong_to_no_run(spark):
    r = frames.readings(spark, [(1, "10:00:00", 80), (1, "10:01:00", None), (1, "10:02:00", 90), (1, "2024-03-01 00:00:00", 90)])
    lg = frames.log(spark, [(1, "2023-12-31 09:00:00", "ON"), (1, "10:01:30", None)])
    nobody = frames.readings(spark, [(None, "10:00:00", 80)])
    feed = r.unionByName(nobody).withColumn("status", F.lit(None).cast("string")).unionByName(
        lg.withColumn("watts", F.lit(None).cast("decimal(10,2)")))
    want = batch.classify_runs(r, lg, frames.thresholds(spark), ["key"], "hi", *SPAN, seconds=None)
    assert _sorted(_run(spark, _folder(spark, [feed]))) == _sorted(want)
