"""What chunks of a series hand on to each other, in one level and in two."""

import random
from datetime import datetime, timedelta

import frames
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from emberline.operators import chunks, runs


def _series(spark, keys=2, n=400):
    draw = random.Random(n)
    start = 1_704_400_000
    rows = []
    for i in range(n):
        at = start + draw.choice([draw.randint(0, 40), draw.randint(0, 40_000)])
        rows.append((draw.randint(1, keys) if draw.random() > 0.03 else None, None if draw.random() < 0.03 else at, i, draw.choice([None, 1, 2, 3])))
    df = spark.createDataFrame(rows, "key long, at long, tie long, v int")
    return df.select("key", F.timestamp_seconds("at").cast("timestamp_ntz").alias("ts"), "tie", "v")


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("seconds", [3600, 10, 1])
def test_two_levels_give_what_one_window_gives(spark, keys, seconds, monkeypatch):
    monkeypatch.setattr(chunks, "STRETCH", 7)
    df, order = _series(spark), ("ts", "tie")
    for scan in (
        lambda s: chunks.fill_forward(df, keys, order, ("v",), s),
        lambda s: chunks.running_sum(df, keys, order, "v", "total", s),
        lambda s: chunks.previous(df, keys, order, {"v": "before", "tie": "tie_before"}, s),
        lambda s: chunks.following(df, keys, order, {"v": "after", "tie": "tie_after"}, s),
    ):
        assert _rows(scan(seconds)) == _rows(scan(None))


@pytest.mark.parametrize("seconds", [600, 1])
def test_runs_over_short_chunks(spark, seconds, monkeypatch):
    monkeypatch.setattr(chunks, "STRETCH", 5)
    draw = random.Random(4)
    r = frames.readings(spark, [(draw.randint(1, 2), f"1{draw.randint(0, 5)}:{draw.randint(0, 59):02d}:{draw.randint(0, 59):02d}", draw.choice([0, 30, 70, 90])) for _ in range(200)])
    lg = frames.log(spark, [(draw.randint(1, 2), f"1{h}:{draw.randint(0, 59):02d}:30", draw.choice(["ON", "OFF", "ON"])) for h in range(6) for _ in range(3)])
    of = lambda s: runs.classify_runs(r, lg, frames.thresholds(spark), ["key"], "hi", "2024-01-01 00:00:00", "2024-02-01 00:00:00", seconds=s)
    assert _rows(of(seconds)) == _rows(of(None))


def test_no_window_over_all_short_chunks(spark):
    """Windows by key alone see stretches only."""
    plan = chunks.running_sum(_series(spark), [], ("ts", "tie"), "v", "total", 1)._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_stretch" in w or "_chunk" in w.split("windowspecdefinition(")[1].split(" ASC")[0] for w in windows)
    assert any("windowspecdefinition(_stretch" in w and "_chunk" not in w for w in windows)


def test_a_small_table_is_planned_without_a_job(spark, small):
    jobs = spark.sparkContext.statusTracker()
    df = spark.read.parquet(f"{small}/events.parquet")  # reads the schema
    spark.sparkContext.setJobGroup("planning", "planning")
    assert chunks.choose_chunk(df, ["user_id"], "ts") is None
    assert not jobs.getJobIdsForGroup("planning")
    assert chunks.choose_chunk(df, [], "ts", max_rows=5) <= 86400
    assert jobs.getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("tests", "tests")


def test_the_carry_over_chunks(spark):
    parts = spark.createDataFrame([(1, c * 1_000_000, v) for c, v in enumerate([5, None, 7, None, None, 1])], f"key long, {chunks.CHUNK} long, v long")
    w = Window.partitionBy("key").orderBy(chunks.CHUNK)
    want = parts.withColumns({"l": F.last("v", True).over(chunks.before_here(w)), "n": F.first("v", True).over(chunks.after_here(w)),
                              "s": F.sum("v").over(chunks.before_here(w))})
    got = chunks.over_chunks(parts, ["key"], {"l": ("last", "v"), "n": ("next", "v"), "s": ("sum", "v")}, 1)
    assert _rows(got) == _rows(want)


def test_first_crossing_orders_one_chunk_and_holds_for_falling_totals(spark):
    draw = random.Random(9)
    for least in (0, -9):
        rows = [(k, datetime(2024, 1, 1) + timedelta(seconds=draw.randint(0, 9000)), i, draw.randint(least, 9)) for k in "ab" for i in range(300)]
        df = spark.createDataFrame(rows, "key string, ts timestamp_ntz, tie int, x int")
        limits, expected = (0, 5, 40, 10**6), {}
        for keys in ([], ["key"]):
            expected = {(*([k] if keys else []), float(x)): None for k in "ab" for x in limits}
            for k in ("ab" if keys else [None]):
                total = 0
                for r in sorted((r for r in rows if k in (None, r[0])), key=lambda r: (r[1], r[0] if not keys else "", r[2])):
                    total += r[3]
                    for x in limits:
                        at = (*([k] if keys else []), float(x))
                        if total > x and expected[at] is None:
                            expected[at] = r[1]
            order = ("ts", "tie") if keys else ("ts", "key", "tie")
            for seconds in (60, 86400):
                got = chunks.first_crossing(df, keys, order, F.col("x"), limits, seconds).collect()
                assert {tuple(r)[:-1]: r["crossed"] for r in got} == expected
    assert chunks.first_crossing(df.limit(0), [], ("ts", "tie"), F.col("x"), limits, 60).collect() == []
