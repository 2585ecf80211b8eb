"""Run detection on hand-built series: range edges, gaps, unknown states, chunk borders."""

import random
from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from emberline.operators import chunks, quality, runs, states

DAY = ("2024-01-05 00:00:00", "2024-01-06 00:00:00")


def classify(spark, readings, log, which="hi", start=DAY[0], end=DAY[1], thr=None, **kw):
    kw.setdefault("seconds", None)
    return runs.classify_runs(readings, log, thr or frames.thresholds(spark), ["key"], which, start, end, **kw)


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("key", "ts", "tie").select(*cols).collect()]


@pytest.mark.parametrize("seconds", [None, 600])
def test_run_open_at_range_start_has_id_zero(spark, seconds):
    r = frames.readings(spark, [("00:10:00", 80), ("00:20:00", 80), ("00:30:00", 5), ("00:40:00", 90)])
    on = frames.log(spark, [("2024-01-04 20:00:00", "ON")])
    got = rows(classify(spark, r, on, seconds=seconds), "run_id", "gap_us", "system_status")
    assert got == [(0, None, "boiler"), (0, 600_000_000, "boiler"), (None, 600_000_000, "main power"),
                   (1, 600_000_000, "boiler")]


@pytest.mark.parametrize("seconds", [None, 60])
def test_unknown_state_before_a_run_starts_no_run(spark, seconds):
    r = frames.readings(spark, [("01:00:00", 80), ("01:05:00", 80)])
    got = rows(classify(spark, r, frames.log(spark, [("01:04:00", "ON")]), seconds=seconds), "system_status", "run_id")
    assert got == [(None, 0), ("boiler", 0)]


def test_state_before_first_log_entry_is_unknown_and_off_follows(spark):
    r = frames.readings(spark, [("01:00:00", 80), ("02:00:00", 80), ("03:00:00", 80)])
    lg = frames.log(spark, [("01:30:00", "OFF"), ("02:30:00", "ON")])
    assert rows(classify(spark, r, lg), "system_status", "run_id") == [(None, 0), ("OFF", None), ("boiler", 1)]


def test_log_entry_at_the_reading_applies_to_it_and_the_last_of_an_instant_wins(spark):
    r = frames.readings(spark, [("01:00:00", 80)])
    lg = frames.log(spark, [("01:00:00", "OFF"), ("01:00:00", "ON")])
    got = classify(spark, r, lg)
    assert got.count() == 1 and rows(got, "main_status") == [("ON",)]


@pytest.mark.parametrize("gap,seconds_counted", [(599, 599), (600, 600), (601, 10)])
def test_gap_cap(spark, gap, seconds_counted):
    end = f"01:{gap // 60:02d}:{gap % 60:02d}"
    r = frames.readings(spark, [("01:00:00", 5), (end, 80)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    s = runs.summary(r, on, frames.thresholds(spark), ["key"], "hi", *DAY, seconds=None).first()
    assert s.total_runtime == pytest.approx(seconds_counted / 60)
    # energy takes the gap as it is
    assert s.kwh == pytest.approx(80 * gap / 3.6e6)


def test_run_of_one_reading_counts_as_a_cycle(spark):
    r = frames.readings(spark, [("01:00:00", 5), ("01:05:00", 80), ("01:10:00", 5)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    s = runs.summary(r, on, frames.thresholds(spark), ["key"], "hi", *DAY, seconds=None).first()
    assert (s.cycles, s.total_runtime) == (1, 5.0)


def test_no_readings_give_no_row_per_device_and_zeros_for_one_device(spark):
    r, lg = frames.readings(spark, []), frames.log(spark, [])
    assert runs.summary(r, lg, frames.thresholds(spark), ["key"], "hi", *DAY, seconds=None).count() == 0
    s = runs.summary(r.drop("key"), lg.drop("key"), frames.thresholds(spark), [], "hi", *DAY).first()
    assert (s.btu, s.cycles, s.total_runtime, s.kwh) == (0.0, 0, 0.0, 0.0)


def test_low_threshold_includes_high_and_carries_no_fuel(spark):
    r = frames.readings(spark, [("01:00:00", 5), ("01:05:00", 30), ("01:10:00", 80)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    c = classify(spark, r, on, which="lo")
    assert rows(c, "system_status", "run_id", "btu", "gallons") == [
        ("main power", None, 0.0, 0.0), ("circulator", 1, 0.0, 0.0), ("circulator", 1, 0.0, 0.0)]


def test_threshold_changes_over_time(spark):
    thr = frames.thresholds(spark, [("2024-01-01 00:00:00", 60, 20), ("2024-01-05 02:00:00", 90, 20)])
    r = frames.readings(spark, [("01:59:59", 80), ("02:00:00", 80), ("03:00:00", 95)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    assert rows(classify(spark, r, on, thr=thr), "system_status") == [("boiler",), ("main power",), ("boiler",)]


@pytest.mark.parametrize("seconds", [None, 60])
def test_thresholds_of_each_device(spark, seconds):
    thr = spark.createDataFrame([
        (1, frames.at("2024-01-01 00:00:00"), 60, 20), (1, frames.at("2024-01-05 02:00:00"), 90, 20),
        (2, frames.at("2024-01-01 00:00:00"), 10, 5)], "key long, change_time timestamp_ntz, hi int, lo int")
    r = frames.readings(spark, [(1, "01:00:00", 70), (2, "01:00:00", 15), (1, "02:00:00", 70), (2, "03:00:00", 7), (3, "03:00:00", 99)])
    on = frames.log(spark, [(k, "2024-01-04 00:00:00", "ON") for k in (1, 2, 3)])
    assert rows(classify(spark, r, on, thr=thr, seconds=seconds), "key", "system_status") == [
        (1, "boiler"), (1, "main power"), (2, "boiler"), (2, "main power"), (3, None)]


def test_no_threshold_yet_leaves_the_state_unknown(spark):
    thr = frames.thresholds(spark, [("2024-01-05 02:00:00", 60, 20)])
    r = frames.readings(spark, [("01:00:00", 80), ("03:00:00", 80)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    assert rows(classify(spark, r, on, thr=thr), "system_status") == [(None,), ("boiler",)]


def test_closed_and_half_open_range(spark):
    r = frames.readings(spark, [("23:59:59", 80), ("2024-01-06 00:00:00", 80)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    assert classify(spark, r, on).count() == 1
    assert classify(spark, r, on, closed=True).count() == 2
    # an entry at the closed end still applies to a reading there
    off = frames.log(spark, [("2024-01-04 00:00:00", "ON"), ("2024-01-06 00:00:00", "OFF")])
    assert rows(classify(spark, r, off, closed=True), "main_status") == [("ON",), ("OFF",)]


def test_unknown_power_is_left_out_of_runs_but_kept_by_fill(spark):
    r = frames.readings(spark, [("01:00:00", None), ("01:05:00", 80)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    assert rows(classify(spark, r, on), "system_status", "gap_us") == [("boiler", None)]
    f = states.fill_status(r, on, ["key"], *DAY)
    assert rows(f, "status", "gap_us") == [("ON", None), ("ON", 300_000_000)]


def test_period_restart_drops_the_opening_interval_of_each_period(spark):
    r = frames.readings(spark, [("00:30:00", 80), ("00:50:00", 80), ("01:10:00", 80), ("01:20:00", 80)])
    on = frames.log(spark, [("2024-01-04 00:00:00", "ON")])
    hourly = classify(spark, r, on, period="hour")
    assert rows(hourly, "gap_us", "run_id") == [(None, 0), (1_200_000_000, 0), (None, 0), (600_000_000, 0)]


def test_debounce_fills_single_off_samples_only(spark):
    r = frames.readings(spark, [(f"01:0{i}:00", w) for i, w in enumerate([50, 1, 50, 1, 1, 50])])
    for seconds in (None, 60):
        f = runs.fixed_runs(r, ["key"], states.fixed_state(F.col("watts"), 40), smooth=True, seconds=seconds)
        assert rows(f, "system_status", "run_id") == [
            ("ON", 0), ("ON", 0), ("ON", 0), ("OFF", None), ("OFF", None), ("ON", 1)]


def test_cycle_statistics_agree_with_counting_by_hand(spark):
    """The same figures by window and grouping, by a plain loop, and from chunks."""
    r, _ = _random_feed(spark, 5)
    state = states.fixed_state(F.col("watts"), 30)
    by_hand = {}
    last = {}
    for x in r.orderBy("key", "ts", "tie").collect():
        on = x.watts is not None and x.watts > 30
        before_ts, before_on = last.get(x.key, (None, None))
        runs_of = by_hand.setdefault(x.key, [])
        if on:
            if before_on is False or not runs_of:
                runs_of.append(None)
            if before_ts is not None:
                runs_of[-1] = (runs_of[-1] or 0) + (x.ts - before_ts).total_seconds() / 60
        last[x.key] = (x.ts, on)
    want = {k: (len([v for v in m if v is not None]), round(sum(v or 0 for v in m) / 60, 2)) for k, m in by_hand.items()}
    for seconds in (None, 600):
        f = runs.fixed_runs(r, ["key"], state, seconds=seconds)
        got = runs.cycle_stats(runs.run_sums(f, ["key"], cap=False), ["key"])
        got = {x.key: (x.cycles, x.total_hours) for x in got.collect()}
        assert got.keys() == want.keys()
        for key in want:
            assert got[key] == pytest.approx(want[key], abs=0.011)


def test_furnace_mode_order(spark):
    df = spark.createDataFrame(
        [("ON", 30, 5.0), ("ON", 60, 700.0), ("ON", 100, 601.0), ("ON", 501, 5.0), ("ON", 501, 700.0),
         ("ON", 100, 600.0), ("OFF", 30, 5.0), (None, 30, 5.0), ("ON", None, 5.0)], "s string, w int, g double")
    got = [r[0] for r in df.select(states.furnace_mode(F.col("s"), F.col("w"), F.col("g"))).collect()]
    assert got == ["blower", "blower", "unknown", "dehumidification", "unknown", "ON", "OFF", None, "ON"]
    free = [r[0] for r in df.select(states.furnace_mode_unlogged(F.col("w"))).collect()]
    assert free == ["off", "on", "on", "dehumidification", "dehumidification", "on", "off", "off", "on"]


def test_bucket_join_keeps_one_row_per_reading(spark):
    r = frames.readings(spark, [("01:00:10", 1), ("01:00:50", 2), ("01:01:00", 3)])
    lg = frames.log(spark, [("01:00:20", "OFF"), ("01:00:40", "ON")])
    assert rows(states.bucket_join(r, lg, ["key"]), "status") == [("ON",), ("ON",), (None,)]


def test_active_days(spark):
    lg = frames.log(spark, [("2024-01-02 10:00:00", "ON"), ("2024-01-04 10:00:00", "OFF")])
    days = frames.readings(spark, [(f"2024-01-0{d} 12:00:00", 1) for d in range(1, 7)]).select(
        "key", F.to_date("ts").alias("date"))
    got = [r.date.day for r in states.active_days(days, lg, ["key"]).orderBy("date").collect()]
    assert got == [2, 3, 4]


def test_completeness_of_nothing(spark):
    none = spark.createDataFrame([], "gap_us long, watts double, ts timestamp_ntz")
    assert quality.complete_any_gap(none, []).first()[0] == "yes"
    assert quality.complete_max_gap(none, []).first()[0] == "no"


def test_coverage(spark):
    def cover(first, last, span):
        df = spark.createDataFrame([(frames.at(first), 1), (frames.at(last), 5)], "ts timestamp_ntz, gap_us long")
        return quality.complete_coverage(df, [], span).first()[0]

    assert cover("2024-02-01 05:00:00", "2024-02-29 10:00:00", "month") == "yes"
    assert cover("2024-02-01 05:00:00", "2024-02-28 10:00:00", "month") == "no"
    assert cover("2024-01-01 05:00:00", "2024-12-31 10:00:00", "year") == "yes"
    assert cover("2024-01-02 05:00:00", "2024-12-31 10:00:00", "year") == "no"


# ---- the chunked scan gives what the plain window gives ---------------------------------


def _random_feed(spark, seed):
    """Busy stretches and silences, ties in time, and one device with most of the rows."""
    rng = random.Random(seed)
    r, lg, t = [], [], 0
    for _ in range(400):
        t += rng.choice([0, 1, 5, 60, 61, 700, 4000])
        key = 1 if rng.random() < 0.7 else rng.randint(2, 4)
        when = frames.at("2024-01-05 00:00:00") + __import__("datetime").timedelta(seconds=t)
        r.append((key, when.isoformat(), rng.choice([None, 0, 10, 30, 59.99, 60, 75])))
        if rng.random() < 0.2:
            lg.append((key, when.isoformat(), rng.choice(["ON", "ON", "OFF", None])))
    return frames.readings(spark, r), frames.log(spark, lg)


@pytest.mark.parametrize("period", [None, "hour", "day"])
@pytest.mark.parametrize("seconds", [3600, 60])
def test_chunked_scan_equals_window(spark, period, seconds):
    r, lg = _random_feed(spark, 7)
    cols = ("key", "ts", "tie", "main_status", "system_status", "gap_us", "run_id")
    span = dict(start="2024-01-05 02:00:00", end="2024-01-20 00:00:00", period=period)
    plain = rows(classify(spark, r, lg, **span), *cols)
    assert plain == rows(classify(spark, r, lg, seconds=seconds, **span), *cols) and len(plain) > 200


@pytest.mark.parametrize("seconds", [3600, 60])
def test_chunked_helpers_equal_window(spark, seconds):
    r, _ = _random_feed(spark, 11)
    for keys in (["key"], []):
        for f in (
            lambda s: chunks.running_sum(r, keys, ("ts", "tie"), F.coalesce("watts", F.lit(0)), "x", s),
            lambda s: chunks.running_sum(r, keys, ("ts", "tie"), "watts", "x", s),
            lambda s: chunks.previous(r, keys, ("ts", "tie"), {"watts": "x"}, s),
            lambda s: chunks.following(r, keys, ("ts", "tie"), {"watts": "x"}, s),
            lambda s: chunks.fill_forward(r.withColumn("x", F.col("watts")), keys, ("ts", "tie"), ("x",), s),
        ):
            assert rows(f(None), "key", "ts", "x") == rows(f(seconds), "key", "ts", "x")


@pytest.mark.parametrize("seconds", [3600, 60])
def test_rows_without_device_or_time_come_out_alike_in_both_forms(spark, seconds):
    r, _ = _random_feed(spark, 5)
    r = r.withColumns({"key": F.when(F.col("tie") % 7 != 0, F.col("key")), "ts": F.when(F.col("tie") % 11 != 0, F.col("ts")),
                       "state": F.when(F.col("watts") > 20, "ON").when(F.col("watts").isNotNull(), "OFF")})
    order, keys = ("ts", "tie"), ["key"]
    for f in (
        lambda s: chunks.running_sum(r, keys, order, "tie", "x", s),
        lambda s: chunks.previous(r, keys, order, {"tie": "x"}, s),
        lambda s: chunks.following(r, keys, order, {"tie": "x"}, s),
        lambda s: chunks.fill_forward(r.withColumn("x", F.col("watts")), keys, order, ("x",), s),
        lambda s: runs.mark_runs(r, keys, "state", "ON", seconds=s).withColumn("x", F.struct("run_id", "gap_us")),
        lambda s: runs.debounce(r, keys, "state", s).withColumn("x", F.col("state")),
    ):
        plain = sorted(rows(f(None), "tie", "x"), key=str)
        assert plain == sorted(rows(f(seconds), "tie", "x"), key=str) and len(plain) == r.count()
    lost = chunks.previous(r, keys, order, {"tie": "x"}, seconds).where("key IS NULL AND x IS NOT NULL")
    assert lost.count() == 0


def test_choose_chunk_follows_the_busiest_key(spark):
    r = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("key"),
        F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"))
    assert chunks.choose_chunk(r, ["key"], "ts") is None
    assert chunks.choose_chunk(r, ["key"], "ts", max_rows=6000) == 3600
    assert chunks.choose_chunk(r, ["key"], "ts", max_rows=1201) == 3600
    assert chunks.choose_chunk(r, ["key"], "ts", max_rows=1200) == 600
    assert chunks.choose_chunk(r, ["key"], "ts", "hour", max_rows=201) == 600
    assert chunks.choose_chunk(r, [], "ts", max_rows=19999) == 3600


def test_hourly_sums_add_up_below_the_range_sum(spark):
    """Each restarted hour loses its opening interval, never gains one."""
    r, lg = _random_feed(spark, 3)
    span = ("2024-01-05 00:00:00", "2024-01-20 00:00:00")
    thr = frames.thresholds(spark)
    whole = runs.summary(r, lg, thr, ["key"], "hi", *span, seconds=None, cap=False)
    parts = runs.summary(r, lg, thr, ["key"], "hi", *span, period="hour", seconds=None, cap=False)
    both = whole.join(parts.groupBy("key").agg(F.sum("total_runtime").alias("p")), "key")
    assert both.where("p > total_runtime + 1e-9").count() == 0
    assert both.where(F.col("total_runtime") > 15 * 24 * 60).count() == 0


def test_energy_is_exact(spark):
    w = runs.energy.watt_micros(F.lit(Decimal("12.34")), F.lit(2_592_000_000_000))
    assert spark.range(1).select(w).first()[0] == Decimal("31985280000000.00")
