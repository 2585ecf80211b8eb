"""Rollups, charts, forecast, inventory, table maintenance, sources and the model, by hand."""

import datetime as dt
import glob
import pathlib
from decimal import Decimal

import frames
import pytest
from pyspark.sql import functions as F

from emberline.functions import calendar as cal
from emberline.functions import labels
from emberline.operators import model, quality, rollups, tables
from emberline.plans import charts, closeout, forecast, gas, inventory
from emberline.session import scratch_path
from emberline.sources import files, series

D = dt.date


def first(df):
    return df.first()


# ---- calendar -----------------------------------------------------------------------------


def test_previous_period_wraps(spark):
    def prev(period, now):
        a, b = cal.previous_period(period, cal.ntz(now))
        return tuple(str(x) for x in spark.range(1).select(a, b).first())

    assert prev("hour", "2024-01-01 00:30:00") == ("2023-12-31 23:00:00", "2024-01-01 00:00:00")
    assert prev("day", "2024-03-01 10:00:00") == ("2024-02-29 00:00:00", "2024-03-01 00:00:00")
    assert prev("month", "2024-01-15 10:00:00") == ("2023-12-01 00:00:00", "2024-01-01 00:00:00")
    assert prev("year", "2024-01-15 10:00:00") == ("2023-01-01 00:00:00", "2024-01-01 00:00:00")


def test_period_start_ignores_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2024-03-10 02:30 does not exist in that zone
        x = cal.ntz("2024-03-10 02:30:10")
        got = spark.range(1).select(cal.period_start("hour", x), cal.period_start("day", x)).first()
        assert [str(v) for v in got] == ["2024-03-10 02:00:00", "2024-03-10 00:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_calendar_dimension(spark):
    c = series.calendar(spark)
    assert c.count() == 366
    rows = {(r.month, r.day): (r.doy_noleap, r.doy_leap) for r in c.collect()}
    assert rows[(2, 28)] == (59, 59) and rows[(2, 29)] == (None, 60)
    assert rows[(3, 1)] == (60, 61) and rows[(12, 31)] == (365, 366)


def test_grids(spark):
    assert series.slot_grid(spark, season=False).distinct().count() == 168
    assert series.slot_grid(spark).distinct().count() == 672


def test_seasons_keep_apart(spark):
    months = {r.month: r.season for r in cal.season_dimension(spark).collect()}
    assert set(months.values()) == {"heat", "noheat", "shoulder"} and len(months) == 12
    by_day = spark.range(1, 367).select(cal.meteorological_season(F.col("id")).alias("s")).groupBy("s").count()
    assert sum(r["count"] for r in by_day.collect()) == 366 and by_day.count() == 4


def test_labels(spark):
    d = F.lit("2024-02-01").cast("date")
    assert spark.range(1).select(labels.day_label(d), labels.weekday_name(d)).first()[:] == ("Feb - 01", "Thursday")


# ---- rollups and charts -------------------------------------------------------------------


def test_live_hour_once_if_equal_twice_if_not(spark):
    stored = frames.hours(spark, [("2024-01-05", 9, 5), ("2024-01-05", 10, 7)])
    assert rollups.union_live(stored, frames.hours(spark, [("2024-01-05", 10, 7)])).count() == 2
    assert rollups.union_live(stored, frames.hours(spark, [("2024-01-05", 10, 8)])).count() == 3


def test_leap_day_compares_with_the_28th(spark):
    h = frames.hours(spark, [("2023-02-28", 1, 4), ("2024-02-28", 1, 5), ("2024-02-29", 1, 6), ("2024-03-01", 1, 7)])
    got = {r.sum_date: r.previous_year for r in charts.daily_vs_last_year(h).collect()}
    assert got[D(2024, 2, 28)] == got[D(2024, 2, 29)] == 4.0 and got[D(2024, 3, 1)] is None


def test_hour_slots_later_than_now_belong_to_yesterday(spark):
    x = spark.range(24).select("id", charts.slot_day(F.col("id"), "2024-01-30 12:34:00").alias("d"))
    days = {r.id: r.d.day for r in x.collect()}
    assert days[12] == 30 and days[13] == 29 and days[0] == 30


def test_current_month_stays_out_of_its_mean(spark):
    m = spark.createDataFrame([(2023, 1, 10), (2024, 1, 99), (2023, 2, 3)], "year int, month int, runtime int")
    got = {r.month: (r.runtime_avg, r["count"]) for r in rollups.with_mean(rollups.by_month(m, cal.ntz("2024-01-30"))).collect()}
    assert got == {1: (10.0, 1), 2: (3.0, 1)}


def test_rollups_agree_with_each_other(spark):
    h = frames.hours(spark, [(f"2024-0{1 + i % 3}-{1 + i % 28:02d}", i % 24, i) for i in range(200)])
    total = h.agg(F.sum("runtime")).first()[0]
    for f in (rollups.daily_sums, rollups.monthly_sums, rollups.yearly_sums):
        assert f(h).agg(F.sum("runtime")).first()[0] == total


def test_merged_baseline_equals_baseline_of_all(spark):
    h = frames.hours(spark, [(f"2024-01-{1 + i % 28:02d}", i % 24, i) for i in range(300)])
    cut = F.col("sum_date") < F.lit("2024-01-11").cast("date")
    old, new = rollups.by_dow_season_hour(h.where(cut), spark), rollups.by_dow_season_hour(h.where(~cut), spark)
    slots = ["dow", "season", "hour"]
    merged = rollups.with_mean(rollups.merge_baselines(old, new, slots)).select(*slots, "count", "runtime_avg")
    whole = rollups.with_mean(rollups.by_dow_season_hour(h, spark)).select(*slots, "count", "runtime_avg")
    assert merged.exceptAll(whole).count() == 0 and whole.exceptAll(merged).count() == 0


def test_backfill_applies_to_its_year_only(spark):
    h = frames.hours(spark, [("2016-03-01", 1, 10), ("2016-12-01", 1, 10), ("2017-03-01", 1, 1)])
    got = first(charts.prior_year_to_date(h, "2017-06-01 00:00:00", charts.BACKFILL_MINUTES))
    assert got.runtime == pytest.approx(10 + 46048.72230754999999996671)
    assert first(charts.prior_year_to_date(h, "2018-06-01 00:00:00", charts.BACKFILL_MINUTES)).runtime == 1.0


def test_charts_come_in_order(spark):
    h = frames.hours(spark, [(f"202{2 + i % 2}-0{1 + i % 9}-{1 + i % 28:02d}", i % 24, i) for i in range(120)])
    as_of = "2023-09-30 12:00:00"
    days = [r.sum_date for r in charts.daily_vs_last_year(h, 30).collect()]
    assert days == sorted(days) and len(days) == 30
    slots = [(r.sum_date, r.label) for r in charts.day_vs_usual(h, as_of).collect()]
    assert slots == sorted(slots)
    assert [r.row_number for r in charts.year_vs_usual(h, h, as_of).collect()] == list(range(12, 0, -1))
    assert [r.label for r in charts.years(h, as_of).collect()] == [2022, 2023]


def test_charts_per_device_equal_charts_of_each_device(spark):
    rows = [(f"2024-01-{1 + i % 28:02d}", (i * 5) % 24, i) for i in range(160)]
    a, b = frames.hours(spark, rows[:110]), frames.hours(spark, rows[60:])
    both = a.withColumn("key", F.lit(1)).unionByName(b.withColumn("key", F.lit(2)))
    as_of = "2024-01-28 12:00:00"
    forms = (
        lambda h, k: charts.daily_vs_last_year(h, 10, k), lambda h, k: charts.week_vs_usual(h, h, True, k),
        lambda h, k: charts.day_vs_usual(h, as_of, True, True, k), lambda h, k: charts.year_vs_usual(h, h, as_of, k))
    for f in forms:
        for key, single in ((1, a), (2, b)):
            got = f(both, ["key"]).where(F.col("key") == key).drop("key")
            want = f(single, ())
            assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_daylight_takes_yesterday_while_still_to_come(spark):
    hours = spark.createDataFrame([(D(2024, 1, 2), 6), (D(2024, 1, 2), 7), (D(2024, 1, 2), 17)], "sum_date date, hour int")
    sky = spark.createDataFrame(
        [(D(2024, 1, 1), "07:01:00", "16:01:00"), (D(2024, 1, 2), "07:02:00", "16:02:00")],
        "date date, sunrise string, sunset string")
    got = [(r.sunrise, r.sunset) for r in charts.daylight_markers(hours, sky).orderBy("hour").collect()]
    assert got == [("07:01:00", "16:01:00"), ("07:02:00", "16:01:00"), ("07:02:00", "16:02:00")]


# ---- forecast and inventory ---------------------------------------------------------------


def test_forecast_replaces_climatology(spark):
    climate = spark.createDataFrame([(1, 10.5), (2, 20.4)], "doy int, hdd_avg double")
    ahead = spark.createDataFrame([(D(2024, 1, 2), 33)], "forecast_date date, hdd int")
    assert {r.doy: r.hdd for r in forecast.degree_days(climate, ahead).collect()} == {1: 11, 2: 33}


def test_horizon_is_366_dates_less_those_without_degree_days(spark):
    every = spark.range(1, 367).select(F.col("id").cast("int").alias("doy"), F.lit(10).alias("hdd"))
    p = forecast.predicted_runtime(every, "2023-07-01 00:00:00")
    assert (p.count(), p.agg(F.max("date")).first()[0]) == (366, D(2024, 6, 30))
    assert forecast.predicted_runtime(every.where("doy <> 200"), "2023-07-01 00:00:00").count() == 365


def _predicted(spark, minutes, n=10):
    return spark.range(n).select(
        F.date_add(F.lit("2024-01-10").cast("date"), F.col("id").cast("int")).alias("date"),
        F.lit(float(minutes)).alias("predicted_runtime"))


def test_projection_needs_a_stored_hour_today(spark):
    p = _predicted(spark, 60.0)
    now = "2024-01-10 12:00:00"
    assert forecast.month_projection(p, frames.hours(spark, [("2024-01-09", 1, 5)]), now).count() == 0
    got = forecast.month_projection(p, frames.hours(spark, [("2024-01-09", 1, 5), ("2024-01-10", 1, 40)]), now)
    r = got.orderBy("timestamp").first()
    # 40 today + half of 60 still to come is more than 60; yesterday's 5 belong to the month
    assert r.runtime == pytest.approx(max(40 + 60 * 0.5, 60) - 40 + 45)
    assert str(r.timestamp) == "2024-01-10 23:59:59"


def test_no_fill_delivery_means_a_full_tank(spark):
    d = frames.deliveries(spark, [("2024-01-01", False, 50)])
    r = first(inventory.remaining_fuel(d, frames.hours(spark, [("2024-01-05", 1, 60)]), _predicted(spark, 1), "2024-01-10 00:00:00"))
    assert (r.remaining_gallons, r.tank_level) == (260.0, 100.0)
    assert (r.low_reached, r.empty_reached, r.low_date) == (False, False, D(2024, 1, 19))


def test_deliveries_after_the_fill_count_and_usage_from_the_fill_on(spark):
    d = frames.deliveries(spark, [("2024-01-01", True, 99), ("2024-01-03", True, 80), ("2024-01-03", False, 7), ("2024-01-04", False, 50)])
    h = frames.hours(spark, [("2024-01-02", 1, 600), ("2024-01-03", 0, 60), ("2024-01-05", 1, 60)])
    left = first(inventory.remaining_gallons(d, h)).remaining_gallons
    assert left == pytest.approx(260 + 50 - round(2 * 0.666205227383988, 2))


def test_low_and_empty_dates(spark):
    d = frames.deliveries(spark, [("2024-01-09", True, 80)])
    r = first(inventory.remaining_fuel(d, frames.hours(spark, []), _predicted(spark, 60 * 60, 12), "2024-01-10 00:00:00"))
    # 39.97 gallons a day: above 65 through day 4, above 0 through day 6
    assert (r.low_date, r.low_days, r.empty_date, r.empty_days) == (D(2024, 1, 13), 3, D(2024, 1, 15), 5)
    assert r.low_reached and r.empty_reached


def test_tank_level_is_opening_plus_in_less_out(spark):
    d = frames.deliveries(spark, [("2024-01-01", True, 100), ("2024-01-02", True, 10)])
    h = frames.hours(spark, [("2024-01-01", 5, 60), ("2024-01-02", 0, 120)])
    t = {str(r.timestamp): r.tank_level for r in inventory.tank_level(d, h, "2024-01-02 01:30:00").collect()}
    assert len(t) == 27 and t["2023-12-31 23:00:00"] == 31.5 and t["2024-01-01 00:00:00"] == 131.5
    assert t["2024-01-02 01:00:00"] == pytest.approx(141.5 - 3 * 0.666205227383988)


# ---- tables -------------------------------------------------------------------------------


def test_upsert_into_parquet_touches_only_its_days_and_repeats_safely(spark):
    path = scratch_path(spark, "t")
    tables.write_days(frames.hours(spark, [("2024-01-01", 1, 1), ("2024-01-01", 2, 2), ("2024-01-02", 1, 3)]), path)
    new = frames.hours(spark, [("2024-01-01", 2, 20), ("2024-01-03", 5, 9)])
    for _ in range(2):
        tables.upsert_days(path, new, ["sum_date", "hour"])
    got = sorted((r.sum_date.day, r.hour, float(r.runtime)) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1, 1.0), (1, 2, 20.0), (2, 1, 3.0), (3, 5, 9.0)]


def test_insert_ignore_update_reset_roll(spark):
    old = spark.createDataFrame([(1, 5.0, "yes", None)], "hour int, btu double, complete string, updated timestamp_ntz")
    new = spark.createDataFrame([(1, 9.0, "no", None), (2, 7.0, "no", None)], old.schema)
    assert sorted(r.btu for r in tables.insert_ignore(old, new, ["hour"]).collect()) == [5.0, 7.0]
    up = tables.keyed_update(old, new, ["hour"], ["btu"]).first()
    assert (up.btu, up.complete, up.changed) == (9.0, "yes", True)
    r = tables.reset_slot(old, F.col("hour") == 1, "2024-01-01 01:00:00").first()
    assert (r.btu, r.complete, str(r.updated)) == (0.0, "no", "2024-01-01 01:00:00")
    y = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0)], "day int, previous_year double, current_year double")
    got = {r.day: (r.previous_year, r.current_year) for r in tables.roll_year(y, F.col("day") == 1).collect()}
    assert got == {1: (3.0, None), 2: (2.0, 3.0)}


def test_one_row_per_key_whatever_the_change_holds(spark):
    old = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int")
    two = spark.createDataFrame([(2, 7), (2, 9), (3, 4), (3, 3), (3, 3)], "k int, v int")
    assert sorted(map(tuple, tables.insert_ignore(old, two, ["k"]).collect())) == [(1, 1), (2, 2), (3, 3)]
    assert sorted(map(tuple, tables.keyed_update(old, two, ["k"], ["v"]).collect())) == [(1, 1, False), (2, 9, True)]
    empty = two.limit(0)
    assert sorted(map(tuple, tables.insert_ignore(old, empty, ["k"]).collect())) == [(1, 1), (2, 2)]


def test_upsert_reads_only_touched_days_and_leaves_no_staged_rows(spark):
    path = scratch_path(spark, "t")
    tables.write_days(frames.hours(spark, [(f"2024-01-{d:02d}", 1, d) for d in range(1, 20)]), path)
    for month in range(1, 20):  # an unreadable day shows whether it is read
        if month != 3:
            for f in glob.glob(f"{path.removeprefix('file:')}/sum_date=2024-01-{month:02d}/*.parquet"):
                pathlib.Path(f).write_bytes(b"no parquet")
    tables.upsert_days(path, frames.hours(spark, [("2024-01-03", 1, 30), ("2024-01-03", 2, 31)]), ["sum_date", "hour"])
    got = spark.read.schema("hour int, runtime decimal(12,2), sum_date date").parquet(path).where("sum_date = DATE'2024-01-03'")
    assert sorted((r.hour, float(r.runtime)) for r in got.collect()) == [(1, 30.0), (2, 31.0)]
    assert spark.read.parquet(f"{path}-staged/merged").count() == spark.read.parquet(f"{path}-staged/change").count() == 0


def test_constraint_check_passes_unknown_and_counts_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z")], "id int, kind string")
    got = {r.rule: r.violations for r in quality.rule_violations(
        df, {"kind": F.col("kind").isin("a", "b")}, {"id": ["id"]}).collect()}
    assert got == {"kind": 1, "id": 1}


def test_surrogate_keys_keep_rows_without_a_range(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, None)], "v int, g int")
    assert sorted((r.k, r.v) for r in tables.with_surrogate_key(df, "k", F.col("g"), ["v"]).collect()) == [(1, 1), (2, 3), (3, 2)]


def test_surrogate_keys_are_dense_and_ordered(spark):
    df = spark.range(500).select(((F.col("id") * 7) % 500).alias("v"))
    got = tables.with_surrogate_key(df, "k", F.floor(F.col("v") / 90), ["v"])
    assert got.where(F.col("k") != F.col("v") + 1).count() == 0 and got.count() == 500


def test_closing_twice_gives_the_same_tables(spark):
    r = frames.readings(spark, [("10:00:00", 80), ("10:20:00", 80), ("11:00:00", 80), ("11:30:00", 5)]).drop("key")
    lg = frames.log(spark, [("2024-01-04 00:00:00", "ON")]).drop("key")
    as_of = "2024-01-05 12:10:00"
    closed = closeout.closed_periods(r, lg, frames.thresholds(spark), "hour", "2024-01-05 00:00:00", as_of)
    assert closed.count() == 12
    t = {x.hour: x for x in closeout.hour_table(closed, as_of).collect()}
    assert t[10].btu > 0 and t[10].complete == "no" and t[11].btu == 0.0 and t[10]["count"] == 1
    assert (t[12].btu, t[12].complete, str(t[12].updated)) == (0.0, "no", "2024-01-05 12:00:00")
    assert (t[9].complete, t[9]["count"]) == ("yes", 1) and (t[15].complete, t[15]["count"]) == ("no", 0)


SERIES = [(1, "10:00:00", 80), (1, "10:20:00", 80), (1, "14:00:00", 80), (2, "11:00:00", 80), (2, "11:04:00", 70), (2, "11:30:00", 5), (3, "20:00:00", 90)]
AS_OF = "2024-01-05 18:10:00"


def test_devices_close_the_periods_they_were_seen_in(spark):
    r, lg = frames.readings(spark, [*SERIES, (None, "09:00:00", 80)]), frames.log(spark, [(k, "2024-01-04 00:00:00", "ON") for k in (1, 2, 3)])
    closed = closeout.closed_periods(r, lg, frames.thresholds(spark), "hour", "2024-01-05 00:00:00", AS_OF, keys=["key"])
    got = sorted((x.key, x.hour, x.run_us // 1_000_000, x.complete) for x in closed.collect())
    assert got == [(1, 10, 10, "no"), (1, 11, 0, "yes"), (1, 12, 0, "yes"), (1, 13, 0, "yes"), (1, 14, 0, "no"), (2, 11, 240, "no")]
    slots = {(x.key, x.hour): x for x in closeout.hour_table(closed, AS_OF, ["key"]).collect()}
    assert len(slots) == 48 and slots[1, 10]["count"] == 1 and slots[2, 10]["count"] == 0 and str(slots[2, 18].updated) == "2024-01-05 18:00:00"
    assert closeout.doy_table(closed, AS_OF, ["key"]).count() == 2 * 366
    assert closeout.hour_baselines(closed, ["key"]).count() == 2 * (24 + 24 * 7 + 24 * 4 + 24 * 28)


@pytest.mark.parametrize("seconds", [None, 600])
def test_keyed_close_outs_and_gas_are_those_of_each_device(spark, seconds):
    r = frames.readings(spark, [x for x in SERIES if x[0] != 3])
    lg = frames.log(spark, [(1, "10:10:00", "ON"), (2, "2024-01-04 00:00:00", "ON"), (2, "11:10:00", "OFF")])
    args = frames.thresholds(spark), "hour", "2024-01-05 00:00:00", AS_OF
    both = closeout.closed_periods(r, lg, *args, seconds=seconds, keys=["key"]).collect()
    scored = gas.scored(r, lg, "2024-01-05 00:00:00", AS_OF, seconds, ["key"])
    slots = gas.gas_usage(scored, "hour", AS_OF, ["key"]).collect()
    for k in (1, 2):
        one_r, one_log = (df.where(F.col("key") == k).drop("key") for df in (r, lg))
        plain = {x.period_start: x for x in closeout.closed_periods(one_r, one_log, *args, seconds=seconds).collect()}
        mine = [x for x in both if x.key == k]
        assert mine and all((x.run_us, x.complete) == (plain[x.period_start].run_us, plain[x.period_start].complete) for x in mine)
        assert sum(x.run_us for x in plain.values()) == sum(x.run_us for x in mine)
        alone = gas.gas_usage(gas.scored(one_r, one_log, "2024-01-05 00:00:00", AS_OF, seconds), "hour", AS_OF).collect()
        assert sorted((x.hour, x.btu, x.complete) for x in alone) == sorted((x.hour, x.btu, x.complete) for x in slots if x.key == k)


def test_slot_numbers_have_no_holes(spark):
    grid, days = series.slot_grid(spark), series.calendar(spark).select("month", "day")
    months = series.integers(spark, 1, 12, "month")
    for df, slots in ((grid, ["hour"]), (grid, ["dow"]), (grid, ["hour", "dow"]), (grid, ["hour", "season"]), (grid, ["dow", "season"]),
                      (grid, ["hour", "dow", "season"]), (days, ["month", "day"]), (months, ["month"])):
        got = sorted(r.n for r in df.select(*slots).distinct().select(closeout.slot_number(slots).alias("n")).collect())
        assert got == list(range(len(got)))


def test_each_device_has_every_slot_and_its_own_values(spark):
    grid = spark.range(5).select(F.col("id").cast("int").alias("_slot"), F.concat(F.lit("s"), "id").alias("name"))
    mine = {1: {0: 7}, 2: {4: 8}, 3: {1: 1, 2: None, 4: 3}, 4: {i: i for i in range(5)}}
    known = spark.createDataFrame([(k, i, v) for k, x in mine.items() for i, v in x.items()], "key long, _slot int, v long")
    got = sorted(tuple(r) for r in closeout.on_grid(grid, known, ["key"]).collect())
    assert got == [(k, f"s{i}", x.get(i)) for k, x in mine.items() for i in range(5)]
    assert sorted(tuple(r) for r in closeout.on_grid(grid, known.where("key = 3").drop("key"), []).collect()) == [
        (f"s{i}", mine[3].get(i)) for i in range(5)]


@pytest.mark.parametrize("period, as_of, want", [
    ("day", "2024-03-02 08:00:00", ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]),
    ("month", "2024-05-02 08:00:00", ["2024-02-01", "2024-03-01", "2024-04-01"])])
def test_periods_between_readings_are_closed_empty(spark, period, as_of, want):
    first, last = ("2024-02-27 10:00:00", "2024-03-01 10:00:00") if period == "day" else ("2024-02-27 10:00:00", "2024-04-30 10:00:00")
    r = frames.readings(spark, [(1, first, 80), (1, first.replace(":00:00", ":04:00"), 80), (1, last, 80), (2, last, None)])
    lg = frames.log(spark, [(k, "2024-01-04 00:00:00", "ON") for k in (1, 2)])
    closed = closeout.closed_periods(r, lg, frames.thresholds(spark), period, "2024-01-01 00:00:00", as_of, keys=["key"]).collect()
    mine = sorted((str(x.period_start)[:10], x.run_us, x.complete) for x in closed if x.key == 1)
    assert mine == [(d, 240_000_000 if d == want[0] else 0, "no" if d == want[-1] else "yes") for d in want]
    assert [(str(x.period_start)[:10], x.run_us, x.complete) for x in closed if x.key == 2] == [(want[-1], 0, "yes")]


# ---- sources and model --------------------------------------------------------------------


def test_tsv_keeps_nulls_and_empty_text(spark):
    path = scratch_path(spark, "tsv")
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a\tb\\t\nc")], "id int, t string")
    files.write_tsv(df, path)
    assert {r.id: r.t for r in files.read_tsv(spark, path, "id int, t string").collect()} == {1: None, 2: "", 3: "a\tb\\t\nc"}


def test_weather_document(spark):
    doc = ('{"history": {"dailysummary": [{"heatingdegreedays": "31", "meandewpti": "20", "meanpressurei": "29.95", '
           '"meantempi": "34", "meanvisi": "", "meanwdird": "270", "meanwindspdi": "11"}]}}')
    df = spark.createDataFrame([(doc,)], "doc string").select(files.parse_daily_weather(F.col("doc")).alias("w"))
    w = df.select("w.*").first()
    assert (w.hdd, w.mean_dewpoint, w.mean_pressure, w.mean_temperature, w.mean_wind_direction) == (
        31, 20, Decimal("29.95"), 34, 270)
    assert w.mean_visibility is None


# Fixed values: (watts, firing level) of the usable training rows.
TRAINING = (
    (71, 40), (313, 100), (318, 100), (283, 100), (286, 100), (253, 97), (251, 97), (215, 93), (185, 88),
    (186, 88), (166, 84), (169, 84), (141, 80), (121, 75), (110, 70), (97, 65), (90, 59), (82, 52), (75, 45),
    (73, 45), (70, 40), (78, 47), (80, 48), (78, 47), (76, 46), (74, 44), (71, 41), (93, 61), (91, 59), (82, 52),
    (78, 47), (74, 45), (73, 44), (70, 40), (71, 40), (73, 40),
)


def test_degree_five_fit_gives_the_fixed_curve(spark):
    df = spark.createDataFrame([(float(w), float(h)) for w, h in TRAINING], "watts double, heat double")
    grid = spark.range(69, 319).select(F.col("id").cast("double").alias("watts"))
    p = model.predict(model.fit(df, "watts", "heat"), grid, "watts")
    worst = p.select(F.max(F.abs(F.col("prediction") - model.firing_level(F.col("watts"))))).first()[0]
    assert worst < 1e-5
    at = {w: p.where(F.col("watts") == w).first().prediction for w in (69, 100, 200)}
    assert at == pytest.approx({69: 38.0, 100: 65.1, 200: 89.9}, abs=0.05)


def test_clamp_mask_and_heat(spark):
    df = spark.createDataFrame([(10.0, "ON"), (70.0, "ON"), (120.0, "ON"), (70.0, "OFF"), (10.0, None)], "l double, s string")
    got = df.select(model.clamp_mask(F.col("l"), F.col("s")).alias("l"), "s").select(
        "l", model.heat(F.col("l"), F.lit(3_600_000_000), F.col("s"))).collect()
    assert [tuple(r) for r in got] == [(40.0, 24000.0), (70.0, 42000.0), (100.0, 60000.0), (0.0, None), (40.0, None)]


def test_rows_of_zero_or_unknown_leave_the_training_set(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (None, 1), (2, 0)], "a int, b int")
    assert model.drop_zero(df, ["a", "b"]).count() == 1


def test_views_answer_sql(spark, small):
    from emberline.plans import views
    from emberline.sources import fixtures as fx

    names = views.register(views.Inputs(
        fx.order_hours(spark, small, live=False), fx.order_hours(spark, small), fx.deliveries(spark, small),
        fx.climatology(spark, small), fx.forecast(spark, small), fx.O_AS_OF))
    assert len(names) == 25
    daily, yearly = (spark.sql(f"SELECT sum(runtime) FROM {v}").first()[0] for v in ("sums_daily", "sums_yearly"))
    assert daily == yearly
    assert spark.sql("SELECT count(*) FROM plot_hourly").first()[0] == 24
    assert spark.sql("SELECT tank_level FROM remaining_fuel").first()[0] is not None
