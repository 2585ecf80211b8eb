"""Tables that change by snapshots: whole changes, repeats, two writers, a writer that stops."""

import frames
import pytest

from emberline.operators import snapshots
from emberline.session import scratch_path


@pytest.fixture
def path(spark):
    path = scratch_path(spark, "table")
    snapshots.create(spark, path, frames.hours(spark, []).schema)
    snapshots.upsert_days(path, frames.hours(spark, [("2024-01-01", 1, 1), ("2024-01-01", 2, 2), ("2024-01-02", 1, 3)]), KEYS)
    return path


KEYS = ["sum_date", "hour"]


def _rows(df):
    return sorted((str(r.sum_date), r.hour, float(r.runtime)) for r in df.collect())


OLD = [("2024-01-01", 1, 1.0), ("2024-01-01", 2, 2.0), ("2024-01-02", 1, 3.0)]
NEW = [("2024-01-01", 1, 1.0), ("2024-01-01", 2, 20.0), ("2024-01-01", 3, 30.0), ("2024-01-02", 1, 3.0)]


def _change(spark):
    return frames.hours(spark, [("2024-01-01", 2, 20), ("2024-01-01", 3, 30)])


def test_a_change_touches_only_its_days_and_repeats_safely(spark, path):
    before = snapshots.snapshot(spark, path, 1)["days"]
    for number in (2, 3):
        assert snapshots.upsert_days(path, _change(spark), KEYS) == number
        assert _rows(snapshots.read(spark, path)) == NEW
    after = snapshots.snapshot(spark, path, 3)["days"]
    assert before["2024-01-02"] == after["2024-01-02"] and before["2024-01-01"] != after["2024-01-01"]
    assert _rows(snapshots.read(spark, path, 1)) == OLD and _rows(snapshots.read(spark, path, 0)) == []


def test_a_change_that_stops_half_way_leaves_the_table_as_it_was(spark, path, monkeypatch):
    def stop(*_):
        raise RuntimeError("stopped")

    reader = snapshots.read(spark, path)
    with monkeypatch.context() as m:
        m.setattr(snapshots, "commit", stop)  # all days are written, the pointer is not
        with pytest.raises(RuntimeError):
            snapshots.upsert_days(path, _change(spark), KEYS)
    assert _rows(snapshots.read(spark, path)) == OLD
    snapshots.upsert_days(path, _change(spark), KEYS)
    assert _rows(snapshots.read(spark, path)) == NEW
    assert _rows(reader) == OLD  # who began to read before still sees that table


def test_of_two_writers_none_is_lost(spark, path, monkeypatch):
    real, other = snapshots.commit, frames.hours(spark, [("2024-01-01", 9, 90), ("2024-01-03", 1, 9)])
    waiting = [other]

    def late(*how):
        if waiting:  # another change gets in between
            snapshots.upsert_days(path, waiting.pop(), KEYS)
        return real(*how)

    monkeypatch.setattr(snapshots, "commit", late)
    snapshots.upsert_days(path, _change(spark), KEYS)
    assert _rows(snapshots.read(spark, path)) == sorted([*NEW, ("2024-01-01", 9, 90.0), ("2024-01-03", 1, 9.0)])
    assert snapshots.numbers(spark, path) == [0, 1, 2, 3]


def test_forgetting_keeps_what_is_named(spark, path):
    for _ in range(3):
        snapshots.upsert_days(path, _change(spark), KEYS)
    snapshots.forget(spark, path, keep=1)
    assert snapshots.numbers(spark, path) == [4]
    assert _rows(snapshots.read(spark, path)) == NEW


def test_nothing_new_and_no_date(spark, path):
    assert snapshots.upsert_days(path, frames.hours(spark, []), KEYS) == 1
    undated = spark.createDataFrame([(None, 5, 1)], "sum_date date, hour int, runtime int").selectExpr(
        "sum_date", "hour", "CAST(runtime AS DECIMAL(12,2)) AS runtime")
    snapshots.upsert_days(path, undated, KEYS)
    snapshots.upsert_days(path, undated, KEYS)
    assert _rows(snapshots.read(spark, path)) == sorted([*OLD, ("None", 5, 1.0)])
