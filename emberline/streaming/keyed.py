"""Run detection in Spark's keyed state store: what a micro-batch costs follows the devices in it.

Each device keeps its waiting rows, its last reading and status and its number of starts. An event-time timer
stands at its earliest waiting row; when the watermark passes it, the rows up to the watermark are complete, are put in
order and classified, and the timer moves on. The result is therefore that of the batch form however the feed is cut.
Spark drops rows that come later than the watermark and counts them in the progress of the query; the form by
micro-batch (``runs.stream_runs_by_batch``) keeps them, and splits a busy device over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from emberline.functions.calendar import epoch_micros, ntz
from emberline.operators.states import IDLE, RUNNING, in_before, threshold_as_of
from emberline.streaming.hourly import run_to_end
from emberline.streaming.runs import STATE_TABLE, run_batch

WAITING = "ts_us long, kind int, tie long, cents long, above boolean, is_on boolean"
LAST = ("status boolean, status_us long, status_tie long, last_us long, last_tie long, last_cents long, last_main boolean, "
        "last_state string, starts long, timer long")
ROWS = "key long, ts_us long, tie long, cents long, gap_us long, main_status string, system_status string, run_id long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NAMES = [c.split()[0] for c in WAITING.split(", ")]


def stored_rows(rows: pd.DataFrame) -> list[tuple]:
    """Rows as the state takes them: whole numbers, flags and None, where columns with nulls came as fractions."""
    kinds = [bool if c.endswith("boolean") else int for c in WAITING.split(", ")]
    return list(zip(*([None if pd.isna(v) else kind(v) for v in rows[name]] for name, kind in zip(NAMES, kinds, strict=True)), strict=True))


def classified(rows: pd.DataFrame, last: dict, running: str) -> tuple[pd.DataFrame, dict]:
    """Gap, states and run id of the readings among ordered ``rows`` of one device, and what it hands on."""
    last = dict(last)
    known = rows["is_on"].notna()
    main = rows["is_on"].where(known).ffill()
    if last["status"] is not None:
        main = main.where(main.notna(), last["status"])
    if known.any():
        mark = rows[known].iloc[-1]
        last.update(status=bool(mark["is_on"]), status_us=int(mark["ts_us"]), status_tie=int(mark["tie"]))
    here = (rows["kind"] == 1).to_numpy()
    reads, main = rows[here], main[here]
    on, off = (main == True).to_numpy(), (main == False).to_numpy()  # noqa: E712 - unknown is neither
    above, below = ((reads["above"] == v).to_numpy() for v in (True, False))
    state = np.select([on & below, on & above, off], [IDLE, running, "OFF"], default="")
    before = np.concatenate([[last["last_state"] or ""], state[:-1]])
    starts = (last["starts"] or 0) + np.cumsum((state == running) & (before != running) & (before != ""))
    at = reads["ts_us"].to_numpy(np.int64)
    first = pd.NA if last["last_us"] is None else last["last_us"]
    out = pd.DataFrame({
        "ts_us": at, "tie": reads["tie"].to_numpy(), "cents": reads["cents"].to_numpy(np.int64),
        "gap_us": pd.Series(at).astype("Int64") - pd.array([first, *at[:-1]][:len(at)], "Int64"),
        "main_status": np.select([on, off], ["ON", "OFF"], default=None), "system_status": np.where(state == "", None, state),
        "run_id": pd.Series(starts).astype("Int64").mask((state != "") & (state != running)),
    })
    if len(at):
        end = reads.iloc[-1]
        last.update(last_us=int(at[-1]), last_tie=int(end["tie"]), last_cents=int(end["cents"]),
                    last_main=None if pd.isna(main.iloc[-1]) else bool(main.iloc[-1]), last_state=state[-1].item() or None, starts=int(starts[-1]))
    return out, last


class RunState(StatefulProcessor):
    """Keeps rows until the watermark passes them, then classifies them in order."""

    def __init__(self, running: str):
        self.running = running

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", WAITING)
        self.last = handle.getValueState("last", LAST)

    def held(self) -> dict:
        names = [c.split()[0] for c in LAST.split(", ")]
        return dict(zip(names, self.last.get() if self.last.exists() else [None] * len(names), strict=True))

    def keep(self, last: dict, next_us: int | None) -> None:
        """Stores ``last`` with the timer at the earliest waiting row."""
        at = None if next_us is None else max(0, next_us // 1000)
        if last["timer"] != at:
            if last["timer"] is not None:
                self.handle.deleteTimer(last["timer"])
            if at is not None:
                self.handle.registerTimer(at)
        self.last.update(tuple({**last, "timer": at}.values()))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        last, earliest = self.held(), []
        if last["timer"] is not None:
            earliest.append(last["timer"] * 1000)
        for batch in rows:
            earliest.append(int(batch["ts_us"].min()))
            self.waiting.appendList(stored_rows(batch))
        self.keep(last, min(earliest))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        rows = pd.DataFrame([tuple(r) for r in self.waiting.get()], columns=NAMES)
        passed = rows["ts_us"] <= mark
        last = {**self.held(), "timer": None}
        if passed.any():
            out, last = classified(rows[passed].sort_values(["ts_us", "kind", "tie"], kind="stable").reset_index(drop=True), last, self.running)
            rows = rows[~passed]
            if len(rows):
                self.waiting.put(stored_rows(rows))
            else:
                self.waiting.clear()
            if len(out):
                out.insert(0, "key", key[0])
                yield out
        self.keep(last, int(rows["ts_us"].min()) if len(rows) else None)

    def close(self) -> None:
        pass


def ordered_rows(feed: DataFrame, thresholds: DataFrame, which: str, start: str, end: str, delay: str) -> DataFrame:
    """The rows of a feed as the state keeps them, with the watermark on their time."""
    rows = in_before(feed.where("key IS NOT NULL"), end)
    rows = rows.where((F.col("watts").isNotNull() & (F.col("ts") >= ntz(start))) | F.col("status").isin("ON", "OFF"))
    rows = threshold_as_of(rows, thresholds, end)
    reading = F.col("watts").isNotNull()
    return rows.select(
        "key", F.timestamp_micros(epoch_micros(F.col("ts"))).alias("at"), epoch_micros(F.col("ts")).alias("ts_us"),
        F.when(reading, 1).otherwise(0).alias("kind"), "tie", (F.col("watts") * 100).cast("long").alias("cents"),
        F.when(reading, F.col("watts") >= F.col(which)).alias("above"), F.when(~reading, F.col("status") == "ON").alias("is_on"),
    ).withWatermark("at", delay)


def time_of(us: str):
    return F.timestamp_add("MICROSECOND", F.col(us), ntz("1970-01-01 00:00:00"))


def power_of(cents: str):
    return (F.col(cents).cast("decimal(18,0)") / 100).cast("decimal(10,2)")


def stored(spark: SparkSession, checkpoint: str, name: str) -> DataFrame:
    """A state variable as a table, as the last finished micro-batch left it."""
    return spark.read.format("statestore").option("path", checkpoint).option("stateVarName", name).load()


def open_rows(spark: SparkSession, checkpoint: str, thresholds: DataFrame, which: str, start: str, end: str) -> DataFrame:
    """Runs of the rows that still wait, by the batch form; they come again, and may change, when the stream goes on."""
    held = stored(spark, checkpoint, "waiting").select("key.key", "list_element.*")
    on_off = lambda c: F.when(F.col(c), "ON").when(~F.col(c), "OFF")
    batch = held.select("key", time_of("ts_us").alias("ts"), "tie", power_of("cents").alias("watts"), on_off("is_on").alias("status"))
    state = stored(spark, checkpoint, "last").select("key.key", "value.*").select(
        "key", on_off("status").alias("status"), time_of("status_us").alias("status_ts"), "status_tie", time_of("last_us").alias("last_ts"),
        "last_tie", power_of("last_cents").alias("last_watts"), on_off("last_main").alias("last_main"), "starts")
    assert [c.split()[0] for c in STATE_TABLE.split(", ")] == state.columns
    return run_batch(batch, state, thresholds, which, start, end)


def stream_runs(
    feed: DataFrame, thresholds: DataFrame, which: str, start: str, end: str, sink: str, checkpoint: str,
    delay: str = "1 hour", trigger: dict | None = None, flush: bool = True,
) -> DataFrame:
    """Runs over a stream of ``(key, ts, tie, watts, status)`` rows; ``status`` is null on plain readings.

    The rows of :func:`classify_runs` over all that was not late. Finished rows are appended to ``sink`` by
    Spark's file sink, once each whatever fails. A next call with the same folders goes on. ``flush`` adds
    the rows that still wait. Rows without a device or time, and readings without power, are left out.
    """
    spark = feed.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        runs = ordered_rows(feed, thresholds, which, start, end, delay).groupBy("key").transformWithStateInPandas(
            RunState(RUNNING[which]), ROWS, outputMode="append", timeMode="EventTime")
        run_to_end(runs.writeStream.outputMode("append").format("parquet").option("path", sink), spark, "runs", checkpoint, trigger)
    finally:
        spark.conf.set(PROVIDER, before)
    done = spark.read.schema(ROWS).parquet(sink).select(
        "key", time_of("ts_us").alias("ts"), "tie", power_of("cents").alias("watts"), "gap_us", "main_status", "system_status", "run_id")
    return done.unionByName(open_rows(spark, checkpoint, thresholds, which, start, end)) if flush else done
