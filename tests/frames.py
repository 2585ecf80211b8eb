"""Small hand-built inputs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text if "T" in text or " " in text else f"2024-01-05 {text}")


def readings(spark, rows, key=1):
    """rows: (time, watts) or (key, time, watts)."""
    full = [r if len(r) == 3 else (key, *r) for r in rows]
    data = [(k, at(t), i, None if w is None else Decimal(str(w))) for i, (k, t, w) in enumerate(full)]
    return spark.createDataFrame(data, "key long, ts timestamp_ntz, tie long, watts decimal(10,2)")


def log(spark, rows, key=1):
    full = [r if len(r) == 3 else (key, *r) for r in rows]
    data = [(k, at(t), i, s) for i, (k, t, s) in enumerate(full)]
    return spark.createDataFrame(data, "key long, ts timestamp_ntz, tie long, status string")


def thresholds(spark, rows=(("2024-01-01 00:00:00", 60, 20),)):
    return spark.createDataFrame([(at(t), hi, lo) for t, hi, lo in rows], "change_time timestamp_ntz, hi int, lo int")


def hours(spark, rows):
    """rows: (date, hour, runtime)."""
    data = [(dt.date.fromisoformat(d), h, Decimal(str(r))) for d, h, r in rows]
    return spark.createDataFrame(data, "sum_date date, hour int, runtime decimal(12,2)")


def deliveries(spark, rows):
    data = [(dt.date.fromisoformat(d), f, Decimal(str(g))) for d, f, g in rows]
    return spark.createDataFrame(data, "delivery_date date, fill boolean, gallons decimal(12,2)")
