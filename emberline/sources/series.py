"""Generated series: integers, time spines, the calendar and slot grids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


SEASONS = ("winter", "spring", "summer", "fall")


def integers(spark: SparkSession, first: int, last: int, name: str) -> DataFrame:
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias(name))


def spine(bounds: DataFrame, lo: str, hi: str, step: str, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every step from ``lo`` to ``hi`` of each row of ``bounds``, both ends included."""
    return bounds.select(*keep, F.explode(F.sequence(lo, hi, F.expr(f"INTERVAL {step}"))).alias(name))


def dates(spark: SparkSession, first: str, last: str, name: str) -> DataFrame:
    one = spark.range(1).select(F.lit(first).cast("date").alias("lo"), F.lit(last).cast("date").alias("hi"))
    return spine(one, "lo", "hi", "1 DAY", name)


def calendar(spark: SparkSession) -> DataFrame:
    """The 366 days of a leap year: both day numbers (29 February has none in a common year)."""
    d = F.col("d")
    after = (F.dayofyear(d) > 60).cast("int")
    return dates(spark, "2000-01-01", "2000-12-31", "d").select(
        F.when((F.month(d) == 2) & (F.dayofmonth(d) == 29), None)
        .otherwise(F.dayofyear(d) - after).alias("doy_noleap"),
        F.dayofyear(d).alias("doy_leap"), F.month(d).alias("month"), F.dayofmonth(d).alias("day"),
    )


def slot_grid(spark: SparkSession, season: bool = True) -> DataFrame:
    """All hour x weekday (x season) slots, built by exploding fixed ranges."""
    g = spark.range(24).select(
        F.col("id").cast("int").alias("hour"),
        F.explode(F.sequence(F.lit(0), F.lit(6))).alias("dow"),
    )
    if not season:
        return g
    return g.select("hour", "dow", F.explode(F.array(*[F.lit(s) for s in SEASONS])).alias("season"))
