"""Interval quantities: capped time, heat, fuel and electric energy."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the burner and tank.
BTU_PER_GALLON = 140000.0
GALLONS_PER_HOUR = 0.666205227383988
GAP_LIMIT_S = 600
GAP_SUBSTITUTE_S = 10
FULL_FIRE_BTU_PER_HOUR = 60000.0
TANK_GALLONS = 260.0

US = 1_000_000
US_PER_MINUTE = 6e7
US_PER_HOUR = 3.6e9
W_US_PER_KWH = 3.6e12


def capped_gap(gap_us: Column, limit_s: int = GAP_LIMIT_S, substitute_s: int = GAP_SUBSTITUTE_S) -> Column:
    """A gap over the limit is a break in the data and counts as a short interval."""
    return F.when(gap_us > limit_s * US, F.lit(substitute_s * US).cast("long")).otherwise(gap_us)


def minutes(us: Column) -> Column:
    return us.cast("double") / US_PER_MINUTE


def gallons(us: Column) -> Column:
    return us.cast("double") * GALLONS_PER_HOUR / US_PER_HOUR


def btu(us: Column) -> Column:
    return us.cast("double") * (BTU_PER_GALLON * GALLONS_PER_HOUR) / US_PER_HOUR


def watt_micros(watts: Column, gap_us: Column) -> Column:
    """Exact power x time product, so that sums do not depend on their order."""
    return watts.cast("decimal(14,2)") * gap_us


def kwh(w_us: Column) -> Column:
    return w_us.cast("double") / W_US_PER_KWH


def gallons_of_minutes(m: Column) -> Column:
    return m / 60 * GALLONS_PER_HOUR


def exact_sum(x: Column) -> Column:
    """A sum of doubles that does not depend on their order: each is taken as a decimal of twelve places."""
    return F.sum(x.cast("decimal(28,12)")).cast("double")


def rounded(x: Column, n: int) -> Column:
    return F.round(x, n)
