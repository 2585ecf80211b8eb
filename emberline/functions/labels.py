"""Chart labels and status lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMM")


def weekday_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def day_label(d: Column) -> Column:
    """``Feb - 01``."""
    return F.concat_ws(" - ", month_name(d), F.lpad(F.dayofmonth(d).cast("string"), 2, "0"))


def one_place(x: Column) -> Column:
    """One decimal as text, rounded on the decimal value."""
    return F.round(x.cast("decimal(30,8)"), 1).cast("decimal(30,1)").cast("string")


# The wording of the two daily lines.
HEATING_LINE = (
    "Boiler: %sh, %d cycles, mean of %s min/cycle. Circulator: %sh, %d cycles, "
    "mean of %s min/cycle. %s btu, %s gal, %s kwh."
)
DRYING_LINE = (
    "Dehumidifier: total runtime %s hours, %d cycles, mean of %s minutes per cycle. "
    "The mean temp was %d and the mean dewpoint was %d."
)


def heating_status_line(runtime_min, cycles, mean_min, low_runtime_min, low_cycles, low_mean_min, btu, gal, kwh) -> Column:
    return F.format_string(
        HEATING_LINE,
        one_place(runtime_min / 60), cycles, one_place(mean_min),
        one_place(low_runtime_min / 60), low_cycles, one_place(low_mean_min),
        F.round(btu.cast("decimal(30,8)"), 0).cast("decimal(30,0)").cast("string"),
        one_place(gal), one_place(kwh),
    )


def drying_status_line(hours, cycles, mean_min, temperature, dewpoint) -> Column:
    return F.format_string(
        DRYING_LINE,
        one_place(hours), cycles, one_place(mean_min), temperature, dewpoint,
    )
