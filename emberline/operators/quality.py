"""Is a period's data complete, and does a table keep its rules?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emberline.functions.calendar import days_in_month

MAX_GAP_US = 300 * 1_000_000


def yes_no(ok: Column) -> Column:
    return F.when(ok, "yes").otherwise("no")


def complete_any_gap(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``no`` where a gap of 300 s or more carries power. No such row, or no row: ``yes``."""
    bad = (F.col("gap_us") >= MAX_GAP_US) & (F.col("gap_us") * F.col("watts") > 0)
    return df.groupBy(*keys).agg(
        yes_no(~F.coalesce(F.bool_or(bad), F.lit(False))).alias("complete"))


def complete_max_gap(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``yes`` where the longest gap is below 300 s; no known gap is ``no``."""
    return df.groupBy(*keys).agg(yes_no(F.max("gap_us") < MAX_GAP_US).alias("complete"))


def complete_coverage(df: DataFrame, keys: Sequence[str], span: str) -> DataFrame:
    """Readings reach from the first to the last day of the month or year, gaps below 300 s."""
    first, last = F.min("ts"), F.max("ts")
    if span == "month":
        reach = (F.dayofmonth(first) == 1) & (F.dayofmonth(last) == days_in_month(last))
    else:
        reach = (F.dayofyear(first) == 1) & (F.month(last) == 12) & (F.dayofmonth(last) == 31)
    return df.groupBy(*keys).agg(yes_no(reach & (F.max("gap_us") < MAX_GAP_US)).alias("complete"))


def rule_violations(df: DataFrame, rules: dict[str, Column], unique: dict[str, Sequence[str]]) -> DataFrame:
    """One row per rule with the number of offending rows, all value rules in one pass.

    A rule holds unless it is false; unknown passes, as in an SQL check. Uniqueness counts the
    rows beyond the first of each key.
    """
    counted = df.agg(*[
        F.count(F.when(~rule, 1)).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    out = counted.selectExpr(f"stack({len(rules)}, {pairs}) AS (rule, violations)")
    for name, cols in unique.items():
        extra = df.groupBy(*cols).agg((F.count("*") - 1).alias("n"))
        out = out.unionByName(extra.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violations")).select(
            F.lit(name).alias("rule"), "violations"))
    return out
