"""Ordered scans of long series in time chunks.

A window over a whole series puts the series into one task. When the busiest key has more rows
than a task should hold, the scans in this package work per (key, time chunk) instead: rows are
shuffled once by both, windows stay inside a chunk, and what must cross a chunk border (last
state, last reading, running totals) travels through a summary with one row per (key, chunk).

A row without a device (a null in ``keys``) belongs to no series: in either form it is kept, and what a
scan would add to it is null. Rows without a time come before all others of their device, as in a window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.functions.calendar import epoch_micros

US = 1_000_000
MAX_ROWS_PER_TASK = 2_000_000
CHUNK_CHOICES = (86400, 21600, 3600, 600, 60, 10, 1)
PERIOD_SECONDS = {"hour": 3600, "day": 86400, "month": 86400, "year": 86400, None: 86400}
CHUNK = "_chunk"
SMALL_ROW = 8  # bytes; less than a row of readings takes in files
SHORT_CHUNK = 3600  # a window over longer chunks holds at most 8,784 rows for each year of a key
STRETCH = 3600  # so many shorter chunks are summed up before the window over a key
BEFORE_ALL = -(1 << 62)  # the chunk of rows without a time


def chunk_of(ts: Column, seconds: int) -> Column:
    """Start of the ``seconds``-long chunk that holds ``ts``, in microseconds from 1970."""
    at = epoch_micros(ts)
    return F.coalesce(at - F.pmod(at, F.lit(seconds * US)), F.lit(BEFORE_ALL))


def estimated_bytes(df: DataFrame) -> int:
    """The size of the optimized plan's result, as its statistics have it."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def choose_chunk(
    df: DataFrame, keys: Sequence[str], ts: str, period: str | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> int | None:
    """Chunk length in seconds, or None where every key fits one task whole.

    A table that by the optimizer's estimate is small needs no closer look, and no job runs. Otherwise rows are
    counted per (key, hour) with map-side combine and one row reaches the driver.
    """
    if estimated_bytes(df) <= SMALL_ROW * max_rows:
        return None
    hourly = df.groupBy(*keys, chunk_of(F.col(ts), 3600).alias("h")).agg(F.count("*").alias("n"))
    daily = hourly.groupBy(*keys, (F.col("h") - F.pmod("h", F.lit(86400 * US))).alias("d")).agg(
        F.sum("n").alias("n"), F.max("n").alias("hour_max"))
    top = daily.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.max("n").alias("day_max"), F.max("hour_max").alias("hour_max"),
    ).agg(F.max("n"), F.max("day_max"), F.max("hour_max")).first()
    total, day_max, hour_max = (x or 0 for x in top)
    if total <= max_rows:
        return None
    longest = PERIOD_SECONDS[period]
    if day_max <= max_rows and longest == 86400:
        return 86400
    for seconds in CHUNK_CHOICES:
        if seconds <= min(longest, 3600) and hour_max * seconds / 3600 <= max_rows:
            return seconds
    return 1


def with_chunk(df: DataFrame, ts: str, seconds: int | None) -> DataFrame:
    """Adds the chunk number once; a series that is not split is one chunk.

    The column stays on the rows from scan to scan: as long as it is the same column, Spark sees
    that the rows are already partitioned by it and shuffles them only once.
    """
    if seconds is None or CHUNK in df.columns:
        return df
    return df.withColumn(CHUNK, chunk_of(F.col(ts), seconds))


def of_series(keys: Sequence[str], value: Column) -> Column:
    """The value on rows that have a device, null on others."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], F.lit(True))
    return F.when(known, value) if keys else value


def ordered(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def up_to_here(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before_here(w):
    return w.rowsBetween(Window.unboundedPreceding, -1)


def after_here(w):
    return w.rowsBetween(1, Window.unboundedFollowing)


def along_chunks(keys: Sequence[str]):
    """Over a summary with one row per (key, chunk)."""
    return Window.partitionBy(*keys).orderBy(CHUNK)


def over_chunks(parts: DataFrame, keys: Sequence[str], take: dict[str, tuple[str, str]], seconds: int) -> DataFrame:
    """Adds to a summary with one row per (key, chunk) what comes from the key's other chunks.

    ``take`` is ``name: (kind, column)``: the "last" known value before the chunk, the "next" known one after it, or the
    "sum" over all before. Short chunks go by two levels, inside a stretch of chunks and over stretches, so no
    task orders all chunks of a key, nor those of a series without keys.
    """
    pick = {
        "last": lambda c, w: F.last(c, ignorenulls=True).over(before_here(w)),
        "next": lambda c, w: F.first(c, ignorenulls=True).over(after_here(w)),
        "sum": lambda c, w: F.sum(c).over(before_here(w)),
    }
    if seconds >= SHORT_CHUNK:
        return parts.withColumns({name: pick[kind](c, along_chunks(keys)) for name, (kind, c) in take.items()})
    stretch = F.when(F.col(CHUNK) == BEFORE_ALL, F.col(CHUNK)).otherwise(F.col(CHUNK) - F.pmod(F.col(CHUNK), F.lit(STRETCH * seconds * US)))
    parts = parts.withColumn("_stretch", stretch)
    whole = {
        "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col(CHUNK))),
        "next": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col(CHUNK))),
        "sum": F.sum,
    }
    along = Window.partitionBy(*keys).orderBy("_stretch")
    ends = parts.groupBy(*keys, "_stretch").agg(*(whole[kind](c).alias(name) for name, (kind, c) in take.items()))
    far = ends.select(*keys, "_stretch", *(pick[kind](name, along).alias(f"_far_{name}") for name, (kind, _) in take.items()))
    near = Window.partitionBy(*keys, "_stretch").orderBy(CHUNK)
    out = parts.withColumns({name: pick[kind](c, near) for name, (kind, c) in take.items()}).join(far, [*keys, "_stretch"], "left")
    joined = {name: F.coalesce(F.col(name) + F.col(f"_far_{name}"), name, f"_far_{name}") if kind == "sum" else F.coalesce(name, f"_far_{name}")
              for name, (kind, _) in take.items()}
    return out.withColumns(joined).drop("_stretch", *(f"_far_{name}" for name in take))


def inside(keys: Sequence[str], seconds: int | None) -> list[str]:
    return [*keys] if seconds is None else [*keys, CHUNK]


def attach(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Brings the per-chunk summary to the rows. Both sides are partitioned alike already."""
    return rows.join(carry, [*keys, CHUNK], "left")


def _done(rows: DataFrame, given: DataFrame) -> DataFrame:
    return rows if CHUNK in given.columns else rows.drop(CHUNK)


def fill_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
    seconds: int | None = None,
) -> DataFrame:
    """Replaces each column by its last non-null value up to the row; rows without a device keep theirs."""
    rows = with_chunk(df, order[0], seconds)
    w = up_to_here(ordered(inside(keys, seconds), order))
    filled = {c: F.coalesce(of_series(keys, F.last(c, ignorenulls=True).over(w)), F.col(c)) for c in cols}
    if seconds is None:
        return rows.withColumns(filled)
    # a chunk's last row has what the chunk hands on
    rows = rows.withColumns({**filled, "_end": F.lead(F.lit(1)).over(ordered(inside(keys, seconds), order)).isNull()})
    ends = rows.where("_end").select(*keys, CHUNK, *cols)
    carry = over_chunks(ends, keys, {f"_in_{c}": ("last", c) for c in cols}, seconds).drop(*cols)
    out = attach(rows.drop("_end"), carry, keys)
    out = out.withColumns({c: F.coalesce(c, f"_in_{c}") for c in cols})
    return _done(out.drop(*[f"_in_{c}" for c in cols]), df)


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: Column | str, name: str,
    seconds: int | None = None, peers: bool = False,
) -> DataFrame:
    """Running total. ``peers`` gives rows of equal order the same total (the SQL default frame)."""
    rows = with_chunk(df.withColumn("_x", F.col(col) if isinstance(col, str) else col), order[0], seconds)
    w = ordered(inside(keys, seconds), order)
    total = F.sum("_x").over(w if peers else up_to_here(w))
    if seconds is None:
        return rows.withColumn(name, of_series(keys, total)).drop("_x")
    part = rows.groupBy(*keys, CHUNK).agg(F.sum("_x").alias("_p"))
    offset = over_chunks(part, keys, {"_off": ("sum", "_p")}, seconds).drop("_p")
    out = attach(rows.withColumn("_s", total), offset, keys)
    both = F.coalesce(F.col("_s") + F.col("_off"), F.col("_s"), F.col("_off"))
    return _done(out.withColumn(name, of_series(keys, both)).drop("_x", "_s", "_off"), df)


def first_crossing(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], col: Column, limits: Sequence[float], seconds: int,
    measure: Callable[[Column], Column] = lambda total: total,
) -> DataFrame:
    """(keys.., limit, crossed): where in ``order`` the running total of ``col`` first exceeds each limit, else null.

    ``measure`` turns a total into the unit of the limits and must not fall as totals rise. Sums of chunks tell which chunks
    may hold a crossing, and only their rows are ordered: one chunk for each limit if no value is negative, otherwise also
    those before it that rise above the limit within. Rows without a device cross nothing; without rows there is no result.
    """
    rows = with_chunk(df.withColumn("_x", col), order[0], seconds)
    zero = lambda c: F.coalesce(c, F.lit(0))
    parts = rows.groupBy(*keys, CHUNK).agg(zero(F.sum("_x")).alias("_sum"), zero(F.sum(F.when(F.col("_x") > 0, F.col("_x")))).alias("_rise"))
    parts = over_chunks(parts, keys, {"_off": ("sum", "_sum")}, seconds).withColumn("_off", zero(F.col("_off")))
    parts = parts.withColumn("limit", F.explode(F.array(*(F.lit(float(x)) for x in limits))))
    above = lambda c: measure(F.col("_off") + F.col(c)) > F.col("limit")
    ends = parts.groupBy(*keys, "limit").agg(F.min(F.when(above("_sum"), F.col(CHUNK))).alias("_at"))
    near = parts.where(above("_rise")).join(ends, [*keys, "limit"]).where(F.col("_at").isNull() | (F.col(CHUNK) <= F.col("_at")))
    near = rows.select(*keys, CHUNK, *order, "_x").join(near.select(*keys, CHUNK, "limit", "_off"), [*keys, CHUNK])
    here = up_to_here(ordered([*keys, CHUNK, "limit"], order))
    near = near.withColumn("_sum", zero(F.sum("_x").over(here))).where(above("_sum"))
    crossed = near.groupBy(*keys, "limit").agg(F.min(order[0]).alias("crossed"))
    return ends.drop("_at").join(crossed, [*keys, "limit"], "left")


def previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str],
    seconds: int | None = None,
) -> DataFrame:
    """For each ``source: name`` adds the value of the row before, across chunk borders."""
    return _neighbour(df, keys, order, cols, seconds, F.lag, F.lead, "last")


def following(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: dict[str, str],
    seconds: int | None = None,
) -> DataFrame:
    """For each ``source: name`` adds the value of the row after, across chunk borders."""
    return _neighbour(df, keys, order, cols, seconds, F.lead, F.lag, "next")


def _neighbour(df, keys, order, cols, seconds, step, back, kind):
    rows = with_chunk(df, order[0], seconds)
    w = ordered(inside(keys, seconds), order)
    near = {name: of_series(keys, step(c).over(w)) for c, name in cols.items()}
    if seconds is None:
        return rows.withColumns(near)
    one = F.lit(1)
    rows = rows.withColumns({
        **near, "_alone": step(one).over(w).isNull(), "_edge": back(one).over(w).isNull()})
    # the outermost row of a chunk is the neighbour of the next chunk's outermost row
    edge = rows.where("_edge").select(*keys, CHUNK, F.struct(*cols).alias("_own"))
    carry = over_chunks(edge, keys, {"_far": (kind, "_own")}, seconds).drop("_own")
    out = attach(rows, carry, keys).withColumns({
        name: F.when(F.col("_alone"), F.col(f"_far.{c}")).otherwise(F.col(name))
        for c, name in cols.items()})
    return _done(out.drop("_alone", "_edge", "_far"), df)
