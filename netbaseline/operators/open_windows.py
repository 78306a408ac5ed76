"""Window statistics over batches that may be cut anywhere.

What a batch leaves unfinished is kept as two small tables of mergeable
numbers: the sums of the level-1 windows still open, and the moments (count,
sum, exact sum of squares) of the level-2 windows still open.  The next batch
adds to both before anything is derived, so a window that two batches share
has the value it has in one run.  All of it is whole numbers: the result does
not depend on cuts, order or partitioning, to the last bit.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from netbaseline.operators.aggregate import _bucket_start, _keys, _window_struct, split_directions

SUMS = ("in_sum", "out_sum", "total_count")
SQUARES = "decimal(38,0)"
MOMENTS = ("n_windows", "sum_flow", "sum_count", "sum_squares")


@dataclass(frozen=True)
class OpenWindows:
    """What earlier batches left: open windows of both levels, and the time up to which windows are closed."""
    level1: DataFrame   # series, w1 (start, microseconds), SUMS
    level2: DataFrame   # series, direction, w2 (start, microseconds), MOMENTS
    until: int          # microseconds


@dataclass(frozen=True)
class Advance:
    """One batch's outcome: moments of the windows it closed, what stays open, and the late sums it left out."""
    closed: DataFrame
    held: OpenWindows
    late: DataFrame


def window_sums(flows: DataFrame, level1_seconds: int, last: bool = False) -> DataFrame:
    """Per series and level-1 window (start in microseconds): bytes in and out and records; with ``last_us`` if asked for."""
    start = _bucket_start(F.unix_micros("ts"), level1_seconds * 1_000_000)
    latest = [F.max(F.unix_micros("ts")).alias("last_us")] if last else []
    return (flows.where(F.col("ts").isNotNull()).groupBy(*_keys(flows), start.alias("w1"))
            .agg(F.sum("in_flow").alias("in_sum"), F.sum("out_flow").alias("out_sum"), F.count(F.lit(1)).alias("total_count"), *latest))


def _added(parts: DataFrame, keys: list[str], columns: tuple[str, ...]) -> DataFrame:
    types = dict(parts.dtypes)
    return parts.groupBy(*keys).agg(*(F.sum(c).cast(types[c]).alias(c) for c in columns))


def window_moments(sums: DataFrame, level1_seconds: int, level2_seconds: int, parity: bool = False,
                   held: DataFrame | None = None) -> DataFrame:
    """Moments per series, direction and level-2 window (start in microseconds) of finished level-1 sums, added to those ``held``."""
    length = level1_seconds * 1_000_000
    rows = split_directions(sums.withColumn("w1", _window_struct(F.col("w1"), length)), parity)
    start = _bucket_start(F.unix_micros("w1.end") - F.lit(1), level2_seconds * 1_000_000)
    wide = F.col("flow_size").cast("decimal(19,0)")
    # Every sum is the moments of one window: those of the batch and those held meet in one shuffle.
    ones = rows.select(*_keys(rows), "direction", start.alias("w2"), F.lit(1).cast("long").alias("n_windows"),
                       F.col("flow_size").alias("sum_flow"), F.col("total_count").alias("sum_count"),
                       (wide * wide).cast(SQUARES).alias("sum_squares"))
    ones = ones if held is None else ones.unionByName(held)
    return _added(ones, [c for c in ones.columns if c not in MOMENTS], MOMENTS)


def window_stats(moments: DataFrame, level2_seconds: int) -> DataFrame:
    """The columns of :func:`level2`: the spread is sqrt(n * sum of squares - sum^2) / n, rounded once at the end."""
    n = F.col("n_windows").cast("decimal(10,0)")
    total = F.col("sum_flow").cast("decimal(19,0)")
    spread = (n * F.col("sum_squares")).cast(SQUARES) - (total * total).cast(SQUARES)
    keys = _keys(moments) + ["direction"]
    return moments.select(*keys, _window_struct(F.col("w2"), level2_seconds * 1_000_000).alias("w2"), "sum_flow", "sum_count",
                          (F.sqrt(spread.cast("double")) / F.col("n_windows")).alias("sd_flow"), "n_windows")


def advance(sums: DataFrame, held: OpenWindows | None, until: int, level1_seconds: int, level2_seconds: int,
            parity: bool, keep, is_kept: bool = False) -> Advance:
    """Add a batch's ``window_sums`` to what is held and close all windows that end by ``until`` (microseconds).

    Sums of level-1 windows that an earlier batch has closed are late: they
    are left out and handed back.  ``keep(df, name)`` writes a table and
    returns it read again: it cuts the lineage, and every step is computed once.
    ``is_kept``: the sums are such a table already.
    """
    d1, d2 = level1_seconds * 1_000_000, level2_seconds * 1_000_000
    if held is not None:
        until = max(until, held.until)
        sums = sums if is_kept else keep(sums, "batch-sums")
        late = sums.where(F.col("w1") + d1 <= held.until)
        sums = sums.where(F.col("w1") + d1 > held.until)
        last = held.level1.agg(F.max("w1")).first()[0]
        if last is not None:
            # Only windows up to the last one held can have a part there; sums of later ones are whole as they are.
            shared = sums.where(F.col("w1") <= last).unionByName(held.level1)
            shared = keep(_added(shared, [c for c in shared.columns if c not in SUMS], SUMS), "level1-sums")
            sums = sums.where(F.col("w1") > last).unionByName(shared)
    else:
        late = sums.where("false")
        sums = sums if is_kept else keep(sums, "level1-sums")
    moments = window_moments(sums.where(F.col("w1") + d1 <= until), level1_seconds, level2_seconds, parity,
                             held.level2 if held is not None else None)
    moments = keep(moments, "level2-moments")
    return Advance(moments.where(F.col("w2") + d2 <= until),
                   OpenWindows(sums.where(F.col("w1") + d1 > until), moments.where(F.col("w2") + d2 > until), until), late)
