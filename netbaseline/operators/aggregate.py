"""Two-level tumbling-window statistics of bytes per traffic series.

Level 1 sums bytes and counts records per series and short window; level 2
aggregates the level-1 sums per series and long window into a mean and a
population standard deviation; the bounds are ``mean +- z * sd / sqrt(n)``.
Both levels are plain ``groupBy(window)`` aggregates, so they run with
partial (map-side) aggregation in batch and as append-mode stateful
operators in a stream; a hot series is split by its windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netbaseline.functions.time import WATERMARK_DELAY, duration, zone_date, MODEL_ZONE
from netbaseline.schema import SERIES_KEYS

DIRECTION_IN = 0   # bytes received by the asset (down)
DIRECTION_OUT = 1  # bytes sent by the asset (up)


MODEL_KEY = "modeling_params_id"


def _keys(df: DataFrame) -> list[str]:
    """Series keys, led by the model id when rows carry one (several models at once)."""
    return ([MODEL_KEY] if MODEL_KEY in df.columns else []) + SERIES_KEYS


def _window_struct(start_us, length_us: int) -> F.Column:
    """A tumbling window ``struct<start, end>`` from its start in epoch microseconds."""
    return F.struct(F.timestamp_micros(start_us).alias("start"),
                    F.timestamp_micros(start_us + F.lit(length_us)).alias("end"))


def _bucket_start(us: F.Column, length_us: int) -> F.Column:
    """Start (epoch microseconds) of the epoch-aligned window of length ``length_us`` holding ``us``."""
    return us - F.pmod(us, F.lit(length_us))


def level1(flows: DataFrame, level1_seconds: int, watermark: str = WATERMARK_DELAY) -> DataFrame:
    """Per series and level-1 window: bytes in, bytes out and record count.

    Both directions come from one pass.  On a streaming input the event-time
    watermark (late rows beyond ``watermark`` are dropped) is set here and
    the window is Spark's ``window()``, which the watermark needs to evict
    state.  On a batch input the rows are grouped on an integer window start
    instead (the same epoch-aligned windows, cheaper to hash than the window
    struct), and the struct is built after the aggregate.
    """
    sums = [F.sum("in_flow").alias("in_sum"), F.sum("out_flow").alias("out_sum"),
            F.count(F.lit(1)).alias("total_count")]
    if flows.isStreaming:
        flows = flows.withWatermark("ts", watermark)
        return flows.groupBy(*_keys(flows), F.window("ts", duration(level1_seconds)).alias("w1")).agg(*sums)
    length = level1_seconds * 1_000_000
    start = _bucket_start(F.unix_micros("ts"), length)
    return (flows.where(F.col("ts").isNotNull())
            .groupBy(*_keys(flows), start.alias("__w1")).agg(*sums)
            .select(*_keys(flows), _window_struct(F.col("__w1"), length).alias("w1"),
                    "in_sum", "out_sum", "total_count"))


def split_directions(l1: DataFrame, parity: bool = False) -> DataFrame:
    """One row per direction: ``direction`` 0 with bytes in, 1 with bytes out.

    ``parity=True`` repeats the bytes-in figures for direction 1, as the
    reference's second interval reads the first one's input.
    """
    out_col = "in_sum" if parity else "out_sum"
    return l1.select(
        *_keys(l1), "w1",
        F.expr(f"stack(2, {DIRECTION_IN}, in_sum, total_count, {DIRECTION_OUT}, {out_col}, total_count)")
        .alias("direction", "flow_size", "total_count"),
    )


def level2(rows: DataFrame, level2_seconds: int) -> DataFrame:
    """Per series, direction and level-2 window: sums and spread of the level-1 sums.

    A level-1 window falls into the level-2 window of its last instant
    (``window_time``, end - 1 microsecond); level-2 lengths are whole
    multiples of level-1 ones, so every level-1 window lies inside one
    level-2 window.  Batch input is grouped on the integer window start, as
    in :func:`level1`.
    """
    stats = [F.sum("flow_size").alias("sum_flow"), F.sum("total_count").alias("sum_count"),
             F.stddev_pop("flow_size").alias("sd_flow"), F.count(F.lit(1)).alias("n_windows")]
    keys = _keys(rows) + ["direction"]
    if rows.isStreaming:
        return rows.groupBy(*keys, F.window(F.window_time("w1"), duration(level2_seconds)).alias("w2")).agg(*stats)
    length = level2_seconds * 1_000_000
    start = _bucket_start(F.unix_micros(F.col("w1.end")) - F.lit(1), length)
    return (rows.groupBy(*keys, start.alias("__w2")).agg(*stats)
            .select(*keys, _window_struct(F.col("__w2"), length).alias("w2"),
                    "sum_flow", "sum_count", "sd_flow", "n_windows"))


def interval_bounds(l2: DataFrame, z: float | F.Column = 1.96, integer_mean: bool = False,
                    zone: str = MODEL_ZONE) -> DataFrame:
    """Adds ``mean_flow``, ``min_flow``, ``max_flow`` (bytes) and ``c_date`` (date of the window end in ``zone``).

    ``integer_mean=True`` divides the two whole sums as integers, as the
    reference's SQL does.
    """
    if integer_mean:
        mean = F.expr("sum_flow div sum_count").cast("double")
    else:
        mean = F.col("sum_flow") / F.col("sum_count")
    z = z if isinstance(z, F.Column) else F.lit(float(z))
    half = z * F.col("sd_flow") / F.sqrt(F.col("sum_count"))
    return (l2
            .withColumn("mean_flow", mean)
            .withColumn("max_flow", F.col("mean_flow") + half)
            .withColumn("min_flow", F.col("mean_flow") - half)
            .withColumn("c_date", zone_date(F.col("w2.end"), "yyyy-MM-dd", zone)))
