"""Parameters as of a time: every window is judged by the version of its model in force at its end.

The table of parameter versions makes intervals per model; a window joins the
one that holds its end.  Several models run at once, each with its own
assets.  Results depend on the windows and versions alone, not on when or how
often a batch runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from netbaseline.functions.convert import to_int
from netbaseline.functions.text import blank_to_empty
from netbaseline.functions.time import MODEL_ZONE, local_ntz, z_for_confidence
from netbaseline.operators.aggregate import MODEL_KEY, interval_bounds
from netbaseline.operators.params import ACTIVE_PREDICATE, diff_params
from netbaseline.operators.profile import slot_rows
from netbaseline.operators.sizing import is_small

FOREVER = "TIMESTAMP_NTZ'9999-12-31 00:00:00'"


def _z(confidence: Column, versions: DataFrame) -> Column:
    """z of each version; the driver reads the distinct levels of the control table."""
    out = F.lit(z_for_confidence(None))
    for row in versions.select(F.col("model_confidence_interval").cast("double").alias("c")).distinct().collect():
        if row["c"] is not None:
            out = F.when(confidence == row["c"], F.lit(z_for_confidence(row["c"]))).otherwise(out)
    return out


def version_intervals(versions: DataFrame, parity: bool = False) -> DataFrame:
    """``(v_id, v_from, v_to, v_on, span, z, history_days, epoch, dimension, clear_at)`` per parameter version.

    A version holds from its ``modify_time`` (wall clock of the model zone) until the next one of
    its model.  ``epoch`` counts the changes of dimension so far (:func:`diff_params`);
    ``clear_at`` is the version's time if it clears the history.  z is 1.96 with ``parity``.
    """
    changes = diff_params(versions, parity).select(
        F.col("id").alias("c_id"), F.col("modify_time").alias("c_time"), "dimension_changed", "clear_history", "history_days")
    ordered = Window.partitionBy("id").orderBy("modify_time")
    z = F.lit(1.96) if parity else _z(F.col("model_confidence_interval").cast("double"), versions)
    span = to_int("model_result_span")
    return (versions.join(changes, (F.col("id") == F.col("c_id")) & (F.col("modify_time") == F.col("c_time")))
            .withColumn("epoch", F.sum(F.col("dimension_changed").cast("int")).over(ordered).cast("int"))
            .select(F.col("id").alias("v_id"), F.col("modify_time").alias("v_from"),
                    F.coalesce(F.lead("modify_time").over(ordered), F.expr(FOREVER)).alias("v_to"),
                    F.coalesce(ACTIVE_PREDICATE(), F.lit(False)).alias("v_on"), span.alias("span"), z.alias("z"), "history_days", "epoch",
                    F.concat_ws("|", F.col("epoch").cast("string"), span.cast("string"), blank_to_empty("model_rate_timeunit"),
                                F.coalesce(to_int("model_rate_timeunit_num").cast("string"), F.lit(""))).alias("dimension"),
                    F.when(F.col("clear_history"), F.col("modify_time")).alias("clear_at")))


def in_force(rows: DataFrame, intervals: DataFrame, at: str) -> DataFrame:
    """``rows`` (with a model id) joined with the version of their model in force at the time ``at``; others drop out.

    Broadcast below a checked size; beyond it both sides are also matched by day, so
    that a model's rows are dealt over its days.
    """
    inside = (F.col(MODEL_KEY) == F.col("v_id")) & (F.col("v_from") <= F.col(at)) & (F.col(at) < F.col("v_to"))
    if is_small(intervals):
        return rows.join(F.broadcast(intervals), inside)
    edges = rows.agg(F.to_date(F.min(at)).alias("lo"), F.to_date(F.max(at)).alias("hi")).first()
    if edges["lo"] is None:
        return rows.join(intervals, inside)
    lo, hi = F.lit(edges["lo"]), F.lit(edges["hi"])
    first, last = F.greatest(F.to_date("v_from"), lo), F.least(F.to_date("v_to"), hi)
    days = intervals.where(first <= last).withColumn("v_day", F.explode(F.sequence(first, last)))
    return rows.join(days, inside & (F.to_date(at) == F.col("v_day"))).drop("v_day")


def asof_slots(stats: DataFrame, intervals: DataFrame, parity: bool = False, zone: str = MODEL_ZONE) -> DataFrame:
    """Slot rows of finished windows (:func:`window_stats` with a model id) whose model was on at their end.

    With ``epoch``, ``dimension`` and ``history_days`` of the version in force.
    """
    ended = in_force(stats.withColumn("w_time", local_ntz(F.col("w2.end"), zone)), intervals.where("v_on"), "w_time")
    bounds = interval_bounds(ended, z=F.col("z"), integer_mean=parity, zone=zone)
    return slot_rows(bounds, None, F.col("span"), zone, parity, keep=("epoch", "dimension", "history_days"))


def after_clears(slots: DataFrame, intervals: DataFrame) -> DataFrame:
    """Slot rows without those that a history clear of their model and epoch came after."""
    clears = (intervals.where("clear_at is not null").groupBy(F.col("v_id").alias("x_id"), F.col("epoch").alias("x_epoch"))
              .agg(F.max("clear_at").alias("x_at")))
    clears = F.broadcast(clears) if is_small(intervals) else clears
    gone = (F.col(MODEL_KEY) == F.col("x_id")) & (F.col("epoch") == F.col("x_epoch")) & (F.col("time") < F.col("x_at"))
    return slots.join(clears, gone, "left_anti")


def within_horizon(slots: DataFrame, firsts: DataFrame | None = None) -> DataFrame:
    """Slot rows up to their epoch's first write + 2 * the history days in force at their window's end.

    ``firsts(modeling_params_id, epoch, time)``: first writes of epochs that already have rows.
    """
    times = slots.select(MODEL_KEY, "epoch", "time")
    if firsts is not None:
        times = times.unionByName(firsts.select(MODEL_KEY, "epoch", "time"))
    first = (times.groupBy(F.col(MODEL_KEY).alias("f_id"), F.col("epoch").alias("f_epoch")).agg(F.min("time").alias("f_time")))
    # One row per model and epoch, as many as the control table has versions at most.
    return (slots.join(F.broadcast(first) if is_small(first) else first,
                       (F.col(MODEL_KEY) == F.col("f_id")) & (F.col("epoch") == F.col("f_epoch")))
            .where(F.expr("time <= timestampadd(DAY, 2 * history_days, f_time)")).drop("f_id", "f_epoch", "f_time"))
