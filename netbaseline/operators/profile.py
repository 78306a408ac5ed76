"""Profile slots, write gate and horizon, and the keyed merge into the result table.

A result row holds, per model, asset, protocol (and direction), a profile:
an array of ``{name: slot, value: "low-high"}`` where the slot is the hour,
weekday or month of the window end.  Merging keeps slot order: existing
slots stay in place with their value replaced, new slots are appended in
order of their first window end.  Row attributes (id, address, direction,
internal flag, time) keep the values of the first write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netbaseline.functions.bounds import interval_text, kib_bounds
from netbaseline.functions.convert import to_int
from netbaseline.functions.ids import result_id
from netbaseline.functions.network import internal_flag
from netbaseline.functions.text import blank_to_empty
from netbaseline.functions.time import MODEL_ZONE, local_ntz, slot_key
from netbaseline.operators.params import active_models
from netbaseline.operators.sizing import broadcast_if, is_small
from netbaseline.schema import RESULT_SCHEMA
from netbaseline.session import written

RESULT_COLUMNS = [f.name for f in RESULT_SCHEMA.fields]
KEY_WITH_DIRECTION = ["modeling_params_id", "src_id", "protocol", "up_down"]
KEY_REFERENCE = ["modeling_params_id", "src_id", "protocol"]


def key_columns(parity: bool = False) -> list[str]:
    """The result key; by default the direction is part of it (in and out kept apart)."""
    return KEY_REFERENCE if parity else KEY_WITH_DIRECTION


def slot_rows(bounds: DataFrame, model_id, span, zone: str = MODEL_ZONE, parity: bool = False,
              keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per level-2 result: its profile slot, bounds in KiB and row attributes; columns ``keep`` follow.

    ``model_id`` and ``span`` are a value or a Column (e.g. after a join with
    the parameter rows).
    """
    if model_id is None:
        mid = F.col("modeling_params_id")
    else:
        mid = model_id if isinstance(model_id, F.Column) else F.lit(model_id)
    sp = span if isinstance(span, F.Column) else F.lit(int(span))
    lo, hi = kib_bounds(F.col("min_flow"), F.col("max_flow"))
    end = F.col("w2.end")
    return bounds.select(
        mid.cast("string").alias("modeling_params_id"),
        "src_id", "src_ip", "area_id", blank_to_empty("protocol").alias("protocol"),
        F.col("direction").cast("int").alias("up_down"),
        end.alias("window_end"),
        slot_key(end, sp, zone).alias("name"),
        lo.alias("lo"), hi.alias("hi"),
        interval_text(lo, hi).alias("value"),
        internal_flag(F.col("src_ip"), parity).alias("in_out"),
        local_ntz(end, zone).alias("time"), *keep,
    )


def gate(slots: DataFrame, params: DataFrame, model_id: str | None = None) -> DataFrame:
    """Keep slot rows whose model is switched on in the given (fresh) parameters.

    With ``model_id`` (all rows belong to that model) the test is one
    uncorrelated ``EXISTS`` evaluated once; otherwise a semi join on the
    model id against the switched-on ids (size-checked, broadcast).
    """
    if model_id is not None:
        return slots.where(active_models(params).where(F.col("id") == model_id).exists())
    on = broadcast_if(active_models(params).select(F.col("id").alias("__mid")).distinct(), is_small(params))
    return slots.join(on, slots["modeling_params_id"] == F.col("__mid"), "left_semi")


def horizon(slots: DataFrame, current: DataFrame | None, params: DataFrame,
            model_id: str | None = None) -> DataFrame:
    """Keep slot rows no later than ``first write + 2 * history days`` of their model.

    The first write is the earliest ``time`` of the model in the result table
    or in this batch; history days come from ``model_history_data_span``
    (1 when unset).  Rows of models without parameters pass (the gate is
    separate).  The limits are one row per switched-on model; they are
    broadcast if the parameter table is small, else joined.  With ``model_id``
    (all rows of one model) the limit is a scalar subquery evaluated once.
    ``slots`` is read twice on a first run (``current`` is None): pass it
    written or cached then, as :func:`written_slots` does.
    """
    days = (active_models(params)
            .groupBy(F.col("id").alias("modeling_params_id"))
            .agg(F.max(F.coalesce(to_int("model_history_data_span"), F.lit(1))).alias("history_days")))
    times = slots.select("modeling_params_id", "time")
    if current is not None:
        times = times.unionByName(current.select("modeling_params_id", "time"))
    if model_id is not None:
        first = times.where(F.col("modeling_params_id") == model_id).agg(F.min("time")).scalar()
        n_days = days.where(F.col("modeling_params_id") == model_id).agg(F.max("history_days")).scalar()
        until = F.timestamp_add("DAY", F.lit(2) * n_days, first)
        return slots.where(until.isNull() | (F.col("time") <= until))
    # At most one row per row of ``days`` (inner join on its key): its bound is that of the parameters.
    small = is_small(params)
    limits = (times.groupBy("modeling_params_id").agg(F.min("time").alias("first_write"))
              .join(broadcast_if(days, small), "modeling_params_id")
              .select("modeling_params_id",
                      F.expr("timestampadd(DAY, 2 * history_days, first_write)").alias("__until")))
    return (slots.join(broadcast_if(limits, small), "modeling_params_id", "left")
            .where(F.col("__until").isNull() | (F.col("time") <= F.col("__until")))
            .drop("__until"))


def written_slots(slots: DataFrame) -> DataFrame:
    """``slots`` written to the shared scratch folder: the raw flows are read once however often slots are."""
    return written(slots, "slots")


def empty_results(spark) -> DataFrame:
    """An empty result table (a zero-row JVM relation, no Python-side data)."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in RESULT_SCHEMA.fields])


def upsert_results(current: DataFrame | None, slots: DataFrame, parity: bool = False) -> DataFrame:
    """The result table after merging ``slots`` into ``current`` (keyed upsert).

    New rows are first reduced to one per key and slot (bounds of the latest
    window; ties by address, area, direction), with a map-side partial, so an
    asset with any number of addresses sends one row per slot and task.  Only
    then are they grouped by key together with the stored slots: a group holds
    at most 24 + 24 entries (hours), 7 + 7 (weekdays) or 12 + 12 (months).
    Stored slots keep their place, new ones are appended by first window end.
    Keys not touched by ``slots`` pass unchanged.  A blank protocol is one key.
    """
    key = key_columns(parity)
    spark = slots.sparkSession
    if current is None:
        current = empty_results(spark)
    us = F.unix_micros(F.col("window_end"))
    direction = (F.col("up_down") if parity else F.lit(None)).cast("int").alias("d")
    latest = F.struct(us.alias("u"), F.col("src_ip").alias("ip"), F.col("area_id").alias("a"), direction,
                      F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"))
    earliest = F.struct(us.alias("u"), F.col("src_ip").alias("ip"), direction, F.col("time").alias("t"),
                        F.col("in_out").cast("int").alias("io"))
    new = (slots.withColumn("protocol", blank_to_empty("protocol")).groupBy(*key, "name")
           .agg(F.max(latest).alias("last"), F.min(us).alias("first_us"), F.min(earliest).alias("first_new")))
    entry_fields = ["is_new", "pos", "first_us", "name", "value"]
    new_entries = new.select(
        *key, F.lit(True).alias("is_new"), F.lit(None).cast("int").alias("pos"), "first_us", "name",
        interval_text(F.col("last.lo"), F.col("last.hi")).alias("value"), "first_new",
        F.lit(None).cast(_OLD_ROW).alias("old_row"),
    )
    old = current.withColumn("protocol", blank_to_empty("protocol")).select(
        *key, "id", "src_ip", "up_down", "in_out", "time", F.posexplode_outer("flow").alias("pos", "slot"))
    old_entries = old.select(
        *key, F.lit(False).alias("is_new"), F.col("pos").cast("int").alias("pos"),
        F.lit(None).cast("long").alias("first_us"), F.col("slot.name").alias("name"), F.col("slot.value").alias("value"),
        F.lit(None).cast(new.schema["first_new"].dataType).alias("first_new"),
        F.struct("id", "src_ip", "in_out", "time", F.col("up_down").alias("dir")).cast(_OLD_ROW).alias("old_row"),
    )
    grouped = new_entries.unionByName(old_entries).groupBy(*key).agg(
        F.collect_list(F.struct(*entry_fields)).alias("es"), F.min("first_new").alias("first_new"),
        F.max("old_row").alias("old_row"),
    )
    # Staged selects: each intermediate array is computed once per key.
    es = F.col("es")
    staged = grouped.select(
        *key, "old_row", "first_new",
        F.transform(F.filter(es, lambda e: e["is_new"]),
                    lambda e: F.struct(e["first_us"].alias("k"), e["name"].alias("name"), e["value"].alias("value")))
        .alias("new_slots"),
        F.filter(es, lambda e: ~e["is_new"] & e["name"].isNotNull()).alias("old_es"))
    staged = staged.select(
        *key, "old_row", "old_es", "first_new", "new_slots",
        F.map_from_entries(F.transform("new_slots", lambda x: F.struct(x["name"], x["value"]))).alias("new_map"),
        F.transform("old_es", lambda e: e["name"]).alias("old_names"))
    kept = F.transform(
        F.array_sort(F.transform("old_es", lambda e: F.struct(e["pos"].alias("k"), e["name"].alias("name"),
                                                              e["value"].alias("value")))),
        lambda x: F.struct(x["name"].alias("name"),
                           F.coalesce(F.try_element_at(F.col("new_map"), x["name"]), x["value"]).alias("value")))
    added = F.transform(
        F.array_sort(F.filter("new_slots", lambda x: ~F.array_contains(F.col("old_names"), x["name"]))),
        lambda x: F.struct(x["name"].alias("name"), x["value"].alias("value")))
    old_row = F.col("old_row")
    first_new = F.col("first_new")
    out = staged.select(
        F.coalesce(old_row["id"], result_id(*[F.col(k) for k in key])).alias("id"),
        F.col("modeling_params_id"), F.col("src_id"),
        F.when(old_row.isNotNull(), old_row["src_ip"]).otherwise(first_new["ip"]).alias("src_ip"),
        F.col("protocol"),
        F.concat(kept, added).cast(RESULT_SCHEMA["flow"].dataType).alias("flow"),
        (F.coalesce(old_row["dir"], first_new["d"]) if parity else F.col("up_down")).cast("int").alias("up_down"),
        F.when(old_row.isNotNull(), old_row["in_out"]).otherwise(first_new["io"]).cast("int").alias("in_out"),
        F.when(old_row.isNotNull(), old_row["time"]).otherwise(first_new["t"]).alias("time"),
    )
    return out.select(*RESULT_COLUMNS)


_OLD_ROW = "struct<id:string,src_ip:string,in_out:int,time:timestamp_ntz,dir:int>"


def explode_profiles(results: DataFrame) -> DataFrame:
    """One row per profile slot: key columns, ``pos``, ``name``, ``value`` and numeric ``lo`` / ``hi``."""
    num = r"(-?[0-9.]+(?:E-?[0-9]+)?)"
    x = results.select("id", "modeling_params_id", "src_id", "src_ip", "protocol", "up_down", "in_out", "time",
                       F.posexplode("flow").alias("pos", "slot"))
    return x.select(
        "id", "modeling_params_id", "src_id", "src_ip", "protocol", "up_down", "in_out", "time", "pos",
        F.col("slot.name").alias("name"), F.col("slot.value").alias("value"),
        F.regexp_extract("slot.value", f"^{num}-{num}$", 1).cast("double").alias("lo"),
        F.regexp_extract("slot.value", f"^{num}-{num}$", 2).cast("double").alias("hi"),
    )
