"""Keep the flows of modelled assets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from netbaseline.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, is_small

SALTS = 16


def keep_known_assets(flows: DataFrame, assets: DataFrame, key: str = "src_id",
                      asset_col: str = "entity_id",
                      max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Left-semi join of flows with the asset set; returns ``(kept, broadcast_used)``.

    A bounded asset set is broadcast, so the filter runs map-side with no
    shuffle of the flows.  A larger set gives a shuffled semi join on the id
    and a salt, so that a hot asset's flows are dealt over ``SALTS`` tasks.
    Batch callers with a grouping on ``key`` (the aggregates) apply it after
    their partial aggregation instead (see ``plans.baseline``), where the rows
    are already few and a hot asset is one row per window.
    """
    ids = assets.select(F.col(asset_col).alias("__asset"))  # repeats do not matter to a semi join
    if is_small(assets, max_broadcast_rows):
        return flows.join(F.broadcast(ids), flows[key] == F.col("__asset"), "left_semi"), True
    salted = ids.select("__asset", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    salt = F.pmod(F.xxhash64("ts", "src_port", "in_flow", "out_flow"), F.lit(SALTS)).cast("int")
    kept = (flows.withColumn("__flow_salt", salt)
            .join(salted, (F.col(key) == F.col("__asset")) & (F.col("__flow_salt") == F.col("__salt")), "left_semi"))
    return kept.drop("__flow_salt"), False


def tag_known_assets(flows: DataFrame, assets: DataFrame, max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Flows of modelled assets with ``modeling_params_id``, once per model that has the asset when the flow happens.

    ``assets(model_id, entity_id)`` may carry ``valid_from`` and ``valid_to``
    (instants; null: unbounded): a membership then counts from its start up to,
    not including, its end, by event time.  Overlapping memberships of one
    asset in one model count once.  Broadcast below a bound, else joined by
    id and salt.
    """
    timed = "valid_from" in assets.columns
    a = assets.select(F.col("model_id").alias("modeling_params_id"), F.col("entity_id").alias("__asset"),
                      *((F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to")) if timed else ()))
    a = a.where(F.col("__asset").isNotNull())
    if timed:
        spans = F.array_sort(F.collect_set(F.struct(F.coalesce(F.unix_micros("__from"), F.lit(-(1 << 62))).alias("lo"),
                                                    F.coalesce(F.unix_micros("__to"), F.lit(1 << 62)).alias("hi"))))
        a = a.groupBy("modeling_params_id", "__asset").agg(spans.alias("__spans"))
        inside = F.exists("__spans", lambda s: (s["lo"] <= F.unix_micros("ts")) & (F.unix_micros("ts") < s["hi"]))
    else:
        a, inside = a.distinct(), F.lit(True)
    if is_small(assets, max_broadcast_rows):
        met = flows.join(F.broadcast(a), (F.col("src_id") == F.col("__asset")) & inside)
    else:
        salted = a.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("ts", "src_port", "in_flow", "out_flow"), F.lit(SALTS)).cast("int")
        met = flows.withColumn("__flow_salt", salt).join(
            salted, (F.col("src_id") == F.col("__asset")) & (F.col("__flow_salt") == F.col("__salt")) & inside)
    return met.select("modeling_params_id", *flows.columns)
