"""The baseline job as one lazily built plan.

``flows -> known assets -> level 1 -> directions -> level 2 -> bounds ->
slots -> gate -> horizon -> upsert``.  The same functions take a batch or a
streaming ``flows`` DataFrame; the streaming driver (``netbaseline.streaming``)
runs the part up to the bounds as a query and the rest per micro-batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from netbaseline.functions.convert import to_int
from netbaseline.functions.text import blank_to_empty
from netbaseline.functions.time import MODEL_ZONE, window_lengths, z_for_confidence
from netbaseline.operators.aggregate import interval_bounds, level1, level2, split_directions
from netbaseline.operators.membership import keep_known_assets
from netbaseline.operators.params import ACTIVE_PREDICATE, active_models, resolve_assets
from netbaseline.operators.profile import gate, horizon, slot_rows, upsert_results, written_slots
from netbaseline.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, is_small, remember_size


@dataclass(frozen=True)
class ModelConfig:
    model_id: str
    result_span: int
    z: float
    history_days: int
    rate_unit: str = ""
    rate_number: int | None = None


def model_config(params: DataFrame, parity: bool = False) -> ModelConfig | None:
    """Settings of the model in force (one control row, read to the driver), or None.

    ``parity=True`` keeps z at 1.96 whatever the configured confidence, as
    the reference does.
    """
    # One job: the row count (to size-check the control table once) and the model in force.
    fields = F.struct(F.col("id"), to_int("model_result_span").alias("span"),
                      F.col("model_confidence_interval").cast("double").alias("conf"),
                      to_int("model_history_data_span").alias("hist"), blank_to_empty("model_rate_timeunit").alias("unit"),
                      to_int("model_rate_timeunit_num").alias("num"))
    order = F.when(ACTIVE_PREDICATE(), F.struct(F.col("modify_time"), F.col("id")))
    got = params.agg(F.count(F.lit(1)).alias("n"), F.max_by(fields, order).alias("p")).first()
    remember_size(params, got["n"])
    row = got["p"]
    if row is None:
        return None
    z = 1.96 if parity else z_for_confidence(row["conf"])
    if row["span"] is None:
        raise ValueError(f"model {row['id']}: model_result_span is not set")
    return ModelConfig(row["id"], row["span"], z,
                       row["hist"] if row["hist"] is not None else 1, row["unit"], row["num"])


def model_assets(params: DataFrame, members: DataFrame, config: ModelConfig, parity: bool = False) -> DataFrame:
    """The asset ids of the model in force (pairs may repeat; fine for the semi join).

    ``parity=True`` takes the union over all models that are switched on, as
    the reference does.
    """
    if parity:
        return resolve_assets(active_models(params), members, parity=True, distinct=False)
    return resolve_assets(params, members, parity=parity, model_ids=[config.model_id], distinct=False)


def baseline_bounds(flows: DataFrame, assets: DataFrame | None, interval: str | None, z: float = 1.96,
                    parity: bool = False, zone: str = MODEL_ZONE,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Level-2 interval bounds per series, direction and window for the modelled assets.

    The asset filter is a broadcast semi join on the raw flows when the asset
    set is within ``max_broadcast_rows``; otherwise, in a batch, a join placed
    after level 1, whose partial aggregation has already reduced the rows (and
    any hot asset) to one per series and window.  A stream is always filtered
    before its watermark is set (salted beyond the bound): the watermark
    follows the modelled assets' flows alone, whatever the size of the set.
    """
    d1, d2 = window_lengths(interval)
    if assets is None:
        l1 = level1(flows, d1)
    else:
        # a semi join ignores repeated keys on its right side: no distinct (and no shuffle) needed
        ids = assets.select(F.col("entity_id").alias("__asset"))
        if flows.isStreaming or is_small(assets, max_broadcast_rows):  # remembered per assets DataFrame
            l1 = level1(keep_known_assets(flows, assets, max_broadcast_rows=max_broadcast_rows)[0], d1)
        else:
            # An inner join with the distinct ids, not a semi join: Catalyst pushes a
            # semi join on grouping keys back below the aggregate, onto the raw rows.
            l1 = (level1(flows, d1)
                  .join(ids.distinct(), F.col("src_id") == F.col("__asset"), "inner")
                  .drop("__asset"))
    rows = split_directions(l1, parity)
    return interval_bounds(level2(rows, d2), z=z, integer_mean=parity, zone=zone)


def baseline_slots(flows: DataFrame, params: DataFrame, members: DataFrame, interval: str | None,
                   parity: bool = False, zone: str = MODEL_ZONE,
                   config: ModelConfig | None = None,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   assets: DataFrame | None = None) -> DataFrame | None:
    """Slot rows of the model in force (before gate and horizon); None if no model is on.

    ``assets`` (from :func:`model_assets`) may be passed to share one resolved
    and size-checked asset set between several runs.
    """
    config = config or model_config(params, parity)
    if config is None:
        return None
    if assets is None:
        assets = model_assets(params, members, config, parity)
    bounds = baseline_bounds(flows, assets, interval, config.z, parity, zone, max_broadcast_rows)
    return slot_rows(bounds, config.model_id, config.result_span, zone, parity)


def batch_baseline(flows: DataFrame, params: DataFrame, members: DataFrame, interval: str | None,
                   current: DataFrame | None = None, parity: bool = False, zone: str = MODEL_ZONE,
                   apply_gate: bool = True, apply_horizon: bool = True,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame | None:
    """The result table after one batch run over ``flows`` (None if no model is on)."""
    config = model_config(params, parity)
    if config is None:
        return current
    slots = baseline_slots(flows, params, members, interval, parity, zone, config=config,
                           max_broadcast_rows=max_broadcast_rows)
    if apply_gate:
        slots = gate(slots, params, model_id=config.model_id)
    if apply_horizon:
        if current is None:
            slots = written_slots(slots)
        slots = horizon(slots, current, params, model_id=config.model_id)
    return upsert_results(current, slots, parity)
