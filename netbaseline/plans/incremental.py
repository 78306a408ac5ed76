"""The batch job over increments that may be cut anywhere, also inside windows.

Every run adds its flows to the windows that earlier runs left open, closes
those that end by the time it has reached, and merges the slots of these into
the result table.  Open windows and table are one version of the store: a run
that dies leaves the version before, and a run repeated under its number does nothing.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from netbaseline.functions.time import MODEL_ZONE, window_lengths
from netbaseline.operators.aggregate import interval_bounds
from netbaseline.operators.membership import keep_known_assets
from netbaseline.operators.open_windows import Advance, OpenWindows, advance, window_stats, window_sums
from netbaseline.operators.profile import slot_rows
from netbaseline.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, is_small
from netbaseline.plans.baseline import model_assets, model_config
from netbaseline.session import written
from netbaseline.streaming.baseline import merge_slots, newest_clears
from netbaseline.streaming.log_store import Manifest, ResultStore

ALL = (1 << 62)   # later than any window


@dataclass(frozen=True)
class Run:
    """What one run did: the store's version and the late sums (window sums of windows closed before it)."""
    version: Manifest
    late: DataFrame | None


def known_sums(flows: DataFrame, assets: DataFrame, level1_seconds: int,
               max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Level-1 sums of the modelled assets: filtered map-side, or after the sums if the asset set is large."""
    if is_small(assets, max_broadcast_rows):
        return window_sums(keep_known_assets(flows, assets, max_broadcast_rows=max_broadcast_rows)[0], level1_seconds)
    ids = assets.select(F.col("entity_id").alias("__asset")).distinct()
    return window_sums(flows, level1_seconds).join(ids, F.col("src_id") == F.col("__asset")).drop("__asset")


def advance_bounds(flows: DataFrame, assets: DataFrame, interval: str | None, held: OpenWindows | None, until: int,
                   z: float = 1.96, parity: bool = False, zone: str = MODEL_ZONE,
                   max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> tuple[DataFrame, Advance]:
    """Interval bounds of the windows that a batch closes, and the rest of its outcome."""
    d1, d2 = window_lengths(interval)
    step = advance(known_sums(flows, assets, d1, max_broadcast_rows), held, until, d1, d2, parity, written)
    return interval_bounds(window_stats(step.closed, d2), z=z, integer_mean=parity, zone=zone), step


def incremental_baseline(flows: DataFrame, params: DataFrame, members: DataFrame, interval: str | None, store: ResultStore,
                         until: dt.datetime | None, run: int, job: str = "batch", versions: DataFrame | None = None,
                         parity: bool = False, zone: str = MODEL_ZONE, initial: DataFrame | None = None) -> Run | None:
    """One run over the next ``flows``; None if no model is on.

    ``until`` (UTC): all flows before it have been seen, so that windows ending by
    it are closed; None closes every window.  ``run`` counts the runs of
    ``job``: one that the store already holds changes nothing.  A changed
    ``interval`` is an error while windows are open: their sums have other lengths.
    """
    config = model_config(params, parity)
    if config is None:
        return None
    done, old = store.find(job, run), store.manifest()
    if done is not None:
        return Run(done, None)
    lengths = window_lengths(interval)
    held = store.open_windows(old)
    if held is not None and tuple(old.open_windows["lengths"]) != lengths:
        raise ValueError(f"windows of {old.open_windows['lengths']} s are open in {store.root}: close them with until=None first")
    micros = ALL if until is None else (until - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)
    assets = model_assets(params, members, config, parity)
    bounds, step = advance_bounds(flows, assets, interval, held, micros, config.z, parity, zone)
    slots = written(slot_rows(bounds, config.model_id, config.result_span, zone, parity), "slots")
    keep = step.held if until is not None else OpenWindows(step.held.level1, step.held.level2, held.until if held else 0)
    clears = newest_clears(versions, parity) if versions is not None else {}
    version = merge_slots(store, slots, params, config, job, run, clears, parity, initial, keep, lengths)
    return Run(version, step.late)


