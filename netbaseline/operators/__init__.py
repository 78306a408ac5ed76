"""DataFrame -> DataFrame operators of the baseline job."""

from netbaseline.operators.sizing import bounded_broadcast
from netbaseline.operators.params import (
    ACTIVE_PREDICATE, active_models, active_model, resolve_assets, diff_params, clear_history,
)
from netbaseline.operators.membership import keep_known_assets
from netbaseline.operators.aggregate import level1, split_directions, level2, interval_bounds
from netbaseline.operators.profile import slot_rows, gate, horizon, upsert_results, explode_profiles

__all__ = [
    "bounded_broadcast", "ACTIVE_PREDICATE", "active_models", "active_model", "resolve_assets",
    "diff_params", "clear_history", "keep_known_assets", "level1", "split_directions", "level2",
    "interval_bounds", "slot_rows", "gate", "horizon", "upsert_results", "explode_profiles",
]
