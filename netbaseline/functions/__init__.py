"""Column-to-Column helpers (all built-in expressions, no Python UDF)."""

from netbaseline.functions.text import is_blank, blank_aware_equals, blank_aware_equals_ci, to_text
from netbaseline.functions.convert import to_int, to_int_or_zero, to_boolean, round2
from netbaseline.functions.time import (
    window_lengths, instant_from_ntz, local_ntz, zone_date, slot_key, z_for_confidence,
)
from netbaseline.functions.network import internal_flag
from netbaseline.functions.bounds import kib_bounds, interval_text
from netbaseline.functions.ids import result_id

__all__ = [
    "is_blank", "blank_aware_equals", "blank_aware_equals_ci", "to_text",
    "to_int", "to_int_or_zero", "to_boolean", "round2",
    "window_lengths", "instant_from_ntz", "local_ntz", "zone_date", "slot_key", "z_for_confidence",
    "internal_flag", "kib_bounds", "interval_text", "result_id",
]
