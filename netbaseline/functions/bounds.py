"""Interval bounds as stored in a profile slot."""

from pyspark.sql import Column, functions as F

from netbaseline.functions.convert import round2
from netbaseline.functions.text import _c

KIB = 1024.0


def kib_bounds(min_bytes, max_bytes) -> tuple[Column, Column]:
    """(low, high) in KiB, two decimals; a negative low bound becomes 0.

    Both bounds are rounded before and after the division, as stored values are.
    """
    lo = round2(_c(min_bytes))
    hi = round2(_c(max_bytes))
    lo_kib = F.when(lo < 0, F.lit(0.0)).otherwise(round2(lo / F.lit(KIB)))
    hi_kib = round2(hi / F.lit(KIB))
    return lo_kib, hi_kib


def interval_text(lo, hi) -> Column:
    """``low-high`` with Java-style double text, e.g. ``0.0-13818.35``."""
    return F.concat_ws("-", _c(lo).cast("string"), _c(hi).cast("string"))
