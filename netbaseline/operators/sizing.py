"""Broadcast only behind a checked size bound."""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, functions as F

# Rows of a key-only side (an id of some 40 bytes) that may be broadcast:
# 2 million rows stay near 100 MB on every executor.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
# Control tables (model parameters, parameter versions) are read whole into
# every task that needs them only up to this many rows.
MAX_CONTROL_ROWS = 100_000

_checked: "weakref.WeakKeyDictionary[DataFrame, dict[int, bool]]" = weakref.WeakKeyDictionary()


def is_small(df: DataFrame, max_rows: int = MAX_CONTROL_ROWS) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows.

    A partial count: every task sends one number, never rows.

    The answer is remembered per DataFrame object, so a control table used by
    several operators of one plan is counted once.  Sides derived from it
    row by row (filters, projections, one row per key) share the bound.
    """
    if df.isStreaming:
        return False
    seen = _checked.setdefault(df, {})
    if max_rows not in seen:
        seen[max_rows] = df.count() <= max_rows
    return seen[max_rows]


def remember_size(df: DataFrame, n_rows: int) -> None:
    """Record a row count already computed (e.g. in the same job that read the table)."""
    seen = _checked.setdefault(df, {})
    seen[MAX_CONTROL_ROWS] = n_rows <= MAX_CONTROL_ROWS


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` if ``df`` has at most ``max_rows`` rows, else ``(df, False)``.

    A streaming side is never broadcast here.
    """
    if is_small(df, max_rows):
        return F.broadcast(df), True
    return df, False


def broadcast_if(df: DataFrame, bounded: bool) -> DataFrame:
    """Broadcast a side whose bound was proven elsewhere (e.g. by :func:`is_small` on its source)."""
    return F.broadcast(df) if bounded else df
