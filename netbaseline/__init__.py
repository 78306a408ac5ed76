"""Per-asset network traffic baselines on Spark.

The package learns, for each asset and transport protocol, a confidence
interval of the bytes it sends and receives per event-time window and keeps
those intervals in a keyed profile table.  Every step is a DataFrame
transformation, so the same code serves ``spark.read`` and
``spark.readStream`` inputs.
"""

from netbaseline.session import build_session, scratch_root

__all__ = ["build_session", "scratch_root"]
