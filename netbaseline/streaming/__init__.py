"""Structured Streaming form of the baseline job."""

from netbaseline.streaming.log_store import Manifest, ResultStore
from netbaseline.streaming.baseline import (
    start_stream_baseline, stream_bounds_from_files, stream_results_from_files, make_batch_sink, merge_slots,
)
from netbaseline.streaming.live import IdleCloser, LiveJob, start_live

__all__ = ["IdleCloser", "LiveJob", "start_live", "Manifest", "ResultStore", "start_stream_baseline", "stream_bounds_from_files", "stream_results_from_files",
           "make_batch_sink", "merge_slots"]
