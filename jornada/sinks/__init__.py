"""Sinks: partitioned curated tables and their catalog entries."""

from .curated import RERUN_MODES, clustered, sync_catalog, write_batch

__all__ = ["RERUN_MODES", "clustered", "sync_catalog", "write_batch"]
