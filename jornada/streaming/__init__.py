"""Incremental curation of newly landed raw days (Structured Streaming)."""

from .incremental import BatchResult, changed_days, curate_days, curate_stream

__all__ = ["BatchResult", "changed_days", "curate_days", "curate_stream"]
