"""Structured Streaming entry points."""

from .ingest import read_flights_stream, stream_clean
from .rollup import compact, merged, partial_aggregates, read_rollups, rollup_report, stream_rollups

__all__ = [name for name in dir() if not name.startswith("_")]
