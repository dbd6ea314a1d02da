"""Incremental ingest and merges with Structured Streaming."""

from reelhouse.streaming.ingest import ingest_to_bronze
from reelhouse.streaming.merge import merge_to_silver

__all__ = ["ingest_to_bronze", "merge_to_silver"]
