"""Structured Streaming form of the readiness gate."""

from ledgerday.streaming.readiness import latest_readiness, readiness_updates, start_readiness_stream

__all__ = ["latest_readiness", "readiness_updates", "start_readiness_stream"]
