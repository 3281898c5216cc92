"""Structured Streaming form of the pipeline (incremental silver + reports)."""

from .live import (
    append_silver,
    match_stream,
    running_hit_rates,
    running_view,
    silver_stream,
    stream_session,
)

__all__ = [
    "append_silver",
    "match_stream",
    "running_hit_rates",
    "running_view",
    "silver_stream",
    "stream_session",
]
