"""Streaming ingest and refinement."""

from .ingest import decode_envelope, ingest, parse_events, read_events, write_stream
from .quarantine import ingest_checked, open_messages, read_checked, replay
from .refine import late_rows, refine_stream

__all__ = [
    "decode_envelope", "ingest", "parse_events", "read_events", "write_stream",
    "ingest_checked", "open_messages", "read_checked", "replay",
    "late_rows", "refine_stream",
]
