"""Structured Streaming entry points."""

from playlake.streaming.ingest import RAW_EVENT_SCHEMA, start_event_ingest
from playlake.streaming.sessions import session_stream, start_session_stream

__all__ = ["RAW_EVENT_SCHEMA", "session_stream", "start_event_ingest", "start_session_stream"]
