"""The conformed tables and the sessions, kept up to date as files of hits arrive."""
from clickrev.streaming.conform import conform_stream, read_hit_stream
from clickrev.streaming.sessions import closed_sessions, open_sessions, session_stream, stream_sessions

__all__ = [
    "closed_sessions",
    "conform_stream",
    "open_sessions",
    "read_hit_stream",
    "session_stream",
    "stream_sessions",
]
