from tallybook.streaming.events import StreamReport, closed_sessions, first_seen, read_slices, run_to_table, write_slices
from tallybook.streaming.ingest import ingest_new_pointers, stream_pointers

__all__ = [
    "StreamReport",
    "closed_sessions",
    "first_seen",
    "ingest_new_pointers",
    "read_slices",
    "run_to_table",
    "stream_pointers",
    "write_slices",
]
