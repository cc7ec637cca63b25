from tidemark.streaming.apply import apply_cdc_stream, refresh_table
from tidemark.streaming.clicks import deliveries, first_deliveries, refine_clickstream_stream, stage_counts, visit_sessions
from tidemark.streaming.history import History
from tidemark.streaming.landing import land_topic, land_topics, to_bronze, write_stream
from tidemark.streaming.state import compact_state, keep_state, latest_in_state, read_state

__all__ = [
    "History",
    "apply_cdc_stream",
    "compact_state",
    "deliveries",
    "first_deliveries",
    "keep_state",
    "land_topic",
    "land_topics",
    "latest_in_state",
    "read_state",
    "refine_clickstream_stream",
    "refresh_table",
    "stage_counts",
    "to_bronze",
    "visit_sessions",
    "write_stream",
]
