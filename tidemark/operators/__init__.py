from tidemark.operators.changes import (
    change_history,
    decode_columns,
    latest_changes,
    latest_per_key,
    parse_envelope,
    parse_messages,
    reject_counts,
    rejects,
    split_changes,
)
from tidemark.operators.checks import Check, accepted_values, not_null, relationships, run_suite, unique
from tidemark.operators.clicks import high_water, new_rows, parse_clicks, refine_clickstream

__all__ = [
    "Check",
    "accepted_values",
    "change_history",
    "decode_columns",
    "high_water",
    "latest_changes",
    "latest_per_key",
    "new_rows",
    "not_null",
    "parse_clicks",
    "parse_envelope",
    "parse_messages",
    "refine_clickstream",
    "reject_counts",
    "rejects",
    "relationships",
    "run_suite",
    "split_changes",
    "unique",
]
