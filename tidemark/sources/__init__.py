from tidemark.sources.bronze import bronze_table, read_bronze, stream_bronze
from tidemark.sources.export import export_tables, exported
from tidemark.sources.published import Published
from tidemark.sources.snapshots import SnapshotTable
from tidemark.sources.tables import SourceBinding, read_table, table_exists
from tidemark.sources.topics import read_topic

__all__ = [
    "bronze_table",
    "read_bronze",
    "stream_bronze",
    "SnapshotTable",
    "SourceBinding",
    "Published",
    "export_tables",
    "exported",
    "read_table",
    "read_topic",
    "table_exists",
]
