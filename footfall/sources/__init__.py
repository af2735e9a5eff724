"""Sources and sinks."""

from footfall.sources.adapters import events_raw, lineitem_log, table
from footfall.sources.readers import read_features, read_log, read_raw
from footfall.sources.sinks import (
    ensure_database,
    publish_table,
    scratch_path,
    published,
    verify_published,
    write_features,
    write_log,
)

__all__ = [
    "events_raw", "lineitem_log", "table", "read_features", "read_log", "read_raw",
    "ensure_database", "publish_table", "published", "scratch_path", "verify_published",
    "write_features", "write_log",
]
