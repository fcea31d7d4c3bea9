"""Reading, storing and keeping tables."""

from martworks.sources.discovery import Relation, read_relations, relations_by_pattern, relations_by_prefix
from martworks.sources.freshness import freshness
from martworks.sources.history import as_of, current, snapshot, snapshot_table
from martworks.sources.raw import load_csv, source
from martworks.sources.tables import (
    as_table, as_view, drop_table, incremental_append, incremental_merge, merged, store_failures, version_of,
)

__all__ = [
    "Relation", "as_of", "as_table", "as_view", "current", "drop_table", "freshness", "incremental_append", "incremental_merge",
    "load_csv", "merged", "read_relations", "relations_by_pattern", "relations_by_prefix", "snapshot", "snapshot_table",
    "source", "store_failures", "version_of",
]
