"""File scans, lineage, sinks and the versioned table."""

from snapmart.sources.files import (
    SnapshotSource,
    discover_files,
    load_bronze,
    read_raw_csv,
    list_files,
    stamp_lineage,
)
from snapmart.sources.lake import VersionedTable
from snapmart.sources.sinks import publish_views, stage_table, write_csv, write_parquet

__all__ = [
    "SnapshotSource",
    "VersionedTable",
    "discover_files",
    "load_bronze",
    "publish_views",
    "read_raw_csv",
    "list_files",
    "stage_table",
    "stamp_lineage",
    "write_csv",
    "write_parquet",
]
