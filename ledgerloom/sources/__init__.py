from ledgerloom.sources.sinks import append_history, write_by, write_delimited, write_named
from ledgerloom.sources.tables import (
    Tables,
    dated_files,
    latest_snapshot,
    read_checked,
    read_delimited,
    read_files,
    read_jdbc,
    read_table,
    snapshot_pairs,
    trailing_period,
    union_sources,
)

__all__ = [
    "Tables", "append_history", "dated_files", "latest_snapshot", "read_checked", "read_delimited", "read_files", "read_jdbc", "read_table",
    "snapshot_pairs", "trailing_period", "union_sources", "write_by", "write_delimited",
    "write_named",
]
