"""Writers for the three result tables."""

from bondliq.sinks.store import CommitConflict, Store
from bondliq.sinks.tables import (
    append_jdbc,
    read_dated,
    read_table,
    with_audit,
    write_export,
    write_full_refresh,
    write_replace_date,
)

__all__ = ["CommitConflict", "Store", "append_jdbc", "read_dated", "read_table", "with_audit", "write_export",
           "write_full_refresh", "write_replace_date"]
