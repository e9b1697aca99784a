"""Writers."""

from shopfloor.sinks.bucketed import write_bucketed
from shopfloor.sinks.tables import (
    export_sheet,
    load_audit,
    overwrite_by_day,
    overwrite_table,
)
from shopfloor.sinks.versions import current, publish, read_current, write_parts

__all__ = [
    "current", "export_sheet", "load_audit", "overwrite_by_day", "overwrite_table", "publish",
    "read_current", "write_bucketed", "write_parts",
]
