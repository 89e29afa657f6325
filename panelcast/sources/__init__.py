from panelcast.sources.sinks import (
    content_state, input_state, materialize, parameter_key, publish, read_or_build, read_published, shared_folder, write_dataset,
    write_report,
)
from panelcast.sources.tables import (
    SCHEMAS, TableSet, narrow_types, parse_dates, read_csv_quarantined, read_csv_table, read_tables,
)

__all__ = [
    "SCHEMAS", "TableSet", "content_state", "input_state", "materialize", "narrow_types", "parameter_key", "parse_dates", "publish",
    "read_csv_quarantined", "read_csv_table", "read_or_build", "read_published", "read_tables", "shared_folder", "write_dataset",
    "write_report",
]
