"""Readers and writers."""

from .readers import (
    load_source, read_first_existing, read_incidents_csv, read_report, read_table,
)
from .runlog import log_run, read_runs
from .writers import (
    layer_counts, path_exists, publish_events, save_model, write_report, write_table,
)

__all__ = [
    "load_source", "read_first_existing", "read_incidents_csv", "read_report", "read_table",
    "log_run", "read_runs",
    "layer_counts", "path_exists", "publish_events", "save_model", "write_report",
    "write_table",
]
