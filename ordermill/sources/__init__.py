from ordermill.scratch import kept, materialize, scratch_path, scratch_root
from ordermill.sources.buckets import bucket_join, save_bucketed
from ordermill.sources.damaged import read_damaged
from ordermill.sources.lookup import lookup, write_sorted
from ordermill.sources.publish import publish
from ordermill.sources.runs import append_run, committed_runs, read_runs, sweep_runs
from ordermill.sources.tables import (
    Dimensions,
    append_events,
    read_dimensions,
    read_events,
    read_table,
    write_table,
)
from ordermill.sources.versions import (
    newest_version,
    pin_versions,
    read_pinned_dimensions,
    read_version,
    write_version,
)

__all__ = [
    "Dimensions",
    "append_events",
    "append_run",
    "bucket_join",
    "committed_runs",
    "kept",
    "lookup",
    "materialize",
    "newest_version",
    "pin_versions",
    "publish",
    "read_damaged",
    "read_dimensions",
    "read_events",
    "read_pinned_dimensions",
    "read_runs",
    "read_table",
    "read_version",
    "save_bucketed",
    "scratch_path",
    "scratch_root",
    "sweep_runs",
    "write_sorted",
    "write_table",
    "write_version",
]
