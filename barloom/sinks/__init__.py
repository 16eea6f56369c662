"""Writers and catalog objects."""

from barloom.sinks.buckets import save_bucketed, trust_order
from barloom.sinks.catalog import (
    create_database,
    create_view,
    drop_table,
    register_external,
    row_count,
    save_table,
)
from barloom.sinks.lake import (
    export_csv,
    raw_path,
    transformed_path,
    write_partitioned,
    write_raw,
)
from barloom.sinks.ordered import ordered_between, ordered_head, save_ordered
from barloom.sinks.versions import current_version, drop_version, replace_table, versions
from barloom.scratch import scratch_dir

__all__ = [
    "create_database",
    "create_view",
    "current_version",
    "drop_table",
    "drop_version",
    "export_csv",
    "ordered_between",
    "ordered_head",
    "raw_path",
    "register_external",
    "replace_table",
    "row_count",
    "save_bucketed",
    "save_ordered",
    "save_table",
    "scratch_dir",
    "transformed_path",
    "trust_order",
    "versions",
    "write_partitioned",
    "write_raw",
]
