"""Writers: partitioned Parquet tables, appends, checked refreshes, enforced
contracts, run manifests and further layouts."""

from arrivals_mart.sinks.enforce import (
    EnforcedWrite,
    count_rejects,
    read_accepted,
    read_rejects,
    violations,
    write_enforced,
)
from arrivals_mart.sinks.layout import compact_loads, load_by_position, position_mismatches, write_bucketed
from arrivals_mart.sinks.loads import Load, append_load, key_sketch, not_ruled_out, read_loads, repeated_keys
from arrivals_mart.sinks.manifest import (
    Manifest,
    expire_manifests,
    manifests,
    open_set,
    publish_manifest,
    read_manifest,
)
from arrivals_mart.sinks.tables import (
    expire_versions,
    materialize,
    publish,
    publish_set,
    read_table,
    refresh_table,
    render_path,
    stage_path,
    write_table,
)

__all__ = [
    "EnforcedWrite",
    "Load",
    "Manifest",
    "append_load",
    "compact_loads",
    "count_rejects",
    "expire_manifests",
    "key_sketch",
    "load_by_position",
    "manifests",
    "not_ruled_out",
    "open_set",
    "position_mismatches",
    "publish_manifest",
    "read_accepted",
    "read_loads",
    "read_manifest",
    "read_rejects",
    "repeated_keys",
    "violations",
    "write_bucketed",
    "write_enforced",
    "expire_versions",
    "materialize",
    "publish",
    "publish_set",
    "read_table",
    "refresh_table",
    "render_path",
    "stage_path",
    "write_table",
]
