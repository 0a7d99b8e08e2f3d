from sliceward.sources.readers import SourceSpec, check_columns, read_source
from sliceward.sources.stored import (
    append_state,
    claim,
    compact_state,
    create_table,
    for_each_table,
    release,
    require_partition_overwrite,
    scratch_database,
    scratch_name,
    settle,
)

__all__ = [
    "SourceSpec",
    "append_state",
    "check_columns",
    "claim",
    "compact_state",
    "create_table",
    "for_each_table",
    "read_source",
    "release",
    "require_partition_overwrite",
    "scratch_database",
    "scratch_name",
    "settle",
]
