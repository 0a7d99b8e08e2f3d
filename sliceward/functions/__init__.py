from sliceward.functions.expressions import (
    business_date,
    flag,
    high_value_date,
    interval_seconds,
    list_text,
    list_values,
    log_stamp,
    partition_hv,
    stamp,
    strip_text,
    subpartition_hv,
    summary_cell,
    text_or_null,
)

__all__ = [
    "business_date",
    "flag",
    "high_value_date",
    "interval_seconds",
    "list_text",
    "list_values",
    "log_stamp",
    "partition_hv",
    "stamp",
    "strip_text",
    "subpartition_hv",
    "summary_cell",
    "text_or_null",
]
