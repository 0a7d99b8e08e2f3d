"""Names and schemas shared by all operators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values of the data model.
NO_SUBPARTITION = "#"
MAXVALUE = "MAXVALUE"
PARTITION = "PARTITION"
SUBPARTITION = "SUBPARTITION"
MISMATCH_MESSAGE = "Source row count does not match target row count"

SOURCE = ["source_link", "source_owner", "source_table"]
TARGET = ["target_owner", "target_table"]
HIGH_VALUES = ["partition_hv", "subpartition_hv"]
UNIT_KEY = SOURCE + HIGH_VALUES

NAMES = [
    "source_partition_name",
    "source_subpartition_name",
    "partition_name",
    "subpartition_name",
]
BOUNDS = ["low", "high", "list_values"]


@dataclass(frozen=True)
class Layer:
    """The archive and the replica run the same operators under different column and step names."""

    name: str
    load_status: str
    cleanup_status: str
    steps: tuple[str, str, str, str]
    days_online: int

    @property
    def processes(self) -> tuple[str, ...]:
        return (*self.steps, "RUNNER")

    @property
    def load_step(self) -> str:
        return self.steps[1]

    @property
    def cleanup_step(self) -> str:
        return self.steps[3]

    @property
    def statuses(self) -> list[str]:
        return [self.load_status, "quality_status", self.cleanup_status]


# Step names, status columns and default days online of the two layers.
ARCHIVE = Layer(
    "archive",
    "archive_status",
    "truncate_status",
    ("DISCOVER", "ARCHIVE", "QUALITY", "TRUNCATE"),
    30,
)
REPLICA = Layer(
    "replica",
    "replica_status",
    "purge_status",
    ("DISCOVER", "REPLICATE", "QUALITY", "PURGE"),
    365,
)

# Run states of the control tables.
RUN_STATUSES = ("INIT", "RUNNING", "SUCCESS", "WARNING", "ERROR", "CANCELLED")

CONFIG_SCHEMA = T.StructType(
    [
        T.StructField("source_link", T.StringType()),
        T.StructField("source_owner", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("target_owner", T.StringType()),
        T.StructField("target_table", T.StringType()),
        T.StructField("last_business_date", T.DateType()),
        T.StructField("days_online", T.IntegerType()),
        T.StructField("preserve_rule", T.StringType()),
        T.StructField("enabled_flag", T.StringType()),
    ]
)

RUN_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("run_type", T.StringType()),
        T.StructField("run_status", T.StringType()),
        T.StructField("source_link", T.StringType()),
        T.StructField("source_owner", T.StringType()),
        T.StructField("source_table", T.StringType()),
        T.StructField("mstr_log_id", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("ended_at", T.TimestampNTZType()),
        T.StructField("execute_flag", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("seq", T.IntegerType()),
    ]
)

LOG_EVENT_SCHEMA = T.StructType(
    [
        T.StructField("mstr_log_id", T.LongType()),
        T.StructField("log_id", T.LongType()),
        T.StructField("log_level", T.StringType()),
        T.StructField("log_type", T.StringType()),
        T.StructField("log_categ", T.StringType()),
        T.StructField("mstr_fun", T.StringType()),
        T.StructField("log_status", T.StringType()),
        T.StructField("start_date", T.TimestampNTZType()),
        T.StructField("end_date", T.TimestampNTZType()),
        T.StructField("log_msg", T.StringType()),
        T.StructField("last_err_code", T.StringType()),
        T.StructField("last_err_desc", T.StringType()),
        T.StructField("event_ts", T.TimestampNTZType()),
        T.StructField("seq", T.IntegerType()),
        T.StructField("entry_key", T.StringType()),
    ]
)


def ledger_event_schema(layer: Layer) -> T.StructType:
    text = T.StringType()
    return T.StructType(
        [T.StructField(c, text) for c in UNIT_KEY + TARGET + ["unit_type"] + NAMES]
        + [
            T.StructField("low", T.DateType()),
            T.StructField("high", T.DateType()),
            T.StructField("list_values", T.ArrayType(text)),
        ]
        + [T.StructField(c, text) for c in layer.statuses]
        + [
            T.StructField("source_rows", T.LongType()),
            T.StructField("target_rows", T.LongType()),
            T.StructField("last_run_id", T.LongType()),
            T.StructField("error_message", text),
            T.StructField("event_ts", T.TimestampNTZType()),
            T.StructField("seq", T.IntegerType()),
        ]
    )
