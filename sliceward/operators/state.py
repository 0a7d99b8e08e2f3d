"""State is an append-only list of events; the current row of a key is a fold over its events.

All folds are group-wise aggregates with a partial step per task, so a key with very many events is reduced
where the events lie before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sliceward.functions import interval_seconds, log_stamp, stamp, text_or_null
from sliceward.schema import BOUNDS, NAMES, SOURCE, TARGET, UNIT_KEY, Layer

ORDER = ("event_ts", "seq")
#: Run ids rise with time, so events of one moment are ordered by their runs, and within a run by its steps.
UNIT_ORDER = ("event_ts", "last_run_id", "seq")

# Status of an entry that never had one, and text lengths of the process log.
UNDEFINED = "UNDEFINED"
ERROR_TEXT_LENGTH = 255
RUN_ERROR_LENGTH = 4000


def last_known(column: str, order: tuple[str, ...] = ORDER) -> Column:
    """Last value of a column that is not NULL, in event order."""
    known = F.when(F.col(column).isNotNull(), F.struct(*order))
    return F.max_by(column, known).alias(column)


def last_said(name: str, columns: list[str], known: Column | None = None, order: tuple[str, ...] = ORDER) -> Column:
    """Columns of the last event, NULLs included; with ``known``, of the last event it holds for."""
    when = F.struct(*order) if known is None else F.when(known, F.struct(*order))
    return F.max_by(F.struct(*columns), when).alias(name)


def current_units(unit_events: DataFrame, layer: Layer) -> DataFrame:
    """current ledger row per unit. Run and error are always those of the last event, the description is
    that of the last discovery; statuses and counts keep their last known value."""
    description = TARGET + ["unit_type"] + NAMES + BOUNDS
    sticky = layer.statuses + ["source_rows", "target_rows"]
    folded = unit_events.groupBy(*UNIT_KEY).agg(
        last_said("description", description, F.col("unit_type").isNotNull(), UNIT_ORDER),
        *[last_known(c, UNIT_ORDER) for c in sticky],
        last_said("latest", ["last_run_id", "error_message"], order=UNIT_ORDER),
    )
    return folded.select(*UNIT_KEY, "description.*", *sticky, "latest.*")


def _deciding(events: DataFrame, key: list[str], order: tuple[str, ...], known: list[Column]) -> DataFrame:
    """The last event of each key and the last for which each of the conditions holds; one that is both comes once."""
    whole, at = F.struct(*events.columns), F.struct(*order)
    kept = [F.max_by(whole, at), *(F.max_by(whole, F.when(k, at)) for k in known)]
    deciding = F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(f"k{i}") for i in range(len(kept))]))))
    folded = events.groupBy(*key).agg(*[k.alias(f"k{i}") for i, k in enumerate(kept)])
    return folded.select(deciding.alias("e")).select("e.*")


def deciding_unit_events(unit_events: DataFrame, layer: Layer) -> DataFrame:
    """The events that decide how all events of a unit fold, also together with events that come later or late: the last
    one, and the last that said the description and each sticky column. Their number per unit is bounded."""
    sticky = layer.statuses + ["source_rows", "target_rows"]
    known = [F.col(c).isNotNull() for c in ("unit_type", *sticky)]
    return _deciding(unit_events, UNIT_KEY, UNIT_ORDER, known)


def deciding_run_events(run_events: DataFrame) -> DataFrame:
    """The events that decide how all events of a run fold: its start, its last status and its finish."""
    return _deciding(run_events, ["run_id"], ORDER, [F.col(c).isNotNull() for c in ("run_type", "run_status", "ended_at")])


def mark_units(
    units: DataFrame,
    layer: Layer,
    status: str,
    run_id: int,
    at: Column,
    rows: Column | None = None,
    error: Column | None = None,
    seq: int = 0,
) -> DataFrame:
    """M4: events that set the load status of units. 'Y' resets the quality status; without a row count the
    old one stays; the error text is always replaced."""
    if status not in ("Y", "N"):
        raise ValueError(f"unsupported load status: {status}")
    null_text = F.lit(None).cast("string")
    return unit_events(
        units,
        layer,
        run_id,
        at,
        seq,
        **{
            layer.load_status: F.lit(status),
            "quality_status": F.lit("N") if status == "Y" else null_text,
            "target_rows": F.lit(None).cast("long") if rows is None else rows.cast("long"),
            "error_message": null_text if error is None else error,
        },
    )


def unit_events(units: DataFrame, layer: Layer, run_id: int, at: Column, seq: int = 0, **said: Column) -> DataFrame:
    """Ledger events about ``units``. Columns that are not said are NULL and keep their folded value."""
    fields = TARGET + ["unit_type"] + NAMES + BOUNDS + layer.statuses + ["source_rows", "target_rows"]
    types = {"low": "date", "high": "date", "list_values": "array<string>"}
    types.update({"source_rows": "long", "target_rows": "long"})
    columns = [said.get(c, F.lit(None)).cast(types.get(c, "string")).alias(c) for c in fields]
    return units.select(
        *UNIT_KEY,
        *columns,
        F.lit(run_id).cast("long").alias("last_run_id"),
        said.get("error_message", F.lit(None)).cast("string").alias("error_message"),
        at.cast("timestamp_ntz").alias("event_ts"),
        F.lit(seq).cast("int").alias("seq"),
    )


def current_runs(run_events: DataFrame) -> DataFrame:
    """current row per run. A run starts RUNNING under upper-case names; finishing it sets the end.

    The events are dealt out by run to all shuffle partitions, so that few events a task are sorted at a time.
    """
    start = ["run_type", *SOURCE, "mstr_log_id", "started_at", "execute_flag"]
    finish = ["ended_at", "error_message"]
    shards = int(run_events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = run_events.repartition(shards, "run_id").groupBy("run_id").agg(
        last_said("start", start, F.col("run_type").isNotNull()),
        last_known("run_status"),
        last_said("finish", finish, F.col("ended_at").isNotNull()),
    )
    return folded.select("run_id", "start.*", "run_status", "finish.*").withColumns(
        {
            "run_type": F.upper(F.trim("run_type")),
            **{c: F.upper(c) for c in SOURCE},
            "error_message": F.substring("error_message", 1, RUN_ERROR_LENGTH),
        }
    )


LOG_KEY = ["mstr_log_id", "log_id"]
LOG_ORDER = ("event_ts", "seq", "entry_key")
LOG_SCALARS = ["log_categ", "mstr_fun", "log_status", "start_date", "end_date", "last_err_code", "last_err_desc"]


def shown_entries(log_events: DataFrame, debug: bool = False) -> DataFrame:
    """The entries that a log shows, with their key and type filled in."""
    shown = F.coalesce(F.col("log_level"), F.lit("N")) == "N"
    if debug:
        shown = shown | (F.col("log_level") == "D")
    return log_events.filter(shown & F.col("log_id").isNotNull()).withColumns(
        {
            "mstr_log_id": F.coalesce("mstr_log_id", "log_id"),
            "log_type": F.coalesce("log_type", F.lit("TEXT")),
            "last_err_desc": F.substring("last_err_desc", 1, ERROR_TEXT_LENGTH),
        }
    )


def last_scalars() -> list[Column]:
    """The last known value of each scalar of a log, with its place in the order."""
    return [F.max(F.when(F.col(c).isNotNull(), F.struct(*LOG_ORDER, F.col(c).alias("said")))).alias(c) for c in LOG_SCALARS]


def consolidate_log(log_events: DataFrame, debug: bool = False) -> DataFrame:
    """one row per (master id, log id).

    Scalars keep their last known value. Messages are appended in event order to one text and one JSON array.
    The text of a log is a single value by definition, but it is put together from pieces: entries are dealt by ranges of
    (log, event order), a piece is what one range holds of a log, pieces are joined by many tasks and only finished ones
    meet in the last. So a log with most of the entries is cut into many pieces, also where all of its entries are of one
    moment, and logs with few entries stay whole.
    """
    logged = shown_entries(log_events, debug)
    key, order = LOG_KEY, LOG_ORDER
    day = log_stamp(F.col("event_ts"))
    message = F.coalesce("log_msg", F.lit(""))
    text = F.when(F.col("log_type") == "SUMMARY", F.concat(message, F.lit("\n"))).otherwise(
        F.concat(F.lit("\n"), day, F.lit(" | "), message, F.lit("\n"))
    )
    entry = F.struct(F.col("log_type").alias("type"), day.alias("timestamp"), message.alias("message"))
    ranges = int(log_events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = logged.repartitionByRange(ranges, *key, *order).withColumn("range", F.spark_partition_id())
    per_range = dealt.groupBy(*key, "range").agg(
        F.array_sort(
            F.collect_list(F.struct(*order, text.alias("text"), F.to_json(entry).alias("json")))
        ).alias("entries"),
        *last_scalars(),
        F.min("event_ts").alias("first_ts"),
    )
    pieces = per_range.withColumns(
        {
            "text": F.array_join(F.transform("entries", lambda e: e["text"]), ""),
            "json": F.array_join(F.transform("entries", lambda e: e["json"]), ","),
        }
    ).drop("entries")
    scalars = LOG_SCALARS
    logs = pieces.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.struct("range", "text", "json"))).alias("pieces"),
        *[F.max(c)["said"].alias(c) for c in scalars],
        F.min("first_ts").alias("first_ts"),
    )
    return logs.select(
        *key,
        "log_categ",
        "mstr_fun",
        F.coalesce("log_status", F.lit(UNDEFINED)).alias("log_status"),
        F.coalesce("start_date", "first_ts").alias("start_date"),
        "end_date",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("log_msg"),
        F.concat(F.lit("["), F.array_join(F.transform("pieces", lambda p: p["json"]), ","), F.lit("]")).alias(
            "log_json"
        ),
        text_or_null(F.col("last_err_code")).alias("last_err_code"),
        text_or_null(F.col("last_err_desc")).alias("last_err_desc"),
    )


def log_durations(log: DataFrame) -> DataFrame:
    """duration of each log entry as an interval and in whole seconds."""
    timed = log.withColumn("interval_time", F.col("end_date") - F.col("start_date"))
    return timed.withColumn("seconds", interval_seconds(F.col("interval_time")))


def expired_log_partitions(
    log: DataFrame, as_of: Column, retention_days: int = 90, initial_high: str = "2019-01-01"
) -> DataFrame:
    """months of the log whose end lies before the retention limit, with the number of entries in them.

    Everything before ``initial_high`` lies in the first partition, which is never dropped.
    """
    limit = as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(abs(retention_days)))
    month = F.trunc(F.to_date("start_date"), "month")
    return (
        log.filter(F.col("start_date") >= F.lit(initial_high).cast("timestamp_ntz"))
        .groupBy(month.alias("log_month"))
        .agg(F.count(F.lit(1)).alias("entries"))
        .withColumn("partition_high", F.add_months("log_month", 1))
        .filter(F.col("partition_high").cast("timestamp_ntz") < limit)
    )


def ledger_seed(units: DataFrame, layer: Layer, run_id: int, at: Column) -> DataFrame:
    """Ledger events of units that count as finished from the start, without rows on either side."""
    described = TARGET + ["unit_type"] + NAMES + BOUNDS
    return unit_events(
        units,
        layer,
        run_id,
        at,
        **{c: F.col(c) for c in described},
        **{s: F.lit("Y") for s in layer.statuses},
        source_rows=F.lit(0),
        target_rows=F.lit(0),
    )
