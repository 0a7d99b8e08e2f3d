"""The report queries. "Now" is always the argument ``as_of``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sliceward.functions import stamp, strip_text, text_or_null
from sliceward.operators.state import LOG_KEY, consolidate_log, last_scalars, shown_entries
from sliceward.schema import ARCHIVE, SOURCE, TARGET, Layer

# Report settings.
LOOKBACK_DAYS = 7
SUMMARY_MAX_CHARS = 4000
REPORT_MAX_ROWS = 100
ISSUE_ROWS = 20
ISSUE_CHARS = 300
LATEST_ERROR_CHARS = 240

# Marks around the summary in a log text. A log written by another system may use other marks.
SUMMARY_BEGIN = "<<<SUMMARY_BEGIN>>>"
SUMMARY_END = "<<<SUMMARY_END>>>"


def window_start(as_of: Column, lookback_days: int = LOOKBACK_DAYS) -> Column:
    return as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(lookback_days))


def in_window(df: DataFrame, ts_col: str, as_of: Column, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """G1: rows from the lookback window on. The filter is on the raw column, so the scan can prune."""
    return df.filter(F.col(ts_col) >= window_start(as_of, lookback_days))


def report_window(df: DataFrame, ts_col: str, as_of: Column, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """G1: the window's bounds as text and how many rows lie in it."""
    return in_window(df, ts_col, as_of, lookback_days).agg(
        F.lit(lookback_days).alias("lookback_days"),
        stamp(window_start(as_of, lookback_days)).alias("window_start"),
        stamp(as_of.cast("timestamp_ntz")).alias("window_end"),
        F.count(F.lit(1)).alias("rows_in_window"),
    )


def _total(condition: Column) -> Column:
    """Number of matching rows; NULL for an empty group, as a sum gives."""
    return F.sum(F.when(condition, 1).otherwise(0)).cast("long")


def _run_totals() -> list[Column]:
    status, mode = F.col("run_status"), F.col("execute_flag")
    return [
        F.count("run_id").alias("runs_total"),
        _total(status == "SUCCESS").alias("success_runs"),
        _total(status == "WARNING").alias("warning_runs"),
        _total(status == "ERROR").alias("error_runs"),
        _total(mode == "Y").alias("execute_runs"),
        _total(mode == "N").alias("preview_runs"),
    ]


def exec_summary(runs: DataFrame, as_of: Column, lookback_days: int = LOOKBACK_DAYS) -> DataFrame:
    """Totals of the window next to the newest run of all time, in one pass and without a global window.

    An empty window gives no latest run either, since the report shows the latest run next to the window's.
    """
    inside = F.col("started_at") >= window_start(as_of, lookback_days)
    status, mode = F.col("run_status"), F.col("execute_flag")

    def windowed(condition: Column) -> Column:
        return F.sum(F.when(inside, F.when(condition, 1).otherwise(0))).cast("long")

    latest = F.struct("run_status", "started_at", "error_message")
    totals = runs.agg(
        F.count(F.when(inside, F.col("run_id"))).alias("runs_total"),
        windowed(status == "SUCCESS").alias("success_runs"),
        windowed(status == "WARNING").alias("warning_runs"),
        windowed(status == "ERROR").alias("error_runs"),
        windowed(mode == "Y").alias("execute_runs"),
        windowed(mode == "N").alias("preview_runs"),
        F.max_by(latest, F.struct("started_at", "run_id")).alias("latest"),
    )
    shown = F.col("runs_total") > 0
    return totals.select(
        "runs_total",
        "success_runs",
        "warning_runs",
        "error_runs",
        "execute_runs",
        "preview_runs",
        F.when(shown, F.col("latest.run_status")).alias("latest_status"),
        F.when(shown, stamp(F.col("latest.started_at"))).alias("latest_started"),
        F.when(shown, F.substring("latest.error_message", 1, LATEST_ERROR_CHARS)).alias("latest_error"),
    )


def _processes(df: DataFrame, layer: Layer) -> DataFrame:
    """The layer's process names in report order; a handful of constants."""
    names = F.array(*[F.lit(p) for p in layer.processes])
    return df.sparkSession.range(1).select(F.posexplode(names).alias("process_order", "run_type"))


def process_summary(
    runs: DataFrame, as_of: Column, layer: Layer = ARCHIVE, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Totals per process of the window; idle processes appear with zeros."""
    totals = (
        in_window(runs, "started_at", as_of, lookback_days)
        .groupBy("run_type")
        .agg(*_run_totals(), stamp(F.max("started_at")).alias("latest_started"))
    )
    counts = ["runs_total", "success_runs", "warning_runs", "error_runs", "execute_runs", "preview_runs"]
    return (
        _processes(runs, layer)
        .join(totals, "run_type", "left")
        .orderBy("process_order")
        .select("run_type", *[F.coalesce(c, F.lit(0)).alias(c) for c in counts], "latest_started")
    )


def _marked(log: DataFrame, begin: str, end: str) -> DataFrame:
    """Log entries with both marks, the position after the first mark and the length up to the other one."""
    begin_pos, end_pos = F.instr("log_msg", begin), F.instr("log_msg", end)
    text_pos = begin_pos + len(begin)
    return log.filter((begin_pos > 0) & (end_pos > 0)).withColumns(
        {"text_pos": text_pos, "text_length": end_pos - text_pos}
    )


def latest_summaries(
    log: DataFrame,
    as_of: Column,
    layer: Layer = ARCHIVE,
    lookback_days: int = LOOKBACK_DAYS,
    max_chars: int = SUMMARY_MAX_CHARS,
    begin: str = SUMMARY_BEGIN,
    end: str = SUMMARY_END,
) -> DataFrame:
    """Newest summary per process in the window.

    The newest entry is an aggregate, not a window: a process with most of the log is reduced task by task.
    """
    marked = _marked(in_window(log, "start_date", as_of, lookback_days), begin, end).filter("text_length > 0")
    text = F.substring(F.col("log_msg"), F.col("text_pos"), F.least(F.lit(max_chars), F.col("text_length")))
    newest = marked.groupBy(F.col("log_categ").alias("run_type")).agg(
        F.max_by(
            F.struct("log_status", "start_date", text_or_null(strip_text(text)).alias("text")),
            F.struct("start_date", "log_id"),
        ).alias("newest")
    )
    return (
        _processes(log, layer)
        .join(newest, "run_type", "left")
        .orderBy("process_order")
        .select(
            "run_type",
            F.coalesce(F.col("newest.log_status"), F.lit("N/A")).alias("latest_status"),
            F.coalesce(stamp(F.col("newest.start_date")), F.lit("N/A")).alias("latest_started"),
            F.coalesce(F.col("newest.text"), F.lit("No summary available")).alias("summary_text"),
        )
    )


def latest_summary(
    log: DataFrame,
    process: str,
    layer: Layer = ARCHIVE,
    begin: str = SUMMARY_BEGIN,
    end: str = SUMMARY_END,
) -> DataFrame:
    """Newest summary of one process of all time, in full length."""
    wanted = process.strip().upper()
    if wanted not in layer.processes:
        raise ValueError(f"invalid {layer.name} process: {process}")
    text = F.substring(F.col("log_msg"), F.col("text_pos"), F.greatest(F.lit(0), F.col("text_length")))
    return (
        _marked(log.filter(F.col("log_categ") == wanted), begin, end)
        .orderBy(F.desc("start_date"), F.desc("log_id"))
        .limit(1)
        .select(
            F.lit(wanted).alias("process"),
            "log_status",
            "start_date",
            "end_date",
            "log_id",
            text_or_null(strip_text(text)).alias("summary_text"),
        )
    )


def latest_summary_of(
    log_events: DataFrame,
    process: str,
    layer: Layer = ARCHIVE,
    begin: str = SUMMARY_BEGIN,
    end: str = SUMMARY_END,
) -> DataFrame:
    """G8 from the events of the log: the newest log that carries a summary is found first, by its scalars and by which
    entries hold the marks, and only the text of that one log is put together."""
    if process.strip().upper() not in layer.processes:
        raise ValueError(f"invalid {layer.name} process: {process}")
    holds = [F.max(F.coalesce(F.instr("log_msg", mark) > 0, F.lit(False))).alias(name) for name, mark in (("begins", begin), ("ends", end))]
    keyed = shown_entries(log_events).groupBy(*LOG_KEY).agg(*last_scalars(), F.min("event_ts").alias("first_ts"), *holds)
    started = F.coalesce(F.col("start_date.said"), F.col("first_ts"))
    wanted = keyed.filter((F.col("log_categ.said") == process.strip().upper()) & F.col("begins") & F.col("ends"))
    newest = wanted.select(*LOG_KEY, started.alias("started")).orderBy(F.desc("started"), F.desc("log_id")).limit(1)
    own = F.coalesce("mstr_log_id", "log_id").eqNullSafe(F.col("__master")) & (F.col("log_id") == F.col("__log"))
    one = newest.select(F.col("mstr_log_id").alias("__master"), F.col("log_id").alias("__log"))
    return latest_summary(consolidate_log(log_events.join(F.broadcast(one), own, "left_semi")), process, layer, begin, end)


def data_status(ledger: DataFrame, layer: Layer = ARCHIVE) -> DataFrame:
    """State of every target table."""
    load, cleanup = F.col(layer.load_status), F.col(layer.cleanup_status)
    quality = F.col("quality_status")
    done, cleaned = ("archived", "truncated") if layer is ARCHIVE else ("replicated", "purged")
    return (
        ledger.groupBy(*TARGET)
        .agg(
            F.count(F.lit(1)).alias("units_total"),
            _total(load == "Y").alias(f"{done}_units"),
            _total(load == "N").alias(f"{layer.load_step.lower()}_pending"),
            _total(quality == "Y").alias("quality_ok_units"),
            _total(quality == "N").alias("quality_pending"),
            _total(cleanup == "Y").alias(f"{cleaned}_units"),
            _total(cleanup == "N").alias(f"{layer.cleanup_step.lower()}_pending"),
            F.sum("source_rows").alias("source_rows"),
            F.sum("target_rows").alias("target_rows"),
        )
        .orderBy(*TARGET)
    )


def pending_work(ledger: DataFrame, layer: Layer = ARCHIVE) -> DataFrame:
    """Tables with open work and how much of which kind."""
    loaded = F.col(layer.load_status) == "Y"
    good = F.col("quality_status") == "Y"
    work = {
        f"pending_{layer.load_step.lower()}": F.col(layer.load_status) == "N",
        "pending_quality": loaded & (F.col("quality_status") == "N"),
        f"{layer.cleanup_step.lower()}_candidates": loaded & good & (F.col(layer.cleanup_status) == "N"),
        "units_with_error": text_or_null(F.col("error_message")).isNotNull(),
    }
    return (
        ledger.groupBy(*SOURCE, "target_table")
        .agg(*[_total(c).alias(name) for name, c in work.items()])
        .filter(F.greatest(*work) > 0)
        .orderBy("source_owner", "source_table", "target_table")
    )


def recent_issues(
    runs: DataFrame,
    log: DataFrame,
    as_of: Column,
    lookback_days: int = LOOKBACK_DAYS,
    k: int = ISSUE_ROWS,
) -> DataFrame:
    """The newest problems of runs and log. Only the top k of every task are kept and merged.

    Equal times are put in order by source, status and text, so the list does not change between runs.
    """
    table = F.concat_ws(".", *[F.coalesce(F.col(c), F.lit("")) for c in ("source_owner", "source_table")])
    failed_runs = in_window(runs, "started_at", as_of, lookback_days).filter(
        F.col("run_status").isin("WARNING", "ERROR")
    )
    failed_logs = in_window(log, "start_date", as_of, lookback_days).filter(
        F.upper("log_status").isin("WARNING", "ERROR") | F.col("last_err_code").isNotNull()
    )
    issues = failed_runs.select(
        F.col("started_at").alias("at"),
        F.concat(F.lit("RUN "), F.col("run_type")).alias("source_name"),
        F.col("run_status").alias("status_name"),
        F.coalesce(text_or_null(F.col("error_message")), table).alias("message_text"),
    ).unionByName(
        failed_logs.select(
            F.col("start_date").alias("at"),
            F.coalesce("mstr_fun", "log_categ").alias("source_name"),
            F.col("log_status").alias("status_name"),
            F.col("log_msg").alias("message_text"),
        )
    )
    issues = issues.withColumn("message_text", F.substring("message_text", 1, ISSUE_CHARS))
    return (
        issues.orderBy(F.desc("at"), "source_name", "status_name", "message_text")
        .limit(k)
        .select(stamp(F.col("at")).alias("issue_time"), "source_name", "status_name", "message_text")
    )


def cap_rows(df: DataFrame, *order: str, max_rows: int = REPORT_MAX_ROWS) -> DataFrame:
    """A report section shows its first rows only, in the given order or in its own."""
    return (df.orderBy(*order) if order else df).limit(max_rows)


def report_sections(
    runs: DataFrame,
    log: DataFrame,
    ledger: DataFrame,
    as_of: Column,
    layer: Layer = ARCHIVE,
    lookback_days: int = LOOKBACK_DAYS,
    max_rows: int = REPORT_MAX_ROWS,
) -> dict[str, DataFrame]:
    """The sections of a layer's summary report, each capped; rows_total tells how many rows a section has."""
    sections = {
        "window": report_window(runs, "started_at", as_of, lookback_days),
        "exec_summary": exec_summary(runs, as_of, lookback_days),
        "process_summary": process_summary(runs, as_of, layer, lookback_days),
        "latest_summaries": latest_summaries(log, as_of, layer, lookback_days),
        "data_status": data_status(ledger, layer),
        "pending_work": pending_work(ledger, layer),
        "recent_issues": recent_issues(runs, log, as_of, lookback_days),
    }
    return {name: cap_rows(df, max_rows=max_rows).withColumn("rows_total", F.lit(df.count())) for name, df in sections.items()}
