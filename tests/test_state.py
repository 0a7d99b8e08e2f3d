"""Folding of events, the log, reports and constraints."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators.reports import SUMMARY_BEGIN, SUMMARY_END
from sliceward.schema import ARCHIVE, LOG_EVENT_SCHEMA, REPLICA, RUN_EVENT_SCHEMA, SOURCE
from sliceward.sources import append_state, create_table, for_each_table, scratch_name
from tests import fixtures as fx
from tests.test_candidates import config, ledger

T0 = datetime(2024, 1, 31, 10, 0, 0)


def at(minutes=0):
    return F.lit((T0 + timedelta(minutes=minutes)).isoformat(sep=" ")).cast("timestamp_ntz")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_marks_fold_to_the_rules_of_the_ledger(spark):
    units = ledger(spark, ["2024-01-01"], "NNN").withColumns(
        {"source_partition_name": F.lit("P1"), "source_subpartition_name": F.lit("#")}
    )
    found = op.discover_events(units, ARCHIVE, 1, at(0))
    loaded = op.mark_units(units, ARCHIVE, "Y", 2, at(1), rows=F.lit(10), seq=1)
    checked = op.unit_events(units, ARCHIVE, 3, at(2), quality_status=F.lit("Y"), source_rows=F.lit(10))
    failed = op.mark_units(units, ARCHIVE, "N", 4, at(3), error=F.lit("cut off"))
    again = op.mark_units(units, ARCHIVE, "Y", 5, at(3), seq=1)

    def fold(*events):
        rows = events[0]
        for e in events[1:]:
            rows = rows.unionByName(e)
        r = one(op.current_units(rows, ARCHIVE))
        return (r["archive_status"], r["quality_status"], r["truncate_status"], r["source_rows"], r["target_rows"],
                r["last_run_id"], r["error_message"])

    assert fold(found) == ("N", "N", "N", None, None, 1, None)
    assert fold(found, loaded) == ("Y", "N", "N", None, 10, 2, None)
    assert fold(found, loaded, checked) == ("Y", "Y", "N", 10, 10, 3, None)
    # A failed reload keeps the quality and the old count, and says why.
    assert fold(found, loaded, checked, failed) == ("N", "Y", "N", 10, 10, 4, "cut off")
    # A successful one resets the quality; without a count the old one stays; the error is replaced.
    assert fold(again, checked, failed, loaded, found) == ("Y", "N", "N", 10, 10, 5, None)
    with pytest.raises(ValueError):
        op.mark_units(units, ARCHIVE, "X", 1, at())


def test_run_fold(spark):
    rows = [
        (7, "archive ", "RUNNING", "link", "own", "tab", 70, T0, None, "Y", None, T0, 0),
        (7, None, "ERROR", None, None, None, None, None, T0, None, "x" * 5000, T0, 1),
        (8, "QUALITY", "RUNNING", None, None, None, 80, T0, None, "N", None, T0, 0),
    ]
    runs = {r["run_id"]: r for r in op.current_runs(spark.createDataFrame(rows, RUN_EVENT_SCHEMA)).collect()}
    done = runs[7]
    assert (done["run_type"], done["run_status"], done["source_link"], done["source_owner"]) == (
        "ARCHIVE", "ERROR", "LINK", "OWN")
    assert len(done["error_message"]) == 4000 and done["ended_at"] == T0 and done["mstr_log_id"] == 70
    assert runs[8]["run_status"] == "RUNNING" and runs[8]["ended_at"] is None


def log_event(mstr, log_id, msg, minute, seq=0, level="N", kind="TEXT", status=None, start=None, end=None, categ=None,
              code=None, desc=None):
    return (mstr, log_id, level, kind, categ, None, status, start, end, msg, code, desc, T0 + timedelta(minutes=minute),
            seq, "")


def test_log_keeps_order_and_last_known_values(spark):
    rows = [
        log_event(None, 1, 'say "hi"\n\\', 0, status="RUNNING", start=T0),
        log_event(1, 1, "second", 0, seq=1, categ="ARCHIVE"),
        log_event(1, 1, "hidden", 1, level="D", status="ERROR"),
        log_event(1, 1, "third", 125, kind="ERROR", status="ERROR", end=T0 + timedelta(minutes=125), code="-1",
                  desc="d" * 400),
        log_event(1, 1, "last", 126),
        log_event(2, 2, "alone", 3),
    ]
    events = spark.createDataFrame(rows, LOG_EVENT_SCHEMA)
    logs = {r["log_id"]: r for r in op.consolidate_log(events).collect()}
    r = logs[1]
    stamp = "31-01-2024 10:00:00"
    assert r["log_msg"].startswith(f'\n{stamp} | say "hi"\n\\\n\n{stamp} | second\n')
    assert r["log_msg"].index("third") < r["log_msg"].index("last") and "hidden" not in r["log_msg"]
    entries = json.loads(r["log_json"])
    assert [e["message"] for e in entries] == ['say "hi"\n\\', "second", "third", "last"]
    assert entries[0]["timestamp"] == stamp and entries[2]["type"] == "ERROR"
    assert (r["mstr_log_id"], r["log_categ"], r["log_status"], r["start_date"]) == (1, "ARCHIVE", "ERROR", T0)
    assert r["last_err_code"] == "-1" and len(r["last_err_desc"]) == 255
    assert one(op.log_durations(op.consolidate_log(events).filter("log_id = 1")))["seconds"] == 125 * 60
    assert logs[2]["log_status"] == "UNDEFINED" and logs[2]["start_date"] == T0 + timedelta(minutes=3)
    shown = op.consolidate_log(events, debug=True).filter("log_id = 1")
    assert "hidden" in one(shown)["log_msg"]


def test_log_with_one_hot_key(spark):
    """Two thirds of the entries belong to one log; its text is whole and in order."""
    n = 3000
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("log_id"),
        F.col("id").cast("string").alias("log_msg"),
        F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 7)").alias("event_ts"),
    )
    rest = [f for f in LOG_EVENT_SCHEMA if f.name not in rows.columns]
    events = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in rest])
    hot = one(op.consolidate_log(events).filter("log_id = -1"))
    wanted = [str(i) for i in range(n) if i % 3]
    assert [line.split(" | ")[1] for line in hot["log_msg"].split("\n") if line] == wanted
    assert len(json.loads(hot["log_json"])) == len(wanted)


def runs_df(spark, rows):
    full = [(i, t, s, "L", "O", "T", i, ts, None, x, e) for i, t, s, ts, x, e in rows]
    return spark.createDataFrame(
        full, "run_id bigint, run_type string, run_status string, source_link string, source_owner string, "
        "source_table string, mstr_log_id bigint, started_at timestamp_ntz, ended_at timestamp_ntz, "
        "execute_flag string, error_message string")


def test_exec_summary_of_an_empty_window(spark):
    old = runs_df(spark, [(1, "ARCHIVE", "ERROR", T0 - timedelta(days=8), "Y", "bad")])
    r = one(op.exec_summary(old, at()))
    assert r["runs_total"] == 0 and all(r[c] is None for c in r.asDict() if c != "runs_total")
    empty = one(op.exec_summary(old.filter("false"), at()))
    assert empty["runs_total"] == 0 and empty["success_runs"] is None and empty["latest_status"] is None
    table = op.process_summary(old, at()).collect()
    assert [r["run_type"] for r in table] == list(ARCHIVE.processes)
    assert all(r["runs_total"] == 0 and r["error_runs"] == 0 and r["latest_started"] is None for r in table)


def test_exec_summary_latest_and_window_edge(spark):
    edge = T0 - timedelta(days=7)
    runs = runs_df(spark, [
        (1, "ARCHIVE", "SUCCESS", edge, "Y", None),
        (2, "ARCHIVE", "SUCCESS", edge - timedelta(seconds=1), "Y", None),
        (3, "QUALITY", "WARNING", T0, "N", None),
        (4, "QUALITY", "ERROR", T0, "N", "e" * 300),
    ])
    r = one(op.exec_summary(runs, at()))
    assert (r["runs_total"], r["success_runs"], r["warning_runs"], r["error_runs"]) == (3, 1, 1, 1)
    assert (r["latest_status"], len(r["latest_error"])) == ("ERROR", 240)


def log_df(spark, rows):
    full = [(i, i, c, None, s, ts, None, m, None) for i, c, s, ts, m in rows]
    return spark.createDataFrame(
        full, "mstr_log_id bigint, log_id bigint, log_categ string, mstr_fun string, log_status string, "
        "start_date timestamp_ntz, end_date timestamp_ntz, log_msg string, last_err_code string")


def test_latest_summaries(spark):
    text = f"x{SUMMARY_BEGIN}\n  body {{}} \n{SUMMARY_END}y"
    log = log_df(spark, [
        (1, "ARCHIVE", "SUCCESS", T0, text.format("old")),
        (2, "ARCHIVE", "SUCCESS", T0, text.format("new")),
        (3, "QUALITY", "SUCCESS", T0, f"{SUMMARY_BEGIN}{SUMMARY_END}"),
        (4, "TRUNCATE", "SUCCESS", T0, f"{SUMMARY_BEGIN} \n {SUMMARY_END}"),
        (5, "RUNNER", "SUCCESS", T0, f"{SUMMARY_END}{SUMMARY_BEGIN}"),
        (6, "DISCOVER", "SUCCESS", T0 - timedelta(days=8), text.format("late")),
    ])
    found = {r["run_type"]: (r["latest_status"], r["summary_text"]) for r in op.latest_summaries(log, at()).collect()}
    none = "No summary available"
    assert found == {
        "DISCOVER": ("N/A", none), "ARCHIVE": ("SUCCESS", "body new"), "QUALITY": ("N/A", none),
        "TRUNCATE": ("SUCCESS", none), "RUNNER": ("N/A", none),
    }
    capped = {r["run_type"]: r["summary_text"] for r in op.latest_summaries(log, at(), max_chars=7).collect()}
    assert capped["ARCHIVE"] == "body"
    assert one(op.latest_summary(log, " discover "))["summary_text"] == "body late"
    assert one(op.latest_summary(log, "RUNNER"))["summary_text"] is None
    assert op.latest_summary(log.filter("false"), "RUNNER").count() == 0
    with pytest.raises(ValueError):
        op.latest_summary(log, "PURGE")
    with pytest.raises(ValueError):
        op.latest_summary(log, "TRUNCATE", REPLICA)


def test_recent_issues(spark):
    runs = runs_df(spark, [(i, "ARCHIVE", "ERROR", T0 - timedelta(hours=i), "Y", None) for i in range(15)])
    log = log_df(spark, [(i, "QUALITY", "warning", T0 - timedelta(hours=i), "m" * 400) for i in range(15)])
    rows = op.recent_issues(runs, log, at()).collect()
    assert len(rows) == 20 and rows[0]["issue_time"] == "2024-01-31 10:00:00"
    assert {r["source_name"] for r in rows} == {"RUN ARCHIVE", "QUALITY"}
    assert {len(r["message_text"]) for r in rows if r["source_name"] == "QUALITY"} == {300}
    assert {r["message_text"] for r in rows if r["source_name"] == "RUN ARCHIVE"} == {"O.T"}


def test_expired_months(spark):
    starts = [(datetime(2018, 12, 31),), (datetime(2023, 9, 30, 23),), (datetime(2023, 10, 1),), (datetime(2023, 11, 2),)]
    log = spark.createDataFrame(starts, "start_date timestamp_ntz")
    months = lambda day: sorted(
        str(r["log_month"]) for r in op.expired_log_partitions(log, F.lit(day).cast("timestamp_ntz"), -31).collect()
    )
    assert months("2023-11-01 00:00:00") == []
    assert months("2023-11-01 00:00:01") == ["2023-09-01"]
    assert months("2024-01-01 00:00:00") == ["2023-09-01", "2023-10-01"]


def test_pending_and_status_reports(spark):
    units = ledger(spark, ["2024-01-01"], "YYY", "done").unionByName(ledger(spark, ["2024-01-01"], "YNN", "open"))
    units = units.withColumn("error_message", F.lit("").cast("string"))
    pending = op.pending_work(units).collect()
    assert [(r["source_table"], r["pending_archive"], r["pending_quality"], r["truncate_candidates"],
             r["units_with_error"]) for r in pending] == [("open", 0, 1, 0, 0)]
    status = {r["target_table"]: r for r in op.data_status(units).collect()}
    assert (status["done_A"]["truncated_units"], status["open_A"]["quality_pending"]) == (1, 1)


def test_violations(spark):
    good = ledger(spark, ["2024-01-01"], "YYN").withColumns(
        {"last_run_id": F.lit(1).cast("long"), "source_subpartition_name": F.lit("#")}
    )
    cfg = config(spark)
    runs = runs_df(spark, [(1, "ARCHIVE", "SUCCESS", T0, "Y", None)])
    assert op.ledger_violations(good, cfg, runs).count() == 0
    bad = good.unionByName(good).withColumns({"archive_status": F.lit(None).cast("string"), "last_run_id": F.lit(9).cast("long")})
    broken = op.ledger_violations(bad, config(spark, table="X", link="none"), runs.withColumn("run_type", F.lit("PURGE")))
    found = {r["constraint_name"]: r["n"] for r in broken.collect()}
    assert found == {
        "archive_status_flag": 2, "unit_key": 2, "unit_target_key": 2, "unit_config_reference": 2,
        "unit_run_reference": 2, "run_config_reference": 1, "run_type": 1, "config_source_link": 1,
    }
    two = config(spark, days=-1).unionByName(config(spark, table="Y", link="M"))
    replica = ledger(spark, ["2024-01-01"], "NNN", layer=REPLICA).withColumns(
        {"last_run_id": F.lit(None).cast("long"), "source_subpartition_name": F.lit("#")}
    )
    found = {r["constraint_name"] for r in op.ledger_violations(replica, two, runs.filter("false"), REPLICA).collect()}
    assert found == {"config_days_online", "single_source_link"}


def test_summary_and_counters(spark):
    units = ledger(spark, ["2024-01-01", "2024-02-01"], "YNN").withColumns(
        {"source_partition_name": F.lit("P"), "source_subpartition_name": F.lit("#"), "source_rows": F.lit(None).cast("long"),
         "preserve_date": F.when(F.col("partition_hv") == "2024-01-01", F.lit("2023-12-31").cast("date"))}
    )
    rows = op.step_summary(units, "TRUNCATE", ARCHIVE, True).collect()
    assert [r["note"] for r in rows] == ["PRESERVED per MAX_preserve_date=2023-12-31", "TRUNCATED"]
    assert rows[0]["source_rows"] == "-" and rows[0]["subpartition_name"] == "-" and rows[1]["max_preserve_date"] == "-"
    assert len(rows[0]) == len(SOURCE) + 13
    totals = one(op.step_counters(units, "TRUNCATE", ARCHIVE, True))
    assert (totals["units"], totals["preserved"], totals["done"], totals["run_status"]) == (2, 1, 1, "SUCCESS")
    totals = one(op.step_counters(units, "QUALITY"))
    assert (totals["ok"], totals["failed"], totals["run_status"]) == (0, 2, "WARNING")
    with pytest.raises(ValueError):
        op.step_counters(units, "PURGE", ARCHIVE)


def test_appends_side_by_side_lose_nothing(spark):
    name = scratch_name(spark, "events")
    for_each_table(spark, lambda i: append_state(spark.range(i * 10, i * 10 + 10), name), range(6), at_once=6)
    assert sorted(r["id"] for r in spark.table(name).collect()) == list(range(60))
    assert spark.table(name).select("batch").distinct().count() == 6


def test_a_table_that_would_lose_partitions_is_refused(spark):
    name = scratch_name(spark, "plain")
    rows = fx.orders(spark, "CLIENT1", "ORDERS_ARCH_SRC")
    units = fx.catalog(spark, "CLIENT1", "ORDERS_ARCH_SRC")
    op.assign_units(rows, units, "order_date").write.partitionBy("partition_hv", "subpartition_hv").saveAsTable(name)
    with pytest.raises(ValueError, match="partitionOverwriteMode"):
        op.load_units(rows, units, name, "order_date")
    other = scratch_name(spark, "narrow")
    create_table(spark, other, rows.drop("amount").schema, ["partition_hv", "subpartition_hv"])
    with pytest.raises(ValueError, match="columns differ"):
        op.load_units(rows, units, other, "order_date")


def test_runs_are_folded_in_all_shuffle_partitions(spark):
    """Few events are no reason to fold all runs in one task: the number of tasks does not hang on their bytes."""
    columns = "run_id long, run_type string, run_status string, source_link string, source_owner string, source_table string, mstr_log_id long, "
    columns += "started_at timestamp_ntz, ended_at timestamp_ntz, execute_flag string, error_message string, event_ts timestamp_ntz, seq int"
    rows = [(i, "archive", "RUNNING", "a", "b", "c", i, None, None, "Y", None, None, 0) for i in range(50)]
    runs = op.current_runs(spark.createDataFrame(rows, columns))
    assert runs.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions")) and runs.count() == 50
