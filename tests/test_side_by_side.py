"""Two runs at a time, batches that would break the ledger, read partitions, and logs with many entries of one moment."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from threading import Barrier

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators.reports import SUMMARY_BEGIN, SUMMARY_END
from sliceward.plans import ArchiveLifecycle, lifecycle
from sliceward.schema import ARCHIVE
from sliceward.sources import SourceSpec, claim, read_source, release, scratch_database, settle
from tests import fixtures as fx
from tests.test_lifecycle import NOW, World


def test_one_claim_wins(spark):
    table = f"{scratch_database(spark)}.claims"
    barrier = Barrier(8)

    def ask(holder):
        barrier.wait()
        return claim(spark, table, "a.b", holder)

    with ThreadPoolExecutor(8) as pool:
        found = list(pool.map(inheritable_thread_target(spark)(ask), range(1, 9)))
    assert len({*found}) == 1 and found[0] in range(1, 9)
    assert claim(spark, table, "other", 99) == 99 and claim(spark, table, "a.b", 99) == found[0]
    release(spark, table, "a.b")
    assert claim(spark, table, "a.b", 99) == 99


def test_two_runs_load_every_unit_once(spark, monkeypatch):
    """Both find the same units due; each table is loaded by one of them, and the other says so."""
    world = World(spark, tables=["ORDERS_ARCH_SRC", "ORDERS_SUBPART_SRC"])
    first = world.archive
    first.run_all(execute=True, stop_after="DISCOVER")
    database = first.unit_events_table.rpartition(".")[0]
    second = ArchiveLifecycle(spark, database, world.config, world.bindings, lambda: NOW, catalog=world.catalog)
    barrier, loads = Barrier(2), []
    each, load = lifecycle.Lifecycle._each, op.load_units

    def together(self, units, work):
        barrier.wait()
        return each(self, units, work)

    def counted(source, units, target, *rest):
        loads.append((target, units.count()))
        return load(source, units, target, *rest)

    monkeypatch.setattr(lifecycle.Lifecycle, "_each", together)
    monkeypatch.setattr(op, "load_units", counted)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(inheritable_thread_target(spark)(lambda life: life.load(execute=True).collect()), (first, second)))
    monkeypatch.undo()
    loaded = [target for target, n in loads if n]
    assert sorted(loaded) == sorted({*loaded}) and len(loaded) == 2
    ledger = first.ledger().filter("partition_name <> 'P_ERROR'")
    assert {r["archive_status"] for r in ledger.filter("target_rows IS NOT NULL").collect()} == {"Y"}
    text = " ".join(r["log_msg"] for r in first.log().filter("log_categ = 'ARCHIVE'").collect())
    assert text.count("is claimed by run") + text.count("loaded by another run") == 2
    assert first.runs().filter("run_type = 'ARCHIVE' AND run_status = 'WARNING'").count() >= 1


def test_claim_of_a_run_that_broke_is_taken_over(spark):
    world = World(spark, tables=["ORDERS_ARCH_SRC"])
    life = world.archive
    life.run_all(execute=True, stop_after="DISCOVER")
    target = world.bindings[("ARCH", "CLIENT1_ORDERS")].target
    assert claim(spark, life.claims_table, target, 7) == 7
    life.load(execute=True)
    assert life.ledger().filter("archive_status = 'N' AND target_rows IS NULL AND partition_name = 'P202403'").count() == 0
    assert claim(spark, life.claims_table, target, 8) == 8


def test_a_bad_batch_leaves_the_ledger_alone(spark):
    world = World(spark, tables=["ORDERS_ARCH_SRC"])
    life = world.archive
    life.run_all(execute=True, stop_after="DISCOVER")
    before = life.unit_events().count()
    again = settle(op.discover_events(op.source_units(world.config, world.catalog()), ARCHIVE, 5, life._now()), "again")
    rejected = op.rejected_events(again, life.ledger(), world.config, life.runs())
    assert {r["constraint_name"] for r in rejected.collect()} == {"unit_key", "unit_run_reference"}
    with pytest.raises(ValueError, match="was not appended: unit_key"):
        op.require_valid(again, life.ledger(), world.config, life.runs())
    nobody = World(spark, tables=["ORDERS_ARCH_SRC"]).archive
    found = nobody._found_units
    nobody._found_units = lambda: found().withColumn("source_owner", F.lit("NOBODY"))
    with pytest.raises(ValueError, match="unit_config_reference|unit_target_key"):
        nobody.discover(execute=True)
    assert life.unit_events().count() == before
    assert nobody.ledger().filter("source_owner = 'NOBODY'").count() == 0
    empty = op.rejected_events(again.filter("false"), life.ledger(), world.config, life.runs())
    assert empty.count() == 0


@pytest.mark.parametrize("bins", [1, 3, 50])
def test_read_partitions_cover_every_unit_once(spark, bins):
    rows, units = fx.orders(spark, "CLIENT1", "ORDERS_SUBPART_SRC"), fx.catalog(spark, "CLIENT1", "ORDERS_SUBPART_SRC")
    counts = op.unit_row_counts(rows, units, "order_date", "status_code")
    found = op.source_predicates(units, counts, bins, "order_date", "status_code").collect()
    sizes = [r["n"] for r in found]
    assert sum(r["units"] for r in found) == units.count() and sum(sizes) == 540
    assert max(sizes) - min(sizes) <= counts.agg(F.max("n")).first()[0]
    read = [rows.filter(r["predicate"]).count() for r in found]
    assert read == sizes
    rows.createOrReplaceTempView("predicate_rows")
    spec = SourceSpec("table", "predicate_rows", predicates=tuple(r["predicate"] for r in found[:2]))
    assert read_source(spark, spec).count() == sum(sizes[:2])


def test_predicates_quote_their_values(spark):
    units = spark.createDataFrame([("MAXVALUE", "it's", None, None, ["it's", "b"])], "partition_hv string, subpartition_hv string, low date, high date, list_values array<string>")
    text = op.source_predicates(units, units.selectExpr("partition_hv", "subpartition_hv", "1 AS n"), 2, "d", "v").first()["predicate"]
    assert text == "(d IS NOT NULL AND v IN ('it''s', 'b'))"


def entries(spark, n, at="2024-05-01 00:00:00"):
    """A log with n entries of one moment, and one with a summary of its own."""
    ids = spark.range(n).withColumn("entry_key", F.lpad(F.col("id").cast("string"), 9, "0"))
    moment = F.lit(at).cast("timestamp_ntz")
    base = {
        "mstr_log_id": F.lit(1).cast("long"), "log_id": F.lit(1).cast("long"), "log_level": F.lit("N"), "log_type": F.lit("SUMMARY"),
        "log_categ": F.lit("ARCHIVE"), "mstr_fun": F.lit(None).cast("string"), "log_status": F.lit("SUCCESS"), "start_date": moment,
        "end_date": moment, "log_msg": F.concat(F.lit("row "), "entry_key"), "last_err_code": F.lit(None).cast("string"),
        "last_err_desc": F.lit(None).cast("string"), "event_ts": moment, "seq": F.lit(5),
    }
    return ids.withColumns(base).select(*base, "entry_key")


def test_entries_of_one_moment_are_joined_by_several_tasks(spark):
    n = 100_000
    log = op.consolidate_log(entries(spark, n).repartition(7))
    row = log.first()
    assert row["log_msg"] == "".join(f"row {i:09}\n" for i in range(n))
    dealt = entries(spark, n).repartitionByRange(4, "mstr_log_id", "log_id", "event_ts", "seq", "entry_key")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 2 and max(sizes) < 0.5 * n
    assert "rangepartitioning" in log._jdf.queryExecution().executedPlan().toString()


def test_latest_summary_builds_one_log(spark):
    old = entries(spark, 20).withColumn("log_msg", F.concat(F.lit(f"{SUMMARY_BEGIN}old"), "entry_key", F.lit(SUMMARY_END)))
    new = entries(spark, 3, "2024-06-01 00:00:00").withColumns({"log_id": F.lit(2).cast("long"), "mstr_log_id": F.lit(None).cast("long")})
    marks = F.when(F.col("entry_key") == "000000000", SUMMARY_BEGIN).when(F.col("entry_key") == "000000002", SUMMARY_END).otherwise("body")
    newest = entries(spark, 3, "2024-07-01 00:00:00").withColumn("log_id", F.lit(3).cast("long"))
    all_of = old.unionByName(new.withColumn("log_msg", marks)).unionByName(newest)
    for events in (all_of, old, newest):
        want = op.latest_summary(op.consolidate_log(events), "archive").collect()
        assert op.latest_summary_of(events, "archive").collect() == want
    found = op.latest_summary_of(all_of, " Archive ").first()
    assert found["log_id"] == 2 and found["start_date"] == datetime(2024, 6, 1) and "body" in found["summary_text"]
    with pytest.raises(ValueError):
        op.latest_summary_of(all_of, "nothing")
