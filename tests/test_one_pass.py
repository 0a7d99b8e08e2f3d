"""How often a load reads its source, what a clustered load cuts, flat sources, compaction and business dates."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators import movement
from sliceward.plans import Binding
from sliceward.schema import ARCHIVE
from sliceward.sources import SourceSpec, append_state, compact_state, scratch_name, settle
from tests import fixtures as fx
from tests.test_lifecycle import World, executed_rules

TABLE = "ORDERS_SUBPART_SRC"


def counting(spark, rows):
    """The rows, and how many of them have left the source so far."""
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return rows.mapInArrow(watch, rows.schema), seen


@pytest.mark.parametrize(("cluster_by", "passes"), [((), 1), (("customer_id", "order_date"), 2)])
def test_a_load_reads_its_source_once_and_its_keys_once_more(spark, cluster_by, passes):
    """Also when the target is full, and when some units get no row any more."""
    rows, units = fx.orders(spark, "CLIENT1", TABLE), fx.catalog(spark, "CLIENT1", TABLE)
    name = scratch_name(spark, "target")
    op.create_unit_table(rows, name)
    stored = settle(rows, "orders")
    for part in (stored, stored, stored.filter("order_date >= '2024-03-01'")):
        source, seen = counting(spark, part)
        counts = op.load_units(source, units, name, "order_date", "status_code", cluster_by)
        held = {tuple(r) for r in op.stored_row_counts(spark.table(name), units).collect()}
        assert {tuple(r) for r in counts.collect()} == held
        assert seen.value == passes * part.count()
    assert spark.table(name).count() == 540 - 108 - 87


def test_a_hot_unit_is_cut_by_value(spark):
    """A unit with nearly all rows lies in many files; no two of them share a range, nulls included."""
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 50 == 0, F.lit("2024-03-05")).otherwise("2024-02-05").cast("date").alias("order_date"),
        F.when(F.col("id") % 1000 != 0, F.col("id") * 7919 % 60_000).alias("a"),
        F.sha2(F.col("id").cast("string"), 256).alias("b"),
    )
    units, name = fx.catalog(spark, "CLIENT1", "ORDERS_ARCH_SRC"), scratch_name(spark, "hot")
    op.create_unit_table(rows, name)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        op.load_units(rows.repartition(6), units, name, "order_date", cluster_by=("a", "b"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    at = F.struct(F.coalesce("a", F.lit(-1)).alias("a"), "b")
    files = spark.table(name).groupBy("partition_hv", "_metadata.file_path").agg(F.min(at).alias("first"), F.max(at).alias("last"), F.count("*").alias("n"))
    held: dict = {}
    for r in files.orderBy("first").collect():
        held.setdefault(r["partition_hv"], []).append(r)
    assert len(held["2024-03-01"]) > 30 and max(r["n"] for r in held["2024-03-01"]) < 4_000
    assert sum(r["n"] for rs in held.values() for r in rs) == 60_000
    for rs in held.values():
        assert all(a["last"] < b["first"] for a, b in zip(rs, rs[1:], strict=False))


def flat(spark):
    rows, units = fx.orders(spark, "CLIENT1", TABLE), fx.catalog(spark, "CLIENT1", TABLE)
    name = scratch_name(spark, "flat")
    rows.write.format("parquet").saveAsTable(name)
    early = settle(units.filter("partition_name IN ('P202401', 'P202402')"), "early")
    return name, rows, early


def test_flat_source_is_switched_as_a_whole(spark, monkeypatch):
    name, rows, early = flat(spark)
    whole = sorted(map(tuple, rows.collect()))
    counts = op.truncate_flat_source(name, early, "order_date", "status_code")
    assert counts.agg(F.sum("n")).first()[0] == 108 + 87 and spark.table(name).count() == 540

    def broken(*_):
        raise RuntimeError("broken before the switch")

    with monkeypatch.context() as m:
        m.setattr(movement, "_switch_location", broken)
        with pytest.raises(RuntimeError):
            op.truncate_flat_source(name, early, "order_date", "status_code", execute=True)
    spark.catalog.refreshTable(name)
    assert sorted(map(tuple, spark.table(name).collect())) == whole
    op.truncate_flat_source(name, early, "order_date", "status_code", execute=True)
    assert sorted(map(tuple, spark.table(name).collect())) == [r for r in whole if r[rows.columns.index("order_date")] >= date(2024, 3, 1)]
    again = op.truncate_flat_source(name, early, "order_date", "status_code", execute=True)
    assert again.agg(F.sum("n")).first()[0] == 0 and spark.table(name).count() == 540 - 108 - 87


def test_flat_source_that_changes_meanwhile_is_left_alone(spark, monkeypatch):
    name, rows, early = flat(spark)
    outside = movement.rows_outside
    monkeypatch.setattr(movement, "rows_outside", lambda *a, **k: outside(*a, **k).limit(5))
    with pytest.raises(ValueError, match="changed while"):
        op.truncate_flat_source(name, early, "order_date", "status_code", execute=True)
    assert spark.table(name).count() == 540


def test_partitioned_sources_are_refused(spark):
    name, rows, early = flat(spark)
    other = scratch_name(spark, "other")
    rows.write.partitionBy("status_code").saveAsTable(other)
    with pytest.raises(ValueError, match="other columns"):
        op.truncate_flat_source(other, early, "order_date", "status_code")
    by_unit = scratch_name(spark, "by_unit")
    op.create_unit_table(rows, by_unit)
    with pytest.raises(ValueError, match="laid out by unit"):
        op.truncate_flat_source(by_unit, early, "order_date", "status_code")


def test_a_run_cleans_up_a_flat_source_with_dates_from_text(spark):
    """The source is one flat table; the business date is a subquery; a preserve rule keeps December 2025."""
    world = World(spark, tables=["ORDERS_ARCH_SRC"])
    key = ("ARCH", "CLIENT1_ORDERS")
    store = scratch_name(spark, "flat_store")
    fx.orders(spark, "CLIENT1", "ORDERS_ARCH_SRC").write.saveAsTable(store)
    total = spark.table(store).count()
    old = world.bindings[key]
    life = executed_rules(world, {"CLIENT1_ORDERS": "SELECT DATE'2025-12-31'"})
    life.bindings[key] = Binding(SourceSpec("table", store), old.target, old.key, old.list_col, old.cluster_by, store)
    day = world.config.first()["last_business_date"]
    life.config = life.config.withColumn("last_business_date", F.lit(f"SELECT max(d) FROM VALUES (DATE'{day}'), (DATE'2000-01-01') t(d)"))
    life.run_all(execute=True, stop_after="TRUNCATE", cleanup_execute=True)
    ledger = life.ledger()
    cleaned = ledger.filter("truncate_status = 'Y' AND partition_name <> 'P_ERROR'").agg(F.sum("source_rows")).first()[0]
    assert cleaned > 0 and spark.table(store).count() == total - cleaned
    assert ledger.filter("partition_hv = '2026-01-01'").first()["truncate_status"] == "N"

    life.config = life.config.withColumn("last_business_date", F.lit("SELECT no_such_column"))
    with pytest.raises(Exception, match="not a date"):
        life.run_all(execute=True)


def test_business_date_states(spark):
    texts = ["DATE'2024-01-02'", "SELECT current_date() WHERE false", "'no date'", "SELECT id FROM range(2)", "nothing(", None, "TIMESTAMP'2024-01-02 10:00:00'"]
    config = spark.createDataFrame(list(enumerate(texts)), "n int, last_business_date string")
    found = [(r["last_business_date"], r["business_date_state"]) for r in op.business_dates(config).orderBy("n").collect()]
    day = date(2024, 1, 2)
    assert found == [(day, "ROWS"), (None, "EMPTY"), (None, "EMPTY"), (None, "FAILED"), (None, "FAILED"), (None, "EMPTY"), (day, "ROWS")]


def ledger_of(spark, name):
    return sorted(map(repr, op.current_units(spark.table(name), ARCHIVE).collect()))


def test_compaction_keeps_the_fold_also_with_late_events(spark, monkeypatch):
    units = op.source_units(fx.config(spark), fx.catalog(spark, "CLIENT1", TABLE))
    name = scratch_name(spark, "events")
    at = lambda day: F.lit(f"2024-05-{day:02} 00:00:00").cast("timestamp_ntz")
    append_state(op.discover_events(units, ARCHIVE, 1, at(1)), name)
    for run in range(2, 9):
        append_state(op.mark_units(units, ARCHIVE, "N" if run % 2 else "Y", run, at(run), rows=F.lit(run)), name)
    before = ledger_of(spark, name)
    assert compact_state(spark, name, lambda e: op.deciding_unit_events(e, ARCHIVE)) == 8
    assert ledger_of(spark, name) == before and spark.sql(f"SHOW PARTITIONS {name}").count() == 1
    assert spark.table(name).count() <= 4 * units.count()

    # An event that was made earlier and comes later must not win where a newer one spoke.
    late = op.unit_events(units, ARCHIVE, 3, at(3), 9, quality_status=F.lit("Y"), target_rows=F.lit(99))
    plain = spark.table(name).drop("batch").unionByName(late)
    want = sorted(map(repr, op.current_units(plain, ARCHIVE).collect()))
    append_state(late, name)
    assert ledger_of(spark, name) == want

    # A break between the snapshot and the drop leaves events twice, which changes nothing.
    sql = type(spark).sql

    def broken(self, text, *args, **kwargs):
        if "DROP IF EXISTS" in text:
            raise RuntimeError("broken")
        return sql(self, text, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", broken)
        with pytest.raises(RuntimeError):
            compact_state(spark, name, lambda e: op.deciding_unit_events(e, ARCHIVE))
    spark.catalog.refreshTable(name)
    assert ledger_of(spark, name) == want
    compact_state(spark, name, lambda e: op.deciding_unit_events(e, ARCHIVE))
    assert ledger_of(spark, name) == want and spark.sql(f"SHOW PARTITIONS {name}").count() == 1


def test_runs_leave_a_bounded_number_of_batches(spark):
    world = World(spark, tables=["ORDERS_ARCH_SRC"])
    life = world.archive
    for i in range(4):
        life.run_all(execute=i == 0, stop_after="DISCOVER")
    ledger, runs = sorted(map(repr, life.ledger().collect())), sorted(map(repr, life.runs().collect()))
    life.compact(most_batches=1)
    assert sorted(map(repr, life.ledger().collect())) == ledger and sorted(map(repr, life.runs().collect())) == runs
    for table in (life.unit_events_table, life.run_events_table):
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 1
