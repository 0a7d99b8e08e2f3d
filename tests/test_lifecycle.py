"""Whole runs on the demo tables, with the expected outcome of a first run."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators.state import ledger_seed
from sliceward.plans import ArchiveLifecycle, Binding, ReplicaLifecycle
from sliceward.schema import ARCHIVE, REPLICA
from sliceward.sources import SourceSpec, scratch_database, scratch_name, settle
from tests import fixtures as fx

NOW = datetime(2026, 6, 1, 8, 0, 0)
TABLES = ["ORDERS_ARCH_SRC", "ORDERS_SUBPART_SRC", "ORDERS_DAILY_INT_SRC"]


def seed(life, units):
    """The P_ERROR units are in the ledger as finished from the start."""
    life.append_units(ledger_seed(units, life.layer, 0, F.lit("2026-05-01 00:00:00").cast("timestamp_ntz")))


class World:
    def __init__(self, spark, clients=("CLIENT1",), tables=TABLES):
        self.spark = spark
        database = scratch_name(spark, "db").replace(".", "_")
        folder = spark.catalog.getDatabase(scratch_database(spark)).locationUri
        spark.sql(f"CREATE DATABASE {database} LOCATION '{folder}/{database}'")
        self.catalogs = {(c, t): fx.catalog(spark, c, t) for c in clients for t in tables}
        targets = [f"{c}_{fx.TARGETS[t]}" for c, t in self.catalogs]
        self.config = fx.config(spark).filter(F.col("target_table").isin(targets))
        self.bindings, replicas = {}, {}
        for (client, table), units in self.catalogs.items():
            rows = fx.orders(spark, client, table)
            key, list_col = "order_date", fx.list_column(table)
            name = f"{client}_{fx.TARGETS[table]}"
            store, target, replica = (f"{database}.{name.lower()}_{x}" for x in ("src", "arch", "repl"))
            for t in (store, target, replica):
                op.create_unit_table(rows, t)
            op.load_units(rows, units, store, key, list_col)
            cluster = ("customer_id", "order_date")
            self.bindings[("ARCH", name)] = Binding(SourceSpec("table", store), target, key, list_col, cluster, store)
            replicas[("REPLICA", f"{name}_R")] = Binding(SourceSpec("table", target), replica, key, list_col, cluster)
        self.replicas = replicas
        self.rules = fx.rules()
        self.archive = ArchiveLifecycle(
            spark, database, self.config, self.bindings, lambda: NOW,
            catalog=self.catalog, rules=lambda: op.rule_rows(spark, self.rules),
        )
        replica_config = fx.replica_config(spark).filter(F.col("source_table").isin(targets))
        self.replica = ReplicaLifecycle(
            spark, database, replica_config, replicas, lambda: NOW, archive_ledger=lambda: self.archive.ledger()
        )
        errors = op.source_units(self.config, self.catalog()).filter("partition_name = 'P_ERROR'")
        seed(self.archive, errors)

    def catalog(self):
        parts = list(self.catalogs.values())
        rows = parts[0]
        for p in parts[1:]:
            rows = rows.unionByName(p)
        return rows

    def per_table(self, df):
        return {r["target_table"]: r["count"] for r in df.groupBy("target_table").count().collect()}


@pytest.fixture(scope="module")
def world(spark):
    return World(spark)


def by_table(orders, subpart, daily, suffix=""):
    counts = {"CLIENT1_ORDERS": orders, "CLIENT1_SUBPART": subpart, "CLIENT1_DAILY_INT": daily}
    return {k + suffix: v for k, v in counts.items() if v}


def test_first_archive_run(world, spark):
    life = world.archive
    preview = life.run_all(stop_after="TRUNCATE")
    assert list(preview) == list(ARCHIVE.steps) and preview["DISCOVER"].count() == 38
    assert world.per_table(life.ledger()) == by_table(1, 2, 2)

    steps = life.run_all(execute=True, stop_after="truncate")
    ledger = settle(life.ledger(), "after_archive")
    assert world.per_table(ledger) == by_table(11, 22, 10)
    fresh = ledger.filter("partition_name <> 'P_ERROR'")
    loaded = fresh.filter("archive_status = 'Y'")
    assert world.per_table(loaded) == by_table(9, 18, 8)
    assert loaded.filter("quality_status <> 'Y' OR source_rows <> target_rows OR source_rows IS NULL").count() == 0
    assert fresh.filter("archive_status = 'N'").select("partition_name").distinct().collect()[0][0] == "P202605"
    notes = {r["note"]: r["count"] for r in steps["TRUNCATE"].groupBy("note").count().collect()}
    assert notes == {"SKIP": 30, "PRESERVED per MAX_preserve_date=2025-12-31": 3, "PRESERVED per MAX_preserve_date=2026-01-01": 2}
    assert ledger.filter("truncate_status = 'Y'").count() == 5
    store = world.bindings[("ARCH", "CLIENT1_ORDERS")]
    assert spark.table(store.target).count() == 399 and spark.table(store.source_store).count() == 430
    assert op.ledger_violations(ledger.filter("last_run_id > 0"), world.config, life.runs()).count() == 0
    # The log of the last step can be read back as its summary.
    runs = life.runs()
    assert {r["run_status"] for r in runs.collect()} == {"SUCCESS"}
    text = op.latest_summary(life.log(), "TRUNCATE").first()["summary_text"]
    lines = text.split("\n")
    assert lines[0].startswith("SOURCE_LINK|") and len(lines) == 36
    assert lines[1:] == sorted(lines[1:], key=lambda x: x.split("|")[:3] + [x.split("|")[8], x.split("|")[9]])


def test_report_after_the_run(world):
    report = world.archive.report(datetime(2026, 6, 2))
    counts = {name: df.count() for name, df in report.items()}
    assert counts == {"window": 1, "exec_summary": 1, "process_summary": 5, "latest_summaries": 5, "data_status": 3,
                      "pending_work": 3, "recent_issues": 0}
    assert report["exec_summary"].first()["runs_total"] == 10
    texts = {r["run_type"]: r["summary_text"] for r in report["latest_summaries"].collect()}
    assert "EXCHANGED" in texts["ARCHIVE"] and texts["RUNNER"] == "No summary available"
    assert world.archive.log(datetime(2026, 6, 1, 9)).count() == 0
    assert world.archive.report(datetime(2026, 7, 2))["exec_summary"].first()["runs_total"] == 0


def test_targets_missing_a_list_stop_the_discovery(world, spark):
    life = ArchiveLifecycle(
        spark, scratch_database(spark), world.config, world.bindings, lambda: NOW, catalog=world.catalog,
        target_template=lambda: spark.createDataFrame(
            [("ARCH", "CLIENT1_SUBPART", "T_OPEN", fx.OPEN)],
            "target_owner string, target_table string, subpartition_name string, list_values array<string>",
        ),
    )
    with pytest.raises(ValueError, match="not found by list value"):
        life.discover(execute=True)
    assert life.ledger().count() == 0 and life.runs().first()["run_status"] == "ERROR"


def test_first_replica_run(world, spark):
    replica = world.replica
    errors = replica._found_units().filter("partition_name = 'P_ERROR'")
    seed(replica, errors)
    replica.run_all(execute=True)
    ledger = settle(replica.ledger(), "after_replica").filter("partition_name <> 'P_ERROR'")
    assert world.per_table(ledger) == by_table(9, 18, 8, "_R")
    assert world.per_table(ledger.filter("replica_status = 'Y'")) == by_table(5, 10, 8, "_R")
    assert ledger.filter("replica_status = 'Y' AND (quality_status <> 'Y' OR source_rows <> target_rows)").count() == 0
    assert ledger.filter("purge_status = 'Y'").count() == 0
    assert spark.table(world.replicas[("REPLICA", "CLIENT1_ORDERS_R")].target).count() == 149
    assert {r["run_type"] for r in replica.runs().collect()} == {*REPLICA.steps, "RUNNER"}


def test_executed_truncate_keeps_preserved_units(world, spark):
    world.archive.cleanup(execute=True)
    ledger = world.archive.ledger().filter("partition_name <> 'P_ERROR'")
    assert world.per_table(ledger.filter("truncate_status = 'Y'")) == by_table(8, 14, 8)
    binding = world.bindings[("ARCH", "CLIENT1_ORDERS")]
    # What is left: the preserved December, and May, which is not archived yet.
    assert spark.table(binding.source_store).count() == 30 + 31
    assert spark.table(binding.target).count() == 399
    again = world.archive.cleanup(execute=True)
    assert again.count() == 5 and again.filter("note NOT LIKE 'PRESERVED%'").count() == 0


def test_purge_of_a_smaller_window(world, spark):
    smaller = ReplicaLifecycle(
        spark, world.replica.unit_events_table.split(".")[0], world.replica.config.withColumn("days_online", F.lit(60)),
        world.replicas, lambda: NOW, archive_ledger=world.archive.ledger,
    )
    preview = smaller.cleanup()
    assert {r["note"] for r in preview.collect()} == {"PREVIEW"}
    smaller.cleanup(execute=True)
    ledger = smaller.ledger().filter("partition_name <> 'P_ERROR'")
    assert world.per_table(ledger.filter("purge_status = 'Y'")) == by_table(3, 6, 0, "_R")
    assert spark.table(world.replicas[("REPLICA", "CLIENT1_ORDERS_R")].target).count() == 31 + 30


def test_log_retention(world):
    life = world.archive
    assert life.cleanup_log(datetime(2026, 9, 28), 90, execute=True).count() == 0
    before = life.log_events().count()
    assert before > 0 and life.cleanup_log(datetime(2026, 9, 30), 90).count() == 1
    assert life.log_events().count() == before
    life.cleanup_log(datetime(2026, 9, 30), 90, execute=True)
    assert life.log_events().count() == 0


def test_stop_steps_mismatch_and_bad_rule(spark):
    world = World(spark, tables=["ORDERS_ARCH_SRC"])
    life = world.archive
    with pytest.raises(ValueError):
        life.run_all(stop_after="PURGE")
    assert list(life.run_table("src_link", "client1", "orders_arch_src", True, "discover")) == ["DISCOVER"]
    assert list(life.run_table("SRC_LINK", "CLIENT1", "ORDERS_ARCH_SRC", True, "ARCHIVE")) == ["DISCOVER", "ARCHIVE"]
    with pytest.raises(ValueError, match="no enabled table"):
        life.run_table("SRC_LINK", "CLIENT1", "NOTHING", True)

    # The source changes after the load: quality stays N, the load stays Y, the run is a warning.
    binding = world.bindings[("ARCH", "CLIENT1_ORDERS")]
    march = settle(world.catalog().filter("partition_name = 'P202403'"), "march")
    rows = fx.orders(spark, "CLIENT1", "ORDERS_ARCH_SRC").filter("order_id % 5 <> 0")
    op.load_units(rows, march, binding.source_store, "order_date")
    done = life.run_all(execute=True)
    assert list(done) == ["DISCOVER", "ARCHIVE", "QUALITY"]
    assert {r["note"] for r in done["QUALITY"].collect()} == {"OK", "MISMATCH"}
    # It is looked at again in every run.
    assert [r["note"] for r in life.quality(execute=True).collect()] == ["MISMATCH"]
    unit = life.ledger().filter("partition_name = 'P202403'").first()
    assert (unit["archive_status"], unit["quality_status"], unit["target_rows"]) == ("Y", "N", 62)
    assert unit["source_rows"] < 62 and unit["error_message"].startswith("Source row count")
    assert life.runs().filter("run_type = 'QUALITY' AND run_status = 'WARNING'").count() == 2
    assert life.runs().filter("run_type = 'RUNNER' AND run_status = 'SUCCESS'").count() == 3

    world.rules[("ARCH", "CLIENT1_ORDERS")] = "SELECT nothing"
    with pytest.raises(ValueError, match="no usable result"):
        life.run_all(execute=True, stop_after="TRUNCATE", cleanup_execute=True)
    failed = life.runs().filter("run_status = 'ERROR'").collect()
    assert {r["run_type"] for r in failed} == {"TRUNCATE", "RUNNER"}
    assert all("no usable result" in r["error_message"] for r in failed)
    issues = op.recent_issues(life.runs(), life.log(), F.lit("2026-06-02 00:00:00").cast("timestamp_ntz"))
    assert issues.filter("status_name = 'ERROR'").count() == 4
    assert spark.table(binding.source_store).count() > 400


def executed_rules(world, rules: dict[str, str]):
    """Let the lifecycle execute the rules of its config."""
    life = world.archive
    life.rules = None
    rule = F.coalesce(*[F.when(F.col("target_table") == t, F.lit(r)) for t, r in rules.items()], F.lit(None).cast("string"))
    life.config = world.config.withColumn("preserve_rule", rule)
    return life


def test_configured_rule_without_result_stops_the_cleanup(spark):
    world = World(spark, clients=["CLIENT1"], tables=["ORDERS_ARCH_SRC"])
    life, store = world.archive, world.bindings[("ARCH", "CLIENT1_ORDERS")].source_store
    life.run_all(execute=True)
    rows = spark.table(store).count()
    life.rules = None
    with pytest.raises(ValueError, match="no usable result"):
        life.cleanup(execute=True)
    life.rules = lambda: op.rule_rows(spark, {})
    with pytest.raises(ValueError, match="no usable result"):
        life.cleanup(execute=True)
    assert spark.table(store).count() == rows

    executed_rules(world, {"CLIENT1_ORDERS": "SELECT DATE'2025-12-31'"}).cleanup(execute=True)
    assert spark.table(store).filter("partition_hv = '2026-01-01'").count() > 0
    assert spark.table(store).count() < rows


def test_failing_rule_of_another_table_does_not_matter(spark):
    world = World(spark, clients=["CLIENT1", "CLIENT2"], tables=["ORDERS_ARCH_SRC"])
    life = executed_rules(
        world,
        {
            "CLIENT1_ORDERS": "SELECT CAST(concat('no day ', id) AS DATE) FROM range(2)",
            "CLIENT2_ORDERS": "SELECT DATE'2025-12-31' WHERE false",
        },
    )
    life.run_all(execute=True)
    with pytest.raises(ValueError, match="no usable result"):
        life.cleanup(execute=True)
    life.cleanup(execute=True, target_owner="ARCH", target_table="CLIENT2_ORDERS")
    stores = [world.bindings[("ARCH", f"CLIENT{i}_ORDERS")].source_store for i in (1, 2)]
    assert spark.table(stores[0]).filter("partition_hv = '2026-01-01'").count() > 0
    assert spark.table(stores[1]).filter("partition_hv = '2026-01-01'").count() == 0


def test_row_in_a_unit_it_does_not_belong_to_is_a_mismatch(spark):
    """The source is counted as it lies: what a cleanup would remove must be what was archived."""
    world = World(spark, clients=["CLIENT1"], tables=["ORDERS_ARCH_SRC"])
    life, store = executed_rules(world, {}), world.bindings[("ARCH", "CLIENT1_ORDERS")].source_store
    life.run_all(execute=True, stop_after="ARCHIVE")
    table = spark.table(store)
    march = life.ledger().filter("partition_name = 'P202403'").first()
    stray = settle(table.filter("order_date < DATE'2024-03-01'").limit(1), "stray")
    placed = stray.withColumns({c: F.lit(march[c]) for c in ("partition_hv", "subpartition_hv")})
    placed.select(*table.columns).write.insertInto(store)
    spark.catalog.refreshTable(store)
    notes = {r["partition_name"]: r["note"] for r in life.quality(execute=True).collect()}
    assert notes["P202403"] == "MISMATCH" and set(notes.values()) == {"OK", "MISMATCH"}
    life.cleanup(execute=True)
    found = spark.table(store).filter(F.col("partition_hv") == march["partition_hv"])
    assert found.filter(F.col("order_id") == stray.first()["order_id"]).count() == 1


def test_error_texts_are_stored_whole(spark):
    world = World(spark, clients=["CLIENT1"], tables=["ORDERS_ARCH_SRC"])
    life, text = world.archive, "x" * 10_000
    with pytest.raises(RuntimeError), life._run("DISCOVER", True):
        raise RuntimeError(text)
    assert life.run_events().filter(F.col("error_message") == text).count() == 1
    assert life.log_events().filter(F.col("last_err_desc") == text).count() == 1
    assert len(life.runs().first()["error_message"]) == 4000


def test_cut_report_sections_tell_their_size(spark):
    rows = [(i, "DISCOVER", "SUCCESS", datetime(2026, 6, 1, 1), datetime(2026, 6, 1, 2)) for i in range(5)]
    runs = spark.createDataFrame(rows, "run_id long, run_type string, run_status string, started_at timestamp_ntz, ended_at timestamp_ntz")
    world = World(spark, clients=["CLIENT1"], tables=["ORDERS_ARCH_SRC"])
    world.archive.run_all(execute=True)
    report = op.report_sections(
        world.archive.runs(), world.archive.log(), world.archive.ledger(), F.lit("2026-06-02 00:00:00").cast("timestamp_ntz"), max_rows=1
    )
    totals = {name: (df.count(), df.first()["rows_total"] if df.count() else 0) for name, df in report.items()}
    assert runs.count() == 5 and totals["process_summary"][0] == 1 < totals["process_summary"][1]


def test_replica_run_needs_one_link(spark):
    cfg = fx.replica_config(spark).withColumn("source_link", F.col("source_table"))
    life = ReplicaLifecycle(spark, scratch_database(spark), cfg, {}, lambda: NOW, archive_ledger=lambda: None)
    with pytest.raises(ValueError, match="exactly one"):
        life.run_all()
