"""Loading, replacing and cleaning up units."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.schema import HIGH_VALUES
from sliceward.sources import SourceSpec, read_source, scratch_name, settle
from tests import fixtures as fx


def held(spark, table, units):
    counts = op.stored_row_counts(spark.table(table), units).join(units, HIGH_VALUES)
    return {(r["partition_name"], r["subpartition_name"]): r["n"] for r in counts.collect()}


def load(spark, table="ORDERS_SUBPART_SRC", rows=None, units=None, name=None, cluster_by=()):
    rows = rows if rows is not None else fx.orders(spark, "CLIENT1", table)
    units = units if units is not None else fx.catalog(spark, "CLIENT1", table)
    if name is None:
        name = scratch_name(spark, "target")
        op.create_unit_table(rows, name)
    op.load_units(rows, units, name, "order_date", fx.list_column(table), cluster_by)
    return name, rows, units


def content(spark, table, columns):
    return sorted(tuple(r) for r in spark.table(table).select(*columns).collect())


def test_loading_twice_is_loading_once(spark):
    name, rows, units = load(spark, cluster_by=("customer_id", "order_date"))
    first = content(spark, name, rows.columns)
    assert first == sorted(tuple(r) for r in rows.collect())
    load(spark, rows=rows, units=units, name=name)
    assert content(spark, name, rows.columns) == first


def test_loading_some_units_leaves_the_others(spark):
    name, rows, units = load(spark)
    before = held(spark, name, units)
    march = settle(units.filter("partition_name = 'P202403' AND subpartition_name = 'SP_OPEN'"), "march")
    load(spark, rows=rows.filter("customer_id % 2 = 0"), units=march, name=name)
    after = held(spark, name, units)
    changed = {k for k in before if before[k] != after[k]}
    assert changed == {("P202403", "SP_OPEN")} and 0 < after[("P202403", "SP_OPEN")] < 47


def test_a_unit_without_rows_is_emptied(spark):
    name, rows, units = load(spark)
    load(spark, rows=rows.filter("order_date >= '2024-03-01'"), units=units, name=name)
    after = held(spark, name, units)
    assert after[("P202401", "SP_OPEN")] == after[("P202402", "SP_DONE")] == 0
    assert after[("P202403", "SP_OPEN")] == 47 and sum(after.values()) == 540 - 108 - 87


def test_replica_load_is_pruned_and_not_shuffled(spark):
    name, rows, units = load(spark)
    some = settle(units.filter("partition_name = 'P202404'"), "april")
    copy = scratch_name(spark, "copy")
    op.create_unit_table(spark.table(name), copy)
    counts = op.load_units(spark.table(name), some, copy, "order_date", "status_code")
    assert sorted(r["n"] for r in counts.collect()) == [36, 36]
    assert spark.table(copy).count() == 72
    plan = op.assign_units(spark.table(name), some, "order_date", "status_code")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text.lower()


def test_hot_unit_is_split_over_files(spark):
    """One unit with nearly all rows gives several files once it exceeds the advisory size."""
    hot = spark.range(400_000).select(
        F.col("id").alias("order_id"),
        F.when(F.col("id") % 50 == 0, F.lit("2024-03-05")).otherwise("2024-02-05").cast("date").alias("order_date"),
        F.sha2(F.col("id").cast("string"), 256).alias("noise"),
    )
    units = fx.catalog(spark, "CLIENT1", "ORDERS_ARCH_SRC")
    name = scratch_name(spark, "hot")
    op.create_unit_table(hot, name)
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        op.load_units(hot.repartition(8), units, name, "order_date")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = spark.table(name).groupBy("partition_hv").agg(F.countDistinct("_metadata.file_path").alias("files"), F.count("*").alias("n"))
    found = {r["partition_hv"]: (r["files"], r["n"]) for r in files.collect()}
    assert found["2024-03-01"][0] > 1 and found["2024-03-01"][1] == 392_000
    assert found["2024-04-01"][1] == 8_000


@pytest.mark.parametrize(("mode", "kept"), [(None, 24), ("delete", 24), (" Drop ", 22)])
def test_cleanup_modes(spark, mode, kept):
    name, _, units = load(spark)
    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(
        f"PARTITION (partition_hv='{r[0]}', subpartition_hv='{r[1]}')" for r in units.select(*HIGH_VALUES).collect()))
    january = units.filter("partition_name = 'P202401'")
    op.cleanup_units(name, january, mode)
    assert held(spark, name, units)[("P202401", "SP_OPEN")] == 54
    op.cleanup_units(name, january, mode, execute=True)
    after = held(spark, name, units)
    assert after[("P202401", "SP_OPEN")] == after[("P202401", "SP_DONE")] == 0
    assert sum(after.values()) == 540 - 108
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == kept


def test_cleanup_mode_is_checked(spark):
    with pytest.raises(ValueError):
        op.cleanup_units("t", fx.catalog(spark, "CLIENT1", "ORDERS_ARCH_SRC"), "VACUUM", execute=True)


def test_odd_list_values_survive_the_partition_path(spark):
    rows = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-05', \"it's\"), (2, DATE'2024-01-05', 'a,b=\\\\c') t(id, order_date, status_code)")
    names = [("X", ["it's"]), ("Y", ["a,b=\\c"])]
    groups = spark.createDataFrame([(fx.LINK, "C", "T", n, v) for n, v in names],
                                   "source_link string, source_owner string, source_table string, "
                                   "subpartition_name string, list_values array<string>")
    units = op.list_subunits(op.unit_catalog(fx.partitions(spark, "C", "T")), groups)
    units = settle(units, "odd_lists")
    name = scratch_name(spark, "odd")
    op.create_unit_table(rows, name)
    op.load_units(rows, units, name, "order_date", "status_code")
    assert {k: n for k, n in held(spark, name, units).items() if n} == {("P202401", "X"): 1, ("P202401", "Y"): 1}
    op.cleanup_units(name, units, "DROP", execute=True)
    assert spark.table(name).count() == 0 and spark.sql(f"SHOW PARTITIONS {name}").count() == 0


def test_targets_are_found_by_list(spark):
    units = op.source_units(fx.config(spark), fx.catalog(spark, "CLIENT1", "ORDERS_SUBPART_SRC"))
    template = spark.createDataFrame(
        [("ARCH", "CLIENT1_SUBPART", "T_OPEN", fx.OPEN)],
        "target_owner string, target_table string, subpartition_name string, list_values array<string>",
    )
    found = op.resolve_targets(units, template).select("subpartition_hv", "subpartition_name").distinct().collect()
    assert {tuple(r) for r in found} == {("NEW,PAID", "T_OPEN"), ("SHIPPED,CLOSED", None)}


def test_jdbc_source_must_be_split(spark):
    with pytest.raises(ValueError, match="one task"):
        read_source(spark, SourceSpec("jdbc", "orders", {"url": "jdbc:none"}))


def test_counting_some_units_lists_only_their_range(spark):
    name, _, units = load(spark, "ORDERS_ARCH_SRC")
    some = settle(units.filter("partition_name IN ('P202402', 'P202404')"), "some")
    counts = op.stored_row_counts(spark.table(name), some)
    assert sorted(r["n"] for r in counts.collect()) == [48, 58]
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert "partition_hv#" in text and ">= 2024-03-01" in text and "<= 2024-05-01" in text
    assert op.stored_row_counts(spark.table(name), some.filter("false")).count() == 0
    assert op.unit_row_counts(spark.table(name), some, "order_date").groupBy().sum("n").first()[0] == 106


def test_three_cleanups_shuffle_each_source_once(spark, monkeypatch):
    """The second and third load of a source come from the first, which is laid out by unit."""
    from querybook import spark_queries
    from sliceward.operators.assign import laid_out_by_unit

    told, load = [], spark_queries.op.load_units

    def seen(source, *rest):
        told.append(laid_out_by_unit(source))
        return load(source, *rest)

    monkeypatch.setattr(spark_queries.op, "load_units", seen)
    rows = spark_queries.QUERIES["cleanup_units"](spark, "/root/testdata/sf0.001").select("cleanup_mode").distinct().count()
    assert rows == 3 and sorted(told) == [False] * 3 + [True] * 6
