"""Moving units between tables laid out by unit, and cleaning units up.

A table laid out by unit is a managed table partitioned by (partition_hv, subpartition_hv). Replacing a unit
is a partition overwrite; emptying or dropping one is partition DDL. Both can be repeated without harm, so a
step that was cut off is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceward.functions import subpartition_hv
from sliceward.operators.assign import assign_units, laid_out_by_unit, only_units, unit_extent
from sliceward.operators.counts import unit_row_counts, zero_filled
from sliceward.operators.state import unit_events
from sliceward.schema import HIGH_VALUES, NO_SUBPARTITION, PARTITION, TARGET, Layer
from sliceward.sources import check_columns, create_table, require_partition_overwrite, settle

# The cleanup modes of a unit.
CLEANUP_MODES = ("TRUNCATE", "DROP", "DELETE")
_DDL_BATCH = 500
#: Rows of the key sample for each range that a clustered write is cut into.
SAMPLE_PER_RANGE = 100


def create_unit_table(like: DataFrame, table: str) -> None:
    """An empty managed table with the columns of ``like``, laid out by unit."""
    create_table(like.sparkSession, table, like.schema, HIGH_VALUES)


def range_slots(rows: DataFrame, cluster_by: tuple[str, ...], ranges: int) -> DataFrame:
    """For every unit of ``rows`` the values of ``cluster_by`` that cut it, as many as its share of ``ranges`` asks for.

    The values come from a uniform sample of bounded size (SAMPLE_PER_RANGE rows for each range), taken in one pass that
    reads only the columns of the unit key and of ``cluster_by``.
    """
    noise = F.xxhash64(*HIGH_VALUES, *cluster_by, F.monotonically_increasing_id())
    sample = rows.select(*HIGH_VALUES, F.struct(*cluster_by).alias("at"), noise.alias("noise"))
    sample = settle(sample.orderBy("noise").limit(ranges * SAMPLE_PER_RANGE).drop("noise"), "key_sample")
    total = sample.count()
    pieces = F.greatest(F.lit(1), F.round(F.size("values") * ranges / max(total, 1))).cast("int")
    units = sample.groupBy(*HIGH_VALUES).agg(F.sort_array(F.collect_list("at")).alias("values")).withColumn("pieces", pieces)
    cuts = F.when(
        F.col("pieces") > 1,
        F.transform(F.sequence(F.lit(1), F.col("pieces") - 1), lambda i: F.get("values", (i * F.size("values") / F.col("pieces")).cast("int"))),
    )
    return units.select(*HIGH_VALUES, cuts.alias("__cuts")).filter("__cuts IS NOT NULL")


def dealt_by_range(rows: DataFrame, cluster_by: tuple[str, ...], ranges: int) -> DataFrame:
    """``rows`` in ``ranges`` partitions; each holds one range of ``cluster_by`` of a unit at most.

    A row's range is found among the cuts of its unit in two steps of about the square root of their number.
    """
    cuts = range_slots(rows, cluster_by, ranges)
    at = F.struct(*cluster_by)
    step = F.ceil(F.sqrt(F.size("__cuts"))).cast("int")

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= at))

    coarse = F.filter("__cuts", lambda _, i: (i + 1) % step == 0)
    before = passed(coarse) * step
    piece = F.when(F.col("__cuts").isNull(), 0).otherwise(before + passed(F.slice("__cuts", before + 1, step)))
    slot = F.pmod(F.xxhash64(*HIGH_VALUES), F.lit(ranges)).cast("int") + piece
    with_cuts = rows.join(F.broadcast(cuts), HIGH_VALUES, "left").withColumn("__slot", slot)
    return with_cuts.repartitionById(ranges, "__slot").drop("__cuts", "__slot")


def clustered_write(
    rows: DataFrame, table: str, cluster_by: tuple[str, ...] = (), units: int = 0, together: bool = False
) -> None:
    """Overwrite the units present in ``rows``, clustered so that file statistics prune on ``cluster_by``.

    With ``cluster_by`` rows are dealt by ranges of these columns within their unit, so a unit larger than a task is cut
    by value and its files hold disjoint ranges; the cuts take one more pass over the key columns. Without it the
    rebalance hint groups the rows of a unit, and adaptive execution splits a unit that is larger than the advisory
    partition size and joins small ones; with a shuffle partition per unit at least, few units share one. Rows that
    come from files of one unit each are already ``together`` and are not shuffled.
    """
    spark = rows.sparkSession
    require_partition_overwrite(spark, table)
    placed = rows.select(*spark.table(table).columns)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if not together and cluster_by:
        placed = dealt_by_range(placed, cluster_by, partitions).select(*placed.columns)
    elif not together:
        placed = placed.hint("rebalance", max(partitions, units), *HIGH_VALUES)
    placed.sortWithinPartitions(*HIGH_VALUES, *cluster_by).write.insertInto(table, overwrite=True)


def _files(table: str, units: DataFrame) -> DataFrame:
    """Rows of each file of the units, from footers and file names; stored."""
    named = units.sparkSession.table(table).select(*HIGH_VALUES, F.col("_metadata.file_path").alias("file"))
    held = only_units(named, units, unit_extent(units))
    return settle(held.groupBy(*HIGH_VALUES, "file").agg(F.count(F.lit(1)).alias("n")), "unit_files")


def swap_units(
    rows: DataFrame, table: str, units: DataFrame, cluster_by: tuple[str, ...] = (), together: bool = False
) -> DataFrame:
    """Make ``rows`` (with unit columns) the whole content of ``units`` in ``table``.

    A partition overwrite leaves a unit alone that has no row to write. What was written is read off the files: a unit
    that still has a file from before got no row, and is dropped. ``rows`` are so read once, whatever the table held
    before, and a source that changes meanwhile cannot make the write and the drop disagree. Returns the physical row
    counts afterwards.
    """
    spark = rows.sparkSession
    before = _files(table, units)
    clustered_write(rows, table, cluster_by, units.count(), together)
    spark.catalog.refreshTable(table)
    after = _files(table, units)
    emptied = settle(after.join(before.select("file"), "file", "left_semi").select(*HIGH_VALUES).distinct(), "emptied")
    drop_partitions(spark, table, (tuple(r) for r in emptied.toLocalIterator()))
    spark.catalog.refreshTable(table)
    counts = after.join(emptied, HIGH_VALUES, "left_anti").groupBy(*HIGH_VALUES).agg(F.sum("n").alias("n"))
    return zero_filled(units, counts)


def load_units(
    source: DataFrame,
    units: DataFrame,
    table: str,
    key: str,
    list_col: str | None = None,
    cluster_by: tuple[str, ...] = (),
) -> DataFrame:
    """M2, M3: load all ``units`` of one table in one pass over the source.

    Rows outside the units are left out. A source that is itself laid out by unit is pruned to the units and
    written without a shuffle. The result counts what can be read back per unit.
    """
    check_columns(source, source.sparkSession.table(table), HIGH_VALUES)
    rows = assign_units(source, units, key, list_col)
    return swap_units(rows, table, units, cluster_by, together=laid_out_by_unit(source))


def resolve_targets(units: DataFrame, template: DataFrame) -> DataFrame:
    """Target subpartition of each unit, found by its list bound; NULL when the target has none.

    template: target columns, subpartition_name, list_values.
    """
    by_list = template.select(
        *TARGET,
        subpartition_hv(F.col("list_values")).alias("subpartition_hv"),
        F.col("subpartition_name").alias("target_subpartition"),
    )
    resolved = F.when(F.col("unit_type") == PARTITION, F.lit(NO_SUBPARTITION)).otherwise(
        F.col("target_subpartition")
    )
    return (
        units.join(by_list, TARGET + ["subpartition_hv"], "left")
        .withColumn("subpartition_name", resolved)
        .drop("target_subpartition")
    )


def discover_events(units: DataFrame, layer: Layer, run_id: int, at: Column) -> DataFrame:
    """M1: first ledger event of newly found units, all statuses 'N'."""
    described = TARGET + ["unit_type", "low", "high", "list_values", "partition_name", "subpartition_name"]
    described += ["source_partition_name", "source_subpartition_name"]
    return unit_events(
        units,
        layer,
        run_id,
        at,
        **{c: F.col(c) for c in described},
        **{s: F.lit("N") for s in layer.statuses},
    )


def cleanup_events(units: DataFrame, layer: Layer, run_id: int, at: Column) -> DataFrame:
    """M6, M7: ledger events of units that were cleaned up."""
    return unit_events(units, layer, run_id, at, **{layer.cleanup_status: F.lit("Y")})


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_spec(columns: list[str], values: tuple[str, ...]) -> str:
    return "PARTITION (" + ", ".join(f"{c} = {_literal(v)}" for c, v in zip(columns, values)) + ")"


def drop_partitions(
    spark: SparkSession,
    table: str,
    partitions: Iterator[tuple[str, ...]],
    keep: bool = False,
    columns: list[str] = HIGH_VALUES,
) -> None:
    """Drop partitions in batches; with ``keep`` they stay in the catalog, empty."""
    specs = (_partition_spec(columns, p) for p in partitions)
    while batch := list(islice(specs, _DDL_BATCH)):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(batch)}")
        if keep:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(batch)}")


def cleanup_units(table: str, units: DataFrame, mode: str | None = "TRUNCATE", execute: bool = False) -> DataFrame:
    """M5: remove the rows of units from a table laid out by unit. Nothing happens unless ``execute`` is set.

    TRUNCATE and DELETE leave the unit in the catalog, DROP removes it. Returns the units with the mode.
    """
    wanted = (mode or "").strip().upper() or "TRUNCATE"
    if wanted not in CLEANUP_MODES:
        raise ValueError(f"unsupported cleanup mode: {mode}")
    if execute:
        spark = units.sparkSession
        keys = (tuple(r) for r in units.select(*HIGH_VALUES).distinct().toLocalIterator())
        drop_partitions(spark, table, keys, keep=wanted != "DROP")
        spark.catalog.refreshTable(table)
    return units.withColumns({"cleanup_mode": F.lit(wanted), "executed": F.lit("Y" if execute else "N")})


def _switch_location(spark: SparkSession, table: str, folder: str) -> None:
    """One change of the catalog: readers see all of the old files or all of the new ones."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)


def _remove_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def truncate_flat_source(
    table: str, units: DataFrame, key: str, list_col: str | None = None, execute: bool = False
) -> DataFrame:
    """M5, M6 for a table that is not laid out by unit: remove the rows of units by copy on write.

    The rows that stay are written to a new folder beside the table's and counted there; only if they and the rows of the
    units add up to all rows that the table held does the catalog switch to the new folder, in a single change. A run that
    breaks before it leaves the table as it was. The old folder goes after the switch. Returns (unit key, n): the rows of
    each unit, removed if ``execute`` is set.
    """
    spark = units.sparkSession
    stored = spark.table(table)
    if laid_out_by_unit(stored):
        raise ValueError(f"{table} is laid out by unit; its units are cleaned up as partitions")
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if "# Partition Information" in details:
        raise ValueError(f"{table} is partitioned by other columns; its folder cannot be switched as a whole")
    removed = settle(unit_row_counts(stored, units, key, list_col), "removed")
    gone = removed.agg(F.sum("n")).first()[0] or 0
    if execute and gone:
        old, total = details["Location"], stored.count()
        new = f"{old.rstrip('/')}__{uuid.uuid4().hex[:12]}"
        kept = rows_outside(stored, units, key, list_col).select(*stored.columns)
        kept.write.format(details["Provider"]).save(new)
        written = spark.read.format(details["Provider"]).schema(stored.schema).load(new).count()
        if written + gone != total:
            _remove_folder(spark, new)
            raise ValueError(f"{table} changed while its units were removed: {total} rows, {gone} to remove, {written} kept")
        _switch_location(spark, table, new)
        _remove_folder(spark, old)
    return removed


def rows_outside(df: DataFrame, units: DataFrame, key: str, list_col: str | None = None) -> DataFrame:
    """M5 for a table that is not laid out by unit: the rows a cleanup leaves, to be written elsewhere."""
    return assign_units(df, units, key, list_col, outside=True)
