"""S9 and the tables that outlive a plan: append-only state, and settled small tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from itertools import islice
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SCRATCH = "sliceward_scratch"
#: Partitions that one statement drops.
DDL_BATCH = 500
BATCH = "batch"
#: Spark removes the shuffle files of a query when the query ends, instead of some time after its plan is garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

T = TypeVar("T")
R = TypeVar("R")


def _shared_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    raise ValueError("spark.checkpoint.dir names no folder that all executors share")


def scratch_database(spark: SparkSession) -> str:
    """Database for intermediate tables, in the cluster's shared folder. Its tables are managed tables."""
    if not spark.catalog.databaseExists(SCRATCH):
        location = f"{_shared_folder(spark).rstrip('/')}/{SCRATCH}-{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {SCRATCH} LOCATION '{location}'")
    return SCRATCH


def scratch_name(spark: SparkSession, stem: str) -> str:
    return f"{scratch_database(spark)}.{stem}_{uuid.uuid4().hex[:12]}"


def settle(df: DataFrame, stem: str = "settled") -> DataFrame:
    """Write a control table once and go on from the stored rows.

    Cuts the lineage, survives the loss of executors, and gives the optimizer the real size, so that it
    broadcasts the table only when that is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    name = scratch_name(df.sparkSession, stem)
    df.write.format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is stored meanwhile are removed as soon as it is stored."""
    before = spark.conf.get(FILE_CLEANUP, None)
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FILE_CLEANUP)
        else:
            spark.conf.set(FILE_CLEANUP, before)


class Interim:
    """Tables that a plan stores under a name of its own and drops when nothing reads them any more."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.names = spark, {}

    def settle(self, df: DataFrame, stem: str) -> DataFrame:
        """As ``settle``; a table stored before under the same name is dropped once the new one is complete."""
        before, name = self.names.get(stem), scratch_name(self.spark, stem)
        df.write.format("parquet").saveAsTable(name)
        self.names[stem] = name
        if before:
            self.spark.sql(f"DROP TABLE IF EXISTS {before}")
        return self.spark.table(name)

    def drop(self, *stems: str) -> None:
        for stem in stems:
            if name := self.names.pop(stem, None):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def append_state(events: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
    """Append events to a state table, creating it on first use.

    Every append fills partitions of its own by a partition overwrite. Its files are staged in a folder of
    their own, so runs may append at the same time, and a repeated commit does not double rows. The rebalance
    hint writes few files for few rows and many for many.
    """
    spark = events.sparkSession
    layout = [*partition_by, BATCH]
    create_table(spark, table, events.drop(BATCH).schema, layout, if_not_exists=True)
    require_partition_overwrite(spark, table)
    stored = [c for c in spark.table(table).columns if c != BATCH]
    batch = F.lit(uuid.uuid4().hex).alias(BATCH)
    events.select(*stored).hint("rebalance").select(*stored, batch).write.insertInto(table, overwrite=True)


def compact_state(spark: SparkSession, table: str, survivors: Callable[[DataFrame], DataFrame]) -> int:
    """Replace the batches of a state table by one snapshot of the events that still count; how many there were.

    survivors(events) gives the events that decide how all of them fold, so a reader sees the same state before, between
    and after: the snapshot is a batch like any other, is complete before it becomes visible, and only then the batches
    it stands for are dropped. A run that breaks in between leaves events twice, which fold like once, and the next
    compaction removes them. Batches appended meanwhile are not touched, and two compactions at a time do no harm.
    """
    listed = settle(spark.table(table).select(BATCH).distinct(), "batches")
    count = listed.count()
    if count > 1:
        old = spark.table(table).join(F.broadcast(listed), BATCH, "left_semi").drop(BATCH)
        append_state(settle(survivors(old), "snapshot"), table)
        names = (r[0] for r in listed.toLocalIterator())
        while some := list(islice(names, DDL_BATCH)):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS " + ", ".join(f"PARTITION ({BATCH} = '{b}')" for b in some))
        spark.catalog.refreshTable(table)
    return count


def claim(spark: SparkSession, table: str, name: str, holder: int) -> int:
    """Who holds ``name`` now: ``holder``, if nobody held it before.

    A claim is a partition of a table without rows. The catalog adds a partition once, whoever asks at the same time, so
    of several runs one gets it; the partition's location names its holder.
    """
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (note string, name string) USING parquet PARTITIONED BY (name)")
    folder = spark.catalog.getDatabase(table.rpartition(".")[0]).locationUri.rstrip("/")
    try:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION (name = '{name}') LOCATION '{folder}/claims/holder={holder}'")
        return holder
    except PySparkException as problem:
        if "PARTITIONS_ALREADY_EXIST" not in str(problem):
            raise
    try:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION (name = '{name}')")
        location = described.filter("col_name = 'Location'").select("data_type").first()[0]
        return int(location.rpartition("holder=")[2])
    except PySparkException:  # released meanwhile
        return claim(spark, table, name, holder)


def release(spark: SparkSession, table: str, name: str) -> None:
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (name = '{name}')")


def require_partition_overwrite(spark: SparkSession, table: str) -> None:
    """Refuse a table whose overwrite would replace all partitions instead of those written."""
    if spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "DYNAMIC":
        return
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    options = described.filter("col_name = 'Storage Properties'").select("data_type").first()
    if options is None or "partitionoverwritemode=dynamic" not in options[0].lower():
        raise ValueError(f"{table} lacks the option partitionOverwriteMode=dynamic; its other partitions would be lost")


def create_table(
    spark: SparkSession, table: str, schema: StructType, partition_by: list[str], if_not_exists: bool = False
) -> None:
    """An empty managed Parquet table; the partition columns are strings and come last.

    The table itself says that an overwrite replaces only the partitions it writes. As a write option Spark
    ignores this for inserts, and as a session setting it would change the user's other writes.
    """
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in partition_by]
    columns += [f"`{c}` string" for c in partition_by]
    exists = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(
        f"CREATE TABLE {exists}{table} ({', '.join(columns)}) USING parquet "
        f"OPTIONS ('partitionOverwriteMode' 'dynamic') PARTITIONED BY ({', '.join(partition_by)})"
    )


def for_each_table(spark: SparkSession, work: Callable[[T], R], items: Iterable[T], at_once: int = 4) -> list[R]:
    """Run the independent jobs of several tables side by side; Spark shares the executors between them."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))
