"""One query per operator. Dates are shown as ISO text; every query runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from querybook import roles
from querybook.roles import ARCHIVE_OWNER, SOURCES
from sliceward import operators as op
from sliceward.functions import list_text
from sliceward.plans import ArchiveLifecycle, Binding, ReplicaLifecycle
from sliceward.schema import ARCHIVE, HIGH_VALUES, REPLICA, SOURCE, TARGET, UNIT_KEY
from sliceward.sources import SourceSpec, for_each_table, scratch_database, scratch_name, settle
from sliceward.sources import append_state as _append
from sliceward.sources import compact_state as _compact

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen columns with dates and times as text."""
    types = dict(df.dtypes)
    text = {
        "date": lambda c: F.col(c).cast("string"),
        "timestamp_ntz": lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        "array<string>": lambda c: list_text(F.col(c)),
    }
    return df.select(*[text[types[c]](c).alias(c) if types[c] in text else F.col(c) for c in columns])


UNIT_SHOWN = [*UNIT_KEY, "partition_name", "subpartition_name", "unit_type", "low", "high", "list_values"]
LEDGER_SHOWN = [*UNIT_KEY, *TARGET, "low", "high"]
ARCHIVE_STATE = [*ARCHIVE.statuses, "source_rows", "target_rows", "last_run_id", "error_message"]
REPLICA_STATE = [*REPLICA.statuses, "source_rows", "target_rows", "last_run_id", "error_message"]


# Sources, sinks, unit catalog.


@query
def read_source(spark, sf_dir):
    """Rows and key range of every source."""
    parts = []
    for source, (_, key, _) in SOURCES.items():
        rows = roles.source_rows(spark, sf_dir, source)
        parts.append(
            rows.agg(
                F.lit(source).alias("source_table"),
                F.count(F.lit(1)).alias("n"),
                F.min(F.to_date(key)).alias("first_day"),
                F.max(F.to_date(key)).alias("last_day"),
            )
        )
    return shown(roles.union(parts), "source_table", "n", "first_day", "last_day")


@query
def unit_catalog(spark, sf_dir):
    orders = roles.partitions(spark, sf_dir, "ORDERS")
    lineitem = roles.partitions(spark, sf_dir, "LINEITEM")
    quoted = F.transform("list_values", lambda v: F.concat(F.lit("'"), v, F.lit("'")))
    lists = roles.list_groups(spark, sf_dir, "LINEITEM").select(
        *SOURCE, "subpartition_name", F.array_join(quoted, ", ").alias("subpartition_high_value")
    )
    declared = lineitem.select(*SOURCE, "partition_name").join(lists, SOURCE)
    return shown(op.unit_catalog(orders.unionByName(lineitem), declared), *UNIT_SHOWN, "position")


@query
def interval_units(spark, sf_dir):
    daily = op.interval_units(roles.source_rows(spark, sf_dir, "EVENTS"), "ts", (roles.LINK, roles.OWNER, "EVENTS"))
    monthly = op.interval_units(
        roles.source_rows(spark, sf_dir, "ORDERS"), "o_orderdate", (roles.LINK, roles.OWNER, "ORDERS"), "month"
    )
    return shown(daily.unionByName(monthly), *UNIT_SHOWN, "position")


@query
def list_subunits(spark, sf_dir):
    return shown(roles.catalog(spark, sf_dir, "EVENTS"), *UNIT_SHOWN, "position")


@query
def source_predicates(spark, sf_dir):
    """Every source cut into five read partitions by the row counts of its units; rows that each partition's predicate
    really reads."""
    parts = []
    for source, (_, key, list_col) in SOURCES.items():
        units = roles.catalog(spark, sf_dir, source)
        rows = roles.source_rows(spark, sf_dir, source)
        counts = op.unit_row_counts(rows, units, key, list_col)
        bins = settle(op.source_predicates(units, counts, 5, key, list_col), "bins")
        for b in bins.orderBy("bin").collect():  # five texts, as a JDBC read needs them
            read = rows.filter(b["predicate"]).agg(F.count(F.lit(1)).alias("rows_read"))
            named = [F.lit(v).cast(t).alias(c) for c, v, t in (("source_table", source, "string"), ("bin", b["bin"], "int"), ("units", b["units"], "long"), ("n", b["n"], "long"))]
            parts.append(read.select(*named, "rows_read"))
    return roles.union(parts)


@query
def assign_units(spark, sf_dir):
    units = roles.catalog(spark, sf_dir, "LINEITEM")
    rows = roles.source_rows(spark, sf_dir, "LINEITEM")
    assigned = op.assign_units(rows, units, "l_shipdate", "l_returnflag")
    return assigned.select("l_orderkey", "l_linenumber", *HIGH_VALUES)


@query
def unit_slice(spark, sf_dir):
    unit = roles.catalog(spark, sf_dir, "LINEITEM").filter(
        "partition_name = 'P1997' AND subpartition_name = 'SP_DONE'"
    )
    rows = roles.source_rows(spark, sf_dir, "LINEITEM")
    found = op.unit_slice(rows, unit.first().asDict(), "l_shipdate", "l_returnflag")
    return shown(found, "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")


@query
def unit_slices(spark, sf_dir):
    units = roles.catalog(spark, sf_dir, "ORDERS").filter("partition_hv <> 'MAXVALUE' AND position % 2 = 0")
    found = op.unit_slices(roles.source_rows(spark, sf_dir, "ORDERS"), units, "o_orderdate")
    return shown(found, "o_orderkey", "o_custkey", "o_orderdate")


def _loaded(spark, sf_dir, source, rows=None, units=None, cluster_by=()):
    """A fresh table laid out by unit, filled with ``rows``; returns (table name, units)."""
    _, key, list_col = SOURCES[source]
    units = units if units is not None else roles.catalog(spark, sf_dir, source)
    rows = rows if rows is not None else roles.source_rows(spark, sf_dir, source)
    name = scratch_name(spark, f"{source.lower()}_units")
    op.create_unit_table(rows, name)
    counts = op.load_units(rows, units, name, key, list_col, cluster_by)
    return name, units, counts


CLUSTER_BY = {"ORDERS": ("o_custkey", "o_orderdate"), "LINEITEM": ("l_partkey", "l_shipdate"), "EVENTS": ("user_id", "ts")}


def clustered(spark, sf_dir, sources=tuple(SOURCES)):
    """What clustered loads hold per unit, and how many files reach into another of their unit."""

    def of_source(source):
        first = CLUSTER_BY[source][0]
        name, _, _ = _loaded(spark, sf_dir, source, cluster_by=CLUSTER_BY[source])
        ends = [F.count(F.lit(1)).alias("n"), F.min(first).alias("first_key"), F.max(first).alias("last_key")]
        files = spark.table(name).groupBy(*HIGH_VALUES, F.col("_metadata.file_path").alias("file")).agg(*ends)
        before = F.lag("last_key").over(Window.partitionBy(*HIGH_VALUES).orderBy("first_key", "last_key"))
        return (
            files.withColumn("overlaps", F.coalesce(F.col("first_key") < before, F.lit(False)))
            .groupBy(F.lit(source).alias("source_table"), *HIGH_VALUES)
            .agg(
                F.sum("n").alias("n"),
                F.min("first_key").alias("first_key"),
                F.max("last_key").alias("last_key"),
                F.count_if("overlaps").alias("files_overlap"),
            )
        )

    return roles.union(for_each_table(spark, of_source, sources))


@query
def clustered_write(spark, sf_dir):
    """Clustered loads of all sources."""
    return clustered(spark, sf_dir)


# A day below which units are early, and what a later source has lost and kept of its rows.
EARLY = {"ORDERS": "1998-01-01", "LINEITEM": "1998-01-01", "EVENTS": "2024-01-15"}
_SHRUNK = {
    "ORDERS": "year(o_orderdate) <> 1998 AND o_orderkey % 3 <> 0",
    "LINEITEM": "year(l_shipdate) <> 1998 AND l_orderkey % 3 <> 0",
    "EVENTS": "dayofmonth(ts) <> 20 AND event_id % 3 <> 0",
}


@query
def swap_units(spark, sf_dir):
    """All sources are loaded, then their later units are replaced from sources that lost a year or a day and every third
    key. The units of what was lost must end up empty, the early ones untouched."""

    def swapped(source):
        _, key, list_col = SOURCES[source]
        name, units, _ = _loaded(spark, sf_dir, source)
        later = settle(units.filter(f"high IS NULL OR high > DATE'{EARLY[source]}'"), "later")
        rows = roles.source_rows(spark, sf_dir, source).filter(_SHRUNK[source])
        op.swap_units(op.assign_units(rows, later, key, list_col), name, later)
        return op.stored_row_counts(spark.table(name), units)

    return roles.union(for_each_table(spark, swapped, SOURCES))


@query
def append_state(spark, sf_dir):
    """Run events appended in two batches, read back per type and status."""
    events = roles.run_events(spark, sf_dir)
    name = scratch_name(spark, "run_events")
    _append(events.filter("seq = 0"), name)
    _append(events.filter("seq = 1"), name)
    return (
        spark.table(name)
        .groupBy(F.coalesce("run_type", F.lit("-")).alias("run_type"), "run_status")
        .agg(F.count(F.lit(1)).alias("n"))
    )


# Counting and reconciliation.


@query
def unit_row_counts(spark, sf_dir):
    return roles.counts(spark, sf_dir, roles.catalogs(spark, sf_dir))


@query
def day_histogram(spark, sf_dir):
    parts = []
    for source, (_, key, list_col) in SOURCES.items():
        days = op.day_histogram(roles.source_rows(spark, sf_dir, source), key, list_col)
        value = F.col(list_col) if list_col else F.lit("#")
        parts.append(
            days.select(
                F.lit(source).alias("source_table"),
                F.col(key).cast("string").alias("day"),
                value.alias("list_value"),
                F.col("day_rows").alias("n"),
            )
        )
    return roles.union(parts)


@query
def reconcile_recorded(spark, sf_dir):
    """Archived units whose recorded load is that of the faulty copy, against a recount of their source."""

    def checked(source):
        _, key, list_col = SOURCES[source]
        units = roles.catalog(spark, sf_dir, source).filter(f"high < DATE'{roles.POLICIES[source][0]}'")
        rows = roles.source_rows(spark, sf_dir, source)
        recorded = op.unit_row_counts(roles.faulty(rows, source), units, key, list_col)
        ledger = units.join(recorded.withColumnRenamed("n", "target_rows"), UNIT_KEY)
        return op.reconcile_recorded(ledger, op.unit_row_counts(rows, units, key, list_col))

    both = roles.union(for_each_table(spark, checked, SOURCES))
    return both.select(*UNIT_KEY, "source_rows", "target_rows", "quality_status", "error_message")


@query
def reconcile_recounted(spark, sf_dir):
    """The faulty copies are really loaded; both sides are counted again."""


    def checked(source):
        _, key, list_col = SOURCES[source]
        rows = roles.source_rows(spark, sf_dir, source)
        name, units, _ = _loaded(spark, sf_dir, source, roles.faulty(rows, source))
        source_counts = op.unit_row_counts(rows, units, key, list_col)
        target_counts = op.stored_row_counts(spark.table(name), units)
        return op.reconcile_recounted(units, source_counts, target_counts)

    return roles.union(for_each_table(spark, checked, SOURCES)).select(*UNIT_KEY, "source_rows", "target_rows", "quality_status", "error_message")


def _cleanable(spark, sf_dir, ledger):
    cfg = roles.config(spark)
    rows = op.rule_rows(spark, roles.rules(spark, sf_dir))
    return op.preserve_match(op.truncatable(ledger, cfg), op.preserve_dates(cfg, rows))


@query
def step_counters(spark, sf_dir):
    ledger = roles.archive_ledger(spark, sf_dir)
    archived = ledger.filter("archive_status = 'Y'")
    return roles.union(
        [
            op.step_counters(ledger, "DISCOVER", ARCHIVE, True),
            op.step_counters(archived, "ARCHIVE", ARCHIVE, True),
            op.step_counters(archived, "QUALITY", ARCHIVE, True),
            op.step_counters(_cleanable(spark, sf_dir, ledger), "TRUNCATE", ARCHIVE, False),
        ]
    )


@query
def step_summary(spark, sf_dir):
    archived = roles.archive_ledger(spark, sf_dir).filter("archive_status = 'Y'")
    return op.step_summary(archived, "QUALITY", ARCHIVE, True)


@query
def step_summary_cleanup(spark, sf_dir):
    ledger = roles.archive_ledger(spark, sf_dir)
    return op.step_summary(_cleanable(spark, sf_dir, ledger), "TRUNCATE", ARCHIVE, False)


@query
def ledger_violations(spark, sf_dir):
    """A ledger with a unit recorded twice, a run per unit that may not exist, and unknown statuses; a config
    with a forbidden link and a table nobody configured."""
    ledger = roles.archive_ledger(spark, sf_dir)
    twice = ledger.filter("partition_name = 'P1997'")
    odd = ledger.unionByName(twice).withColumns(
        {
            "last_run_id": F.col("target_rows"),
            "truncate_status": F.expr("CASE WHEN target_rows = 0 THEN 'X' ELSE truncate_status END"),
            "subpartition_name": F.expr("CASE WHEN partition_name = 'P1996' THEN '#' ELSE subpartition_name END"),
        }
    )
    cfg = roles.config(spark).filter("source_table <> 'ORDERS'")
    bad = cfg.withColumns({"source_link": F.lit("local "), "enabled_flag": F.lit("?")})
    return op.ledger_violations(odd, cfg.unionByName(bad), roles.runs(spark, sf_dir), ARCHIVE)


# Candidate selection.


@query
def source_units(spark, sf_dir):
    cats = roles.union(roles.catalogs(spark, sf_dir).values())
    cfg = roles.config(spark).withColumn(
        "enabled_flag", F.when(F.col("source_table") == "EVENTS", "N").otherwise("Y")
    )
    return shown(
        op.source_units(cfg, cats),
        *LEDGER_SHOWN, "unit_type", "source_partition_name", "source_subpartition_name", "list_values",
    )


@query
def undiscovered(spark, sf_dir):
    """Units the ledger lacks after it recorded those archived so far."""
    known = roles.archive_ledger(spark, sf_dir).filter("archive_status = 'Y'")
    units = op.source_units(roles.config(spark), roles.union(roles.catalogs(spark, sf_dir).values()))
    return shown(op.undiscovered(units, known), *LEDGER_SHOWN, "unit_type")


def _fresh_ledger(spark, sf_dir):
    """All units discovered, none archived."""
    units = op.source_units(roles.config(spark), roles.union(roles.catalogs(spark, sf_dir).values()))
    events = op.discover_events(units, ARCHIVE, 1, roles.as_of())
    return op.current_units(settle(events, "unit_events"), ARCHIVE)


@query
def archivable(spark, sf_dir):
    units = op.archivable(_fresh_ledger(spark, sf_dir), roles.config(spark))
    return shown(units, *LEDGER_SHOWN, "unit_type", "archive_status", "last_business_date")


@query
def quality_pending(spark, sf_dir):
    ledger = roles.archive_ledger(spark, sf_dir)
    return shown(op.quality_pending(ledger, roles.config(spark)), *LEDGER_SHOWN, *ARCHIVE_STATE)


@query
def truncatable(spark, sf_dir):
    units = op.truncatable(roles.archive_ledger(spark, sf_dir), roles.config(spark))
    return shown(units, *LEDGER_SHOWN, "last_business_date", "days_online", "cutoff_date", "target_rows")


@query
def preserve_match(spark, sf_dir):
    units = _cleanable(spark, sf_dir, roles.archive_ledger(spark, sf_dir))
    return shown(units, *LEDGER_SHOWN, "preserve_date")


@query
def preserve_dates(spark, sf_dir):
    rows = op.rule_rows(spark, roles.rules(spark, sf_dir))
    return shown(op.preserve_dates(roles.config(spark), rows), *TARGET, "preserve_rule", "preserve_date")


@query
def configured_rules(spark, sf_dir):
    """Preserve rules as the config itself holds them: the days of every table, and what became of its rule."""
    rules = roles.rules(spark, sf_dir)
    texts = {table: text for (_, table), text in rules.items()} | {"EVENTS_ARCH": "SELECT no_such_column FROM rule_events"}
    text = F.coalesce(*[F.when(F.col("target_table") == t, F.lit(r)) for t, r in texts.items()])
    config = roles.config(spark).withColumn("preserve_rule", text)
    rows = settle(op.configured_rules(config), "rule_rows")
    days = op.preserve_dates(config, rows).select(*TARGET, "preserve_date")
    return shown(days.join(op.preserve_status(config, rows), TARGET), *TARGET, "preserve_date", "preserve_calc")


def _odd_rules(spark, sf_dir):
    """One rule that gives one date, one that starts with NULL, one that cannot be analysed."""
    roles.rules(spark, sf_dir)
    return {
        (ARCHIVE_OWNER, "ORDERS_ARCH"): "SELECT max(to_date(o_orderdate)) FROM rule_orders",
        (ARCHIVE_OWNER, "LINEITEM_ARCH"): (
            "SELECT CASE WHEN l_returnflag <> 'A' THEN max(to_date(l_shipdate)) END FROM rule_lineitem "
            "GROUP BY l_returnflag ORDER BY l_returnflag"
        ),
        (ARCHIVE_OWNER, "EVENTS_ARCH"): "SELECT no_such_column FROM rule_events",
    }


@query
def preserve_status(spark, sf_dir):
    cfg = roles.config(spark).withColumn("preserve_rule", F.coalesce("preserve_rule", F.lit("broken")))
    without = roles.config(spark).withColumns(
        {"target_table": F.concat("target_table", F.lit("_2")), "preserve_rule": F.nullif("preserve_rule", F.lit("year ends"))}
    )
    more = cfg.filter("source_table <> 'EVENTS'").withColumn("target_table", F.concat("target_table", F.lit("_3")))
    rules = _odd_rules(spark, sf_dir) | {
        (ARCHIVE_OWNER, "ORDERS_ARCH_3"): "SELECT to_date(o_orderdate) FROM rule_orders WHERE o_orderkey < 0",
        (ARCHIVE_OWNER, "LINEITEM_ARCH_3"): "SELECT CAST(concat('no day ', l_orderkey) AS DATE) FROM rule_lineitem",
    }
    rows = op.rule_rows(spark, rules)
    return op.preserve_status(cfg.unionByName(without).unionByName(more), rows).select(*TARGET, "preserve_calc")


@query
def single_date_rule(spark, sf_dir):
    rows = op.rule_rows(spark, _odd_rules(spark, sf_dir))
    return shown(op.single_date_rule(roles.config(spark), rows), *TARGET, "retention_date")


@query
def replica_source_units(spark, sf_dir):
    units = op.replica_source_units(roles.archive_ledger(spark, sf_dir), roles.replica_config(spark))
    return shown(units, *LEDGER_SHOWN, "unit_type", "base_date", "cutoff_date")


def _replica(spark, sf_dir):
    archive = roles.archive_ledger(spark, sf_dir)
    cfg = roles.replica_config(spark)
    bases = op.base_dates(op.replica_source_units(archive, cfg))
    return archive, cfg, bases, settle(roles.replica_ledger(archive, cfg), "replica_ledger")


@query
def replicable(spark, sf_dir):
    _, cfg, bases, ledger = _replica(spark, sf_dir)
    return shown(op.replicable(ledger, cfg, bases), *LEDGER_SHOWN, "base_date", "cutoff_date")


@query
def purgeable(spark, sf_dir):
    _, cfg, bases, ledger = _replica(spark, sf_dir)
    return shown(op.purgeable(ledger, cfg, bases), *LEDGER_SHOWN, "base_date", "cutoff_date", "target_rows")


@query
def scope(spark, sf_dir):
    """Working tables of a cleanup limited to one target owner, and the units of one target table."""
    units = settle(op.truncatable(roles.archive_ledger(spark, sf_dir), roles.config(spark)), "scoped")
    tables = op.scoped_tables(units, " archive ").select(*SOURCE, *TARGET, F.lit("*").alias("partition_hv"))
    one = op.scope(units, None, "lineitem_arch").select(*SOURCE, *TARGET, "partition_hv").distinct()
    return tables.unionByName(one)


# Movement.


@query
def discover(spark, sf_dir):
    """First ledger rows of all units, with the target subpartition found by its list."""
    units = op.source_units(roles.config(spark), roles.union(roles.catalogs(spark, sf_dir).values()))
    template = roles.union([roles.list_groups(spark, sf_dir, s) for s in ("LINEITEM", "EVENTS")]).select(
        F.lit(ARCHIVE_OWNER).alias("target_owner"),
        F.concat("source_table", F.lit("_ARCH")).alias("target_table"),
        F.concat(F.lit("T_"), "subpartition_name").alias("subpartition_name"),
        "list_values",
    )
    found = op.resolve_targets(units, template)
    events = op.discover_events(found, ARCHIVE, 1, roles.as_of())
    return shown(events, *LEDGER_SHOWN, "unit_type", "source_subpartition_name", "subpartition_name", *ARCHIVE_STATE)


@query
def archive(spark, sf_dir):
    """All closed units of every source are loaded; what can be read back per unit."""
    candidates = settle(op.archivable(_fresh_ledger(spark, sf_dir), roles.config(spark)), "archivable")

    def load(source):
        return _loaded(spark, sf_dir, source, units=candidates.filter(F.col("source_table") == source))[2]

    return roles.union(for_each_table(spark, load, SOURCES))


@query
def replicate(spark, sf_dir):
    """Replica loads of all tables from archives laid out by unit."""
    _, cfg, bases, ledger = _replica(spark, sf_dir)
    units = settle(op.replicable(ledger, cfg, bases), "replicable")

    def replicated(source):
        _, key, list_col = SOURCES[source]
        archive_table, _, _ = _loaded(spark, sf_dir, source)
        replica_table = scratch_name(spark, f"{source.lower()}_replica")
        op.create_unit_table(spark.table(archive_table), replica_table)
        own = units.filter(F.col("source_table") == f"{source}_ARCH")
        return op.load_units(spark.table(archive_table), own, replica_table, key, list_col)

    return roles.union(for_each_table(spark, replicated, SOURCES))


@query
def cleanup_units(spark, sf_dir):
    """Three loads of every source; early units are truncated, deleted or dropped. Rows and partitions left."""
    cats = roles.catalogs(spark, sf_dir)

    def cleaned(source):
        first, units, _ = _loaded(spark, sf_dir, source, units=cats[source])
        # The other two are loaded from the first, which is laid out by unit, so the source is shuffled once.
        tables = {"TRUNCATE": first}
        for mode in ("DELETE", "DROP"):
            tables[mode], _, _ = _loaded(spark, sf_dir, source, rows=spark.table(first), units=units)
        left = []
        for mode, name in tables.items():
            op.cleanup_units(name, units.filter(f"high <= DATE'{EARLY[source]}'"), mode, execute=True)
            kept = spark.sql(f"SHOW PARTITIONS {name}").agg(F.count(F.lit(1)).alias("partitions_kept"))
            counts = op.stored_row_counts(spark.table(name), units)
            left.append(
                counts.select("source_table", F.lit(mode).alias("cleanup_mode"), *HIGH_VALUES, "n").join(
                    kept.withColumn("cleanup_mode", F.lit(mode)), "cleanup_mode"
                )
            )
        return roles.union(left)

    return roles.union(for_each_table(spark, cleaned, SOURCES))


ROW_KEYS = {"ORDERS": ["o_orderkey"], "LINEITEM": ["l_orderkey", "l_linenumber"], "EVENTS": ["event_id"]}


@query
def rows_outside(spark, sf_dir):
    """Sources that are not laid out by unit: the rows left when the early units are cleaned up."""

    def left(source):
        _, key, list_col = SOURCES[source]
        units = settle(roles.catalog(spark, sf_dir, source).filter(f"high <= DATE'{EARLY[source]}'"), "early")
        rows = op.rows_outside(roles.source_rows(spark, sf_dir, source), units, key, list_col)
        row_key = F.concat_ws("-", *[F.col(c).cast("string") for c in ROW_KEYS[source]])
        return rows.select(F.lit(source).alias("source_table"), row_key.alias("row_key"), F.to_date(key).cast("string").alias("day"))

    return roles.union(for_each_table(spark, left, SOURCES))


@query
def truncate_flat_source(spark, sf_dir):
    """Flat copies of all sources; every other unit is removed by copy on write. Rows left per unit, and the rows that the
    cleanup says it removed."""

    def cleaned(source):
        _, key, list_col = SOURCES[source]
        units = roles.catalog(spark, sf_dir, source)
        name = scratch_name(spark, f"{source.lower()}_flat")
        roles.source_rows(spark, sf_dir, source).write.format("parquet").saveAsTable(name)
        some = settle(units.filter("position % 2 = 0"), "some_units")
        removed = op.truncate_flat_source(name, some, key, list_col, execute=True)
        held = op.unit_row_counts(spark.table(name), units, key, list_col).withColumnRenamed("n", "rows_left")
        return held.join(removed.withColumnRenamed("n", "rows_removed"), UNIT_KEY, "left")

    return roles.union(for_each_table(spark, cleaned, SOURCES)).select(*UNIT_KEY, "rows_left", "rows_removed")


@query
def business_dates(spark, sf_dir):
    """Business dates kept as SQL text: a constant, a subquery over the shipments, NULL, and one that cannot run."""
    roles.source_rows(spark, sf_dir, "LINEITEM").createOrReplaceTempView("dated_lineitem")
    texts = {
        "ORDERS": "DATE '2001-06-01'",
        "LINEITEM": "SELECT date_sub(max(l_shipdate), 30) FROM dated_lineitem",
        "EVENTS": "CAST(NULL AS DATE)",
        "PARTS": "SELECT l_shipdate FROM dated_lineitem",
        "SUPPLIERS": None,
    }
    rows = [(source, text) for source, text in texts.items()]
    dated = op.business_dates(spark.createDataFrame(rows, "source_table string, last_business_date string"))
    return shown(dated, "source_table", "last_business_date", "business_date_state")


def _rows_left(spark, sf_dir, gone, suffix):
    """Every source is loaded as a whole and the units of ``gone`` are emptied; rows left per unit."""

    def cleaned(source):
        name, all_units, _ = _loaded(spark, sf_dir, source)
        op.cleanup_units(name, gone.filter(F.col("source_table") == source + suffix), "TRUNCATE", execute=True)
        return op.stored_row_counts(spark.table(name), all_units)

    return roles.union(for_each_table(spark, cleaned, SOURCES))


@query
def truncate_source(spark, sf_dir):
    """Cleanup of all sources, without units that hold a preserve date; rows left per unit."""
    units = _cleanable(spark, sf_dir, roles.archive_ledger(spark, sf_dir))
    free = settle(units.filter("preserve_date IS NULL"), "free_units")
    return _rows_left(spark, sf_dir, free, "")


@query
def purge(spark, sf_dir):
    """Cleanup of replicas that held every row; rows left per unit."""
    _, cfg, bases, ledger = _replica(spark, sf_dir)
    return _rows_left(spark, sf_dir, settle(op.purgeable(ledger, cfg, bases), "purgeable"), "_ARCH")


def _marked_events(spark, sf_dir):
    """Ledger events of all units: found, opened for loading, loaded with a row count, partly failed."""
    cats = roles.catalogs(spark, sf_dir)
    units = settle(op.source_units(roles.config(spark), roles.union(cats.values())), "units")
    rows = units.join(roles.counts(spark, sf_dir, cats), UNIT_KEY)
    at = roles.as_of()
    return roles.union(
        [
            op.discover_events(units, ARCHIVE, 1, at),
            op.mark_units(units, ARCHIVE, "N", 2, at, seq=1),
            op.mark_units(rows, ARCHIVE, "Y", 2, at, rows=F.col("n"), seq=2),
            op.unit_events(
                rows, ARCHIVE, 3, at, 3, quality_status=F.lit("Y"), source_rows=F.col("n"), error_message=F.lit(None)
            ),
            op.mark_units(
                rows.filter("n % 2 = 1"), ARCHIVE, "N", 4, at, error=F.lit("load was cut off"), seq=4
            ),
            op.mark_units(rows.filter("n % 4 = 0"), ARCHIVE, "Y", 5, at, rows=F.col("n") + 1, seq=5),
        ]
    )


@query
def mark_units(spark, sf_dir):
    """The events themselves."""
    events = _marked_events(spark, sf_dir)
    return events.select(
        *UNIT_KEY, "seq", *ARCHIVE.statuses, "source_rows", "target_rows", "last_run_id", "error_message"
    )


@query
def current_units(spark, sf_dir):
    ledger = op.current_units(_marked_events(spark, sf_dir), ARCHIVE)
    return shown(ledger, *LEDGER_SHOWN, "unit_type", *ARCHIVE_STATE)


@query
def rejected_events(spark, sf_dir):
    """A batch about a ledger that holds all units but those of the events: new units, and some that break a constraint.
    Known units described again, a unit nobody described, an unknown status, another table's target and an unknown run."""
    cats = roles.catalogs(spark, sf_dir)
    cfg, at = roles.config(spark), roles.as_of()
    units = settle(op.source_units(cfg, roles.union(cats.values())), "units")
    held = settle(op.current_units(op.discover_events(units.filter("source_table <> 'EVENTS'"), ARCHIVE, 1, at), ARCHIVE), "held")
    runs = spark.createDataFrame([(1,), (2,)], "run_id long")
    fresh = units.filter("source_table = 'EVENTS'")
    orders, lines = units.filter("source_table = 'ORDERS'"), units.filter("source_table = 'LINEITEM'")
    batch = roles.union(
        [
            op.discover_events(fresh, ARCHIVE, 2, at),
            op.discover_events(orders.filter("month(high) = 1"), ARCHIVE, 2, at),
            op.unit_events(lines, ARCHIVE, 2, at, 1, quality_status=F.when(F.col("subpartition_hv") == "N", F.lit("?")).otherwise(F.lit("Y"))),
            op.unit_events(orders.withColumn("source_owner", F.lit("NOBODY")), ARCHIVE, 2, at, 2, archive_status=F.lit("Y")),
            op.discover_events(orders.withColumn("source_owner", F.lit("OTHER")), ARCHIVE, 2, at).withColumn("seq", F.lit(3)),
            op.unit_events(orders, ARCHIVE, 9, at, 4, quality_status=F.lit("Y")),
        ]
    )
    return op.rejected_events(settle(batch, "batch"), held, cfg, runs).select(*UNIT_KEY, "seq", "constraint_name")


@query
def compact_state(spark, sf_dir):
    """A ledger whose events came in batches is compacted, and so are batches that come after it; the ledger folded from
    what is left, and how many batches it lies in."""
    events = _marked_events(spark, sf_dir)
    name = scratch_name(spark, "unit_events")
    for seqs in ((0, 1), (2,), (3,), None, (4,), (5,)):
        if seqs is None:
            _compact(spark, name, lambda e: op.deciding_unit_events(e, ARCHIVE))
        else:
            _append(events.filter(F.col("seq").isin(*seqs)), name)
    _compact(spark, name, lambda e: op.deciding_unit_events(e, ARCHIVE))
    batches = spark.sql(f"SHOW PARTITIONS {name}").count()
    ledger = op.current_units(spark.table(name), ARCHIVE)
    return shown(ledger.withColumn("batches", F.lit(batches)), *LEDGER_SHOWN, "unit_type", *ARCHIVE_STATE, "batches")


def _at():
    return datetime.fromisoformat(roles.AS_OF)


def _archive_run(spark, sf_dir, **run):
    """A whole archive run over all sources, each laid out by unit so that its cleanup can be executed."""
    cats = roles.catalogs(spark, sf_dir)

    def bind(source):
        _, key, list_col = SOURCES[source]
        store, _, _ = _loaded(spark, sf_dir, source, units=cats[source])
        target = scratch_name(spark, f"{source.lower()}_arch")
        op.create_unit_table(spark.table(store), target)
        return Binding(SourceSpec("table", store), target, key, list_col, source_store=store)

    bound = for_each_table(spark, bind, SOURCES)
    bindings = {(ARCHIVE_OWNER, f"{source}_ARCH"): binding for source, binding in zip(SOURCES, bound)}
    database = scratch_name(spark, "control").replace(".", "_")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_folder(spark)}/{database}'")
    rules = op.rule_rows(spark, roles.rules(spark, sf_dir))
    life = ArchiveLifecycle(
        spark,
        database,
        roles.config(spark),
        bindings,
        _at,
        catalog=lambda: roles.union(cats.values()),
        rules=lambda: rules,
    )
    life.run_all(**run)
    return life, bindings, database


def _folder(spark):
    return spark.catalog.getDatabase(scratch_database(spark)).locationUri


@query
def run_archive(spark, sf_dir):
    """Discover, archive, quality and an executed cleanup; the ledger with the rows each side still holds."""
    life, bindings, _ = _archive_run(spark, sf_dir, execute=True, stop_after="TRUNCATE", cleanup_execute=True)
    ledger = settle(life.ledger(), "final_ledger")
    parts = []
    for (owner, table), binding in bindings.items():
        units = ledger.filter((F.col("target_owner") == owner) & (F.col("target_table") == table))
        source = op.stored_row_counts(spark.table(binding.source_store), units)
        target = op.stored_row_counts(spark.table(binding.target), units)
        parts.append(
            units.join(source.withColumnRenamed("n", "source_left"), UNIT_KEY).join(
                target.withColumnRenamed("n", "target_held"), UNIT_KEY
            )
        )
    shown_columns = [*UNIT_KEY, *ARCHIVE.statuses, "source_rows", "target_rows", "source_left", "target_held"]
    return roles.union(parts).select(*shown_columns)


@query
def run_replica(spark, sf_dir):
    """An archive run, then a replica run with an executed purge on top of it."""
    life, bindings, database = _archive_run(spark, sf_dir, execute=True)
    replicas = {}
    for (owner, table), binding in bindings.items():
        target = scratch_name(spark, f"{table.lower()}_repl")
        op.create_unit_table(spark.table(binding.target), target)
        replicas[(roles.REPLICA_OWNER, table.replace("_ARCH", "_REPL"))] = Binding(
            SourceSpec("table", binding.target), target, binding.key, binding.list_col
        )
    replica = ReplicaLifecycle(
        spark, database, roles.replica_config(spark), replicas, _at, archive_ledger=life.ledger
    )
    replica.run_all(execute=True, cleanup_execute=True)
    ledger = settle(replica.ledger(), "final_ledger")
    parts = []
    for (owner, table), binding in replicas.items():
        units = ledger.filter((F.col("target_owner") == owner) & (F.col("target_table") == table))
        held = op.stored_row_counts(spark.table(binding.target), units)
        parts.append(units.join(held.withColumnRenamed("n", "target_held"), UNIT_KEY))
    return roles.union(parts).select(*UNIT_KEY, *REPLICA.statuses, "source_rows", "target_rows", "target_held")


@query
def run_replica_purge(spark, sf_dir):
    """A replica run with wide windows, then one with windows of a few days and an executed purge: what has left the
    windows is gone from the replica."""
    life, bindings, database = _archive_run(spark, sf_dir, execute=True)
    replicas = {}
    for (owner, table), binding in bindings.items():
        target = scratch_name(spark, f"{table.lower()}_repl")
        op.create_unit_table(spark.table(binding.target), target)
        replicas[(roles.REPLICA_OWNER, table.replace("_ARCH", "_REPL"))] = Binding(
            SourceSpec("table", binding.target), target, binding.key, binding.list_col
        )
    wide = roles.replica_config(spark)
    narrow = wide.withColumn("days_online", F.when(F.col("source_table") == "EVENTS_ARCH", 3).otherwise(100))
    for cfg, purge in ((wide, False), (narrow, True)):
        replica = ReplicaLifecycle(spark, database, cfg, replicas, _at, archive_ledger=life.ledger)
        replica.run_all(execute=True, cleanup_execute=purge)
    ledger = settle(replica.ledger(), "final_ledger")
    parts = []
    for (owner, table), binding in replicas.items():
        units = ledger.filter((F.col("target_owner") == owner) & (F.col("target_table") == table))
        held = op.stored_row_counts(spark.table(binding.target), units)
        parts.append(units.join(held.withColumnRenamed("n", "target_held"), UNIT_KEY))
    return roles.union(parts).select(*UNIT_KEY, *REPLICA.statuses, "source_rows", "target_rows", "target_held")


# State folding and log.


@query
def current_runs(spark, sf_dir):
    runs = roles.runs(spark, sf_dir)
    return shown(
        runs, "run_id", "run_type", "run_status", *SOURCE, "mstr_log_id", "started_at", "ended_at", "execute_flag",
        "error_message",
    )


@query
def consolidate_log(spark, sf_dir):
    log = op.consolidate_log(roles.log_events(spark, sf_dir))
    return shown(
        log, "mstr_log_id", "log_id", "log_categ", "log_status", "start_date", "end_date", "log_msg", "log_json",
        "last_err_code", "last_err_desc",
    )


@query
def log_durations(spark, sf_dir):
    log = op.log_durations(roles.log(spark, sf_dir))
    return log.select("log_id", "seconds", (F.expr("extract(SECOND FROM interval_time)")).cast("long").alias("second_part"))


@query
def expired_log_partitions(spark, sf_dir):
    """Orders as a log of several years: one entry per order, months kept for 90 days."""
    log = roles.table(spark, sf_dir, "orders").select(F.col("o_orderdate").alias("start_date"))
    as_of = F.lit("2001-06-01 12:00:00").cast("timestamp_ntz")
    expired = op.expired_log_partitions(log, as_of, -90, initial_high="1996-01-01")
    return shown(expired, "log_month", "partition_high", "entries")


# Reports.


@query
def in_window(spark, sf_dir):
    return op.report_window(roles.runs(spark, sf_dir), "started_at", roles.as_of())


@query
def exec_summary(spark, sf_dir):
    return op.exec_summary(roles.runs(spark, sf_dir), roles.as_of())


@query
def process_summary(spark, sf_dir):
    return op.process_summary(roles.runs(spark, sf_dir), roles.as_of())


@query
def latest_summaries(spark, sf_dir):
    return op.latest_summaries(roles.log(spark, sf_dir), roles.as_of())


@query
def data_status(spark, sf_dir):
    return op.data_status(roles.archive_ledger(spark, sf_dir))


@query
def replica_data_status(spark, sf_dir):
    return op.data_status(_replica(spark, sf_dir)[3], REPLICA)


@query
def pending_work(spark, sf_dir):
    return op.pending_work(roles.archive_ledger(spark, sf_dir))


@query
def replica_pending_work(spark, sf_dir):
    return op.pending_work(_replica(spark, sf_dir)[3], REPLICA)


@query
def recent_issues(spark, sf_dir):
    return op.recent_issues(roles.runs(spark, sf_dir), roles.log(spark, sf_dir), roles.as_of())


@query
def latest_summary(spark, sf_dir):
    found = op.latest_summary(roles.log(spark, sf_dir), "quality")
    return shown(found, "process", "log_status", "start_date", "end_date", "log_id", "summary_text")


@query
def cap_rows(spark, sf_dir):
    runs = roles.runs(spark, sf_dir).select("run_id", "run_type", "run_status", "execute_flag")
    return op.cap_rows(runs, "run_type", "run_id")
