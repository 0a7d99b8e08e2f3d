"""M1-M3, M6-M9: the steps of both layers and the runners that chain them.

A step builds its candidates as a DataFrame, works on all units of a table in one Spark job, and appends what
happened to the state tables. Without ``execute`` it only shows what it would do. The driver holds names and
scalars, never rows of units: the only loop is over the configured tables, a few of them at a time.

Data is replaced first and the ledger is appended after it. A run that breaks in between leaves the units
marked 'N', and the next run replaces them again.
"""

from __future__ import annotations

import secrets
import time
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import UTC, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators.checks import step_counters, step_summary
from sliceward.operators.reports import LOOKBACK_DAYS, SUMMARY_BEGIN, SUMMARY_END
from sliceward.schema import (
    ARCHIVE,
    LOG_EVENT_SCHEMA,
    REPLICA,
    RUN_EVENT_SCHEMA,
    SOURCE,
    TARGET,
    UNIT_KEY,
    Layer,
    ledger_event_schema,
)
from sliceward.sources import SourceSpec, append_state, claim, compact_state, for_each_table, read_source, release, settle
from sliceward.sources.stored import BATCH

#: Batches of a state table above which a run leaves a snapshot behind.
MOST_BATCHES = 16
#: Age of a run whose claims no longer count.
LEASE = timedelta(days=2)


@dataclass(frozen=True)
class Binding:
    """The physical side of one configured table.

    target: managed table laid out by unit. source_store: the table behind the source, laid out by unit or flat (not
    partitioned); only needed to execute a cleanup of the source.
    """

    source: SourceSpec
    target: str
    key: str
    list_col: str | None = None
    cluster_by: tuple[str, ...] = ()
    source_store: str | None = None


@dataclass
class Run:
    run_id: int
    run_type: str
    execute: bool
    started: datetime
    status: str = "SUCCESS"
    messages: list[str] = field(default_factory=list)
    summary: DataFrame | None = None
    left_to_others: bool = False


def _new_id() -> int:
    """Time-ordered id; concurrent runs differ in the random part."""
    return time.time_ns() // 1000 * 1000 + secrets.randbelow(1000)


def _utc_now() -> datetime:
    return datetime.now(UTC).replace(tzinfo=None)


class Lifecycle:
    """State tables, run records and the steps that both layers share."""

    layer: Layer
    default_stop: str | None

    def __init__(
        self,
        spark: SparkSession,
        database: str,
        config: DataFrame,
        bindings: Mapping[tuple[str, str], Binding],
        clock: Callable[[], datetime] = _utc_now,
        tables_at_once: int = 4,
        target_template: Callable[[], DataFrame] | None = None,
    ) -> None:
        """target_template: list groups of the targets (``resolve_targets``). Without it a unit keeps the name
        it has at its source: a table laid out by unit needs no partitions created beforehand."""
        self.spark = spark
        self.config = config
        self.bindings = dict(bindings)
        self.clock = clock
        self.tables_at_once = tables_at_once
        self.target_template = target_template
        self.unit_events_table = f"{database}.{self.layer.name}_unit_events"
        self.run_events_table = f"{database}.{self.layer.name}_run_events"
        self.log_events_table = f"{database}.{self.layer.name}_log_events"
        self.claims_table = f"{database}.{self.layer.name}_claims"

    # State.

    def unit_events(self) -> DataFrame:
        return self._state(self.unit_events_table, ledger_event_schema(self.layer))

    def run_events(self) -> DataFrame:
        return self._state(self.run_events_table, RUN_EVENT_SCHEMA)

    def log_events(self) -> DataFrame:
        return self._state(self.log_events_table, LOG_EVENT_SCHEMA)

    def ledger(self) -> DataFrame:
        return op.current_units(self.unit_events(), self.layer)

    def runs(self) -> DataFrame:
        return op.current_runs(self.run_events())

    def log(self, since: datetime | None = None) -> DataFrame:
        """The log, or that of runs started since. Earlier months are not read: a run's entries all lie in the
        month it started."""
        entries = self.log_events()
        if since is None or "log_month" not in entries.columns:
            return op.consolidate_log(entries)
        recent = entries.filter(F.col("log_month") >= f"{since:%Y-%m}")
        return op.consolidate_log(recent).filter(F.col("start_date") >= F.lit(since.isoformat(sep=" ")).cast("timestamp_ntz"))

    def latest_summary(self, process: str) -> DataFrame:
        """The newest summary of a process; only its own log is put together."""
        return op.latest_summary_of(self.log_events(), process, self.layer)

    def report(self, as_of: datetime, lookback_days: int = LOOKBACK_DAYS) -> dict[str, DataFrame]:
        """The summary report of the layer at a point in time, over settled state."""
        log = settle(self.log(as_of - timedelta(days=lookback_days)), "report_log")
        runs, ledger = settle(self.runs(), "report_runs"), settle(self.ledger(), "report_ledger")
        at = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        return op.report_sections(runs, log, ledger, at, self.layer, lookback_days)

    def _state(self, table: str, schema) -> DataFrame:
        if self.spark.catalog.tableExists(table):
            return self.spark.table(table)
        return self.spark.createDataFrame([], schema)

    def dated_config(self) -> DataFrame:
        """The config with its business dates; dates kept as SQL text are evaluated now."""
        if dict(self.config.dtypes)["last_business_date"] != "string":
            return self.config
        return settle(op.business_dates(self.config), "dated_config").drop("business_date_state")

    def compact(self, most_batches: int = MOST_BATCHES) -> None:
        """Replace the batches of the ledger and of the runs by a snapshot where there are more than so many."""
        layer = self.layer
        folds = {self.unit_events_table: lambda e: op.deciding_unit_events(e, layer), self.run_events_table: op.deciding_run_events}
        for table, survivors in folds.items():
            if self.spark.catalog.tableExists(table) and self.spark.sql(f"SHOW PARTITIONS {table}").count() > most_batches:
                compact_state(self.spark, table, survivors)

    def append_units(self, events: DataFrame) -> None:
        append_state(events, self.unit_events_table)

    def _now(self) -> Column:
        return F.lit(self.clock().isoformat(sep=" ")).cast("timestamp_ntz")

    # Runs and their log.

    @contextmanager
    def _run(self, run_type: str, execute: bool, source: tuple = (None, None, None)) -> Iterator[Run]:
        started = self.clock()
        run = Run(_new_id(), run_type, execute, started)
        link = self._run_link(source[0])
        names = [n.upper() if n else None for n in (link, *source[1:])]
        self._append_run(
            run.run_id, run_type, "RUNNING", *names, run.run_id, started, None, "Y" if execute else "N", None, started, 0
        )
        run.messages.append(f"Started {run_type} with execute={'Y' if execute else 'N'}")
        try:
            yield run
        except Exception as problem:
            self._finish(run, "ERROR", str(problem))
            raise
        self._finish(run, run.status, None)

    def _run_link(self, link: str | None) -> str | None:
        return link

    def _append_run(self, *values) -> None:
        append_state(self.spark.createDataFrame([values], RUN_EVENT_SCHEMA), self.run_events_table)

    def _finish(self, run: Run, status: str, error: str | None) -> None:
        started, ended = run.started, self.clock()
        self._append_run(
            run.run_id, None, status, None, None, None, None, None, ended, None, error, ended, 1
        )
        text = f"Finished {run.run_type} with status {status}" + (f": {error}" if error else "")
        failed = error is not None
        last = len(run.messages)
        rows = [
            (run.run_id, run.run_id, "N", "TEXT", None, None, "RUNNING", started, None, m, None, None, started, i, "")
            for i, m in enumerate(run.messages)
        ]
        rows.append(
            (
                run.run_id,
                run.run_id,
                "N",
                "ERROR" if failed else "TEXT",
                run.run_type,
                run.run_type,
                status,
                None,
                ended,
                text,
                "STEP" if failed else None,
                error,
                ended,
                1_000_000 + last,
                "",
            )
        )
        entries = self.spark.createDataFrame(rows, LOG_EVENT_SCHEMA)
        if run.summary is not None and not failed:
            entries = entries.unionByName(self._summary_entries(run, run.summary))
        # All entries of a run lie in the month it started, so months can be dropped whole.
        month = F.lit(f"{started:%Y-%m}").alias("log_month")
        append_state(entries.select("*", month), self.log_events_table, ("log_month",))

    def _summary_entries(self, run: Run, summary: DataFrame) -> DataFrame:
        """One log entry per summary row between the marks; the log is put together when it is read."""
        cells = [c for c in summary.columns if c not in SOURCE]
        row = F.concat_ws("|", *SOURCE, *cells)
        head = "|".join([*SOURCE, *cells]).upper()
        at = self._now()
        lines = summary.select(
            F.lit(1).alias("seq"), F.concat_ws("|", *SOURCE, "partition_hv", "subpartition_hv").alias("entry_key"),
            row.alias("log_msg"),
        )
        frame = self.spark.createDataFrame(
            [(0, "", f"{SUMMARY_BEGIN}\n{head}"), (2, "", SUMMARY_END)], "seq int, entry_key string, log_msg string"
        )
        return frame.unionByName(lines).select(
            F.lit(run.run_id).alias("mstr_log_id"),
            F.lit(run.run_id).alias("log_id"),
            F.lit("N").alias("log_level"),
            F.lit("SUMMARY").alias("log_type"),
            *[F.lit(None).cast("string").alias(c) for c in ("log_categ", "mstr_fun")],
            F.lit(None).cast("string").alias("log_status"),
            *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("start_date", "end_date")],
            "log_msg",
            *[F.lit(None).cast("string").alias(c) for c in ("last_err_code", "last_err_desc")],
            at.alias("event_ts"),
            (F.col("seq") + 1000).alias("seq"),
            "entry_key",
        )

    def _report(self, run: Run, step: str, units: DataFrame, execute: bool, log: bool = True) -> DataFrame:
        """Counters to the log, summary rows to the log and to the caller."""
        totals = step_counters(units, step, self.layer, execute).first()
        run.messages.append(f"{step} " + " ".join(f"{c}={totals[c]}" for c in totals.asDict() if c != "step"))
        run.status = "WARNING" if run.left_to_others else totals["run_status"]
        summary = step_summary(units, step, self.layer, execute)
        if log and totals["units"]:
            run.summary = summary
        return summary

    def cleanup_log(self, as_of: datetime, retention_days: int = 90, execute: bool = False) -> DataFrame:
        """months of the log past their retention; with ``execute`` they are dropped.

        Only partition columns are read. The months come back as stored rows.
        """
        stored = self.log_events()
        if "log_month" not in stored.columns:
            stored = stored.withColumn("log_month", F.lit(None).cast("string"))
        months = stored.select("log_month", F.concat("log_month", F.lit("-01")).cast("timestamp_ntz").alias("start_date"))
        limit = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
        expired = settle(op.expired_log_partitions(months, limit, retention_days), "expired")
        if execute and self.spark.catalog.tableExists(self.log_events_table):
            month = F.date_format("log_month", "yyyy-MM").alias("log_month")
            old = stored.select("log_month", BATCH).distinct().join(expired.select(month), "log_month", "left_semi")
            layout = ["log_month", BATCH]
            op.drop_partitions(
                self.spark, self.log_events_table, (tuple(r) for r in old.toLocalIterator()), columns=layout
            )
        return expired

    # Claims.

    @contextmanager
    def _claimed(self, run: Run, name: str) -> Iterator[bool]:
        """Whether the run may replace units of a target: no other run that still goes on works on it.

        The claim of a run that has ended, or that began longer than LEASE ago, is taken over.
        """
        holder = claim(self.spark, self.claims_table, name, run.run_id)
        if holder != run.run_id and self._over(holder):
            release(self.spark, self.claims_table, name)
            holder = claim(self.spark, self.claims_table, name, run.run_id)
        if holder != run.run_id:
            run.messages.append(f"{name} is claimed by run {holder}; its units are left to it")
            run.left_to_others = True
        try:
            yield holder == run.run_id
        finally:
            if holder == run.run_id:
                release(self.spark, self.claims_table, name)

    def _over(self, run_id: int) -> bool:
        held = self.runs().filter(F.col("run_id") == run_id).select("run_status", "started_at").first()
        return held is None or held["run_status"] != "RUNNING" or held["started_at"] < self.clock() - LEASE

    # Steps.

    def _tables(self, units: DataFrame) -> list[tuple[Binding, DataFrame]]:
        """Binding and units of every table a step works on. One entry per configured table."""
        found = []
        for row in op.scoped_tables(units).toLocalIterator():
            binding = self.bindings.get((row["target_owner"], row["target_table"]))
            if binding is None:
                raise ValueError(f"no tables are bound to {row['target_owner']}.{row['target_table']}")
            of_table = units
            for column in SOURCE:
                of_table = of_table.filter(F.col(column) == row[column])
            found.append((binding, of_table))
        return found

    def _each(self, units: DataFrame, work: Callable[[Binding, DataFrame], DataFrame]) -> DataFrame:
        """The same work on every table of ``units``, several tables at a time; results in one DataFrame."""
        done = for_each_table(self.spark, lambda table: work(*table), self._tables(units), self.tables_at_once)
        return reduce(DataFrame.unionByName, [d.select(*units.columns) for d in done], units.filter(F.lit(False)))

    def _found_units(self) -> DataFrame:
        raise NotImplementedError

    def _loadable(self) -> DataFrame:
        raise NotImplementedError

    def _checked(self, binding: Binding, units: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _cleanable(self, owner: str | None, table: str | None) -> DataFrame:
        raise NotImplementedError

    def _cleanup_table(self, binding: Binding) -> str:
        raise NotImplementedError

    def discover(self, execute: bool = False, target_owner: str | None = None, target_table: str | None = None):
        with self._run("DISCOVER", execute) as run:
            units = op.scope(op.undiscovered(self._found_units(), self.ledger()), target_owner, target_table)
            if self.target_template is not None:
                units = op.resolve_targets(units, self.target_template())
            units = settle(units, "found")
            lost = units.filter("subpartition_name IS NULL").select(*UNIT_KEY).first()
            if lost is not None and execute:
                raise ValueError(f"target subpartition not found by list value for {tuple(lost)}")
            if execute:
                events = settle(op.discover_events(units, self.layer, run.run_id, self._now()), "discovered")
                op.require_valid(events, self.ledger(), self.config, self.runs(), self.layer)
                self.append_units(events)
            state = units.withColumns(
                {
                    **{s: F.lit("N") for s in self.layer.statuses},
                    "source_rows": F.lit(None).cast("long"),
                    "target_rows": F.lit(None).cast("long"),
                }
            )
            return self._report(run, "DISCOVER", state, execute, log=execute)

    def load(self, execute: bool = False, target_owner: str | None = None, target_table: str | None = None):
        """ARCHIVE or REPLICATE: replace the units in the target, one job per table."""
        step = self.layer.load_step
        with self._run(step, execute) as run:
            units = settle(op.scope(self._loadable(), target_owner, target_table), "loadable")
            state = units
            if execute:
                state = self._each(units, lambda binding, of_table: self._load_claimed(run, binding, of_table))
            return self._report(run, step, state, execute, log=execute)

    def _load_claimed(self, run: Run, binding: Binding, units: DataFrame) -> DataFrame:
        """Load the units of one table that are still due once the table is claimed; what another run has claimed stays
        as it is, what one has loaded meanwhile is left out."""
        with self._claimed(run, binding.target) as mine:
            if not mine:
                return units
            due = settle(units.join(self._loadable().select(*UNIT_KEY), UNIT_KEY, "left_semi").select(*units.columns), "due")
            gone = units.count() - due.count()
            if gone:
                run.messages.append(f"{gone} units of {binding.target} were loaded by another run meanwhile")
                run.left_to_others = True
            loaded = self._load_table(run, binding, due)
            return loaded.withColumns({self.layer.load_status: F.lit("Y"), "quality_status": F.lit("N")})

    def _load_table(self, run: Run, binding: Binding, units: DataFrame) -> DataFrame:
        self.append_units(op.mark_units(units, self.layer, "N", run.run_id, self._now(), seq=0))
        source = read_source(self.spark, binding.source)
        loaded = op.load_units(source, units, binding.target, binding.key, binding.list_col, binding.cluster_by)
        counted = settle(
            units.drop("target_rows").join(loaded.withColumnRenamed("n", "target_rows"), UNIT_KEY), "loaded"
        )
        self.append_units(
            op.mark_units(counted, self.layer, "Y", run.run_id, self._now(), rows=F.col("target_rows"), seq=1)
        )
        return counted

    def quality(self, execute: bool = False, target_owner: str | None = None, target_table: str | None = None):
        with self._run("QUALITY", execute) as run:
            pending = op.quality_pending(self.ledger(), self.config, self.layer)
            units = settle(op.scope(pending, target_owner, target_table), "unchecked")
            checked = settle(self._each(units, self._checked), "checked")
            if execute:
                said = ["quality_status", "source_rows", "target_rows", "error_message"]
                self.append_units(
                    op.unit_events(
                        checked, self.layer, run.run_id, self._now(), seq=2, **{c: F.col(c) for c in said}
                    )
                )
            return self._report(run, "QUALITY", checked, execute)

    def cleanup(self, execute: bool = False, target_owner: str | None = None, target_table: str | None = None):
        """TRUNCATE of the source or PURGE of the replica."""
        step = self.layer.cleanup_step
        with self._run(step, execute) as run:
            units = settle(self._cleanable(target_owner, target_table), "cleanable")
            free = units.filter("preserve_date IS NULL")
            if execute:
                self._each(free, lambda binding, of_table: self._clean_table(run, binding, of_table))
                done = F.when(F.col("preserve_date").isNull(), "Y").otherwise(F.col(self.layer.cleanup_status))
                units = units.withColumn(self.layer.cleanup_status, done)
            return self._report(run, step, units, execute)

    def _clean_table(self, run: Run, binding: Binding, units: DataFrame) -> DataFrame:
        table = self._cleanup_table(binding)
        if op.laid_out_by_unit(self.spark.table(table)):
            op.cleanup_units(table, units, "TRUNCATE", execute=True)
        else:
            op.truncate_flat_source(table, units, binding.key, binding.list_col, execute=True)
        self.append_units(op.cleanup_events(units, self.layer, run.run_id, self._now()))
        return units

    def run_all(
        self,
        execute: bool = False,
        stop_after: str | None = None,
        cleanup_execute: bool = False,
        target_owner: str | None = None,
        target_table: str | None = None,
        source: tuple = (None, None, None),
    ) -> dict[str, DataFrame]:
        """M8, M9: the steps in order, up to ``stop_after``. The cleanup has a switch of its own.

        Returns the summary of every step that ran.
        """
        stop = (stop_after or "").strip().upper() or self.default_stop
        if stop is not None and stop not in self.layer.steps:
            raise ValueError(f"unsupported stop step: {stop_after}")
        done: dict[str, DataFrame] = {}
        with self._run("RUNNER", execute, source) as run:
            for step, work in zip(self.layer.steps, (self.discover, self.load, self.quality, self.cleanup)):
                switch = cleanup_execute if step == self.layer.cleanup_step else execute
                run.messages.append(f"Step {step}" + ("" if switch else " (preview)"))
                done[step] = work(switch, target_owner, target_table)
                if step == stop:
                    break
        self.compact()
        return done


class ArchiveLifecycle(Lifecycle):
    """Source tables to the archive."""

    layer = ARCHIVE
    default_stop = "QUALITY"

    def __init__(
        self,
        *args,
        catalog: Callable[[], DataFrame],
        rules: Callable[[], DataFrame] | None = None,
        **kwargs,
    ) -> None:
        """catalog: the current source units. rules: executed preserve rules (``rule_rows``), for rules that are kept
        elsewhere; by default the texts in ``preserve_rule`` of the config are executed."""
        super().__init__(*args, **kwargs)
        self.catalog = catalog
        self.rules = rules

    def _found_units(self) -> DataFrame:
        return op.source_units(self.config, self.catalog())

    def _loadable(self) -> DataFrame:
        return op.archivable(self.ledger(), self.dated_config())

    def _checked(self, binding: Binding, units: DataFrame) -> DataFrame:
        """A source laid out by unit is counted as it lies, since that is what a cleanup removes: a row that lies in
        a unit it does not belong to is a mismatch. Another source is counted by its keys."""
        if binding.source_store is not None and op.laid_out_by_unit(self.spark.table(binding.source_store)):
            counts = op.stored_row_counts(self.spark.table(binding.source_store), units)
        else:
            source = read_source(self.spark, binding.source)
            counts = op.unit_row_counts(source, units, binding.key, binding.list_col)
        return op.reconcile_recorded(units, counts)

    def _cleanable(self, owner: str | None, table: str | None) -> DataFrame:
        """Units to truncate with the dates that keep some of them. Only rules of tables in scope are executed; one
        without a usable result stops the cleanup before anything is done."""
        config = op.scope(self.config, owner, table)
        rows = settle(self.rules() if self.rules is not None else op.configured_rules(config), "rule_rows")
        bad = op.preserve_status(config, rows).filter("preserve_calc LIKE 'ERROR:%'").count()
        if bad:
            raise ValueError(f"the preserve rule of {bad} table(s) has no usable result; nothing was cleaned up")
        units = op.scope(op.truncatable(self.ledger(), self.dated_config()), owner, table)
        return op.preserve_match(units, op.preserve_dates(config, rows))

    def _cleanup_table(self, binding: Binding) -> str:
        if binding.source_store is None:
            raise ValueError(f"no table is bound behind the source of {binding.target}; it cannot be cleaned up here")
        return binding.source_store

    def run_table(
        self,
        source_link: str,
        source_owner: str,
        source_table: str,
        execute: bool = False,
        stop_after: str | None = None,
        cleanup_execute: bool = False,
    ) -> dict[str, DataFrame]:
        """M8 for one enabled source table."""
        source = tuple(n.strip().upper() for n in (source_link, source_owner, source_table))
        wanted = self.config.filter("enabled_flag = 'Y'")
        for column, name in zip(SOURCE, source):
            wanted = wanted.filter(F.col(column) == name)
        row = wanted.select(*TARGET).first()
        if row is None:
            raise ValueError(f"no enabled table {'.'.join(source)}")
        return self.run_all(execute, stop_after, cleanup_execute, row[0], row[1], source)


class ReplicaLifecycle(Lifecycle):
    """Confirmed archive units to a replica that keeps a bounded window."""

    layer = REPLICA
    default_stop = None

    def __init__(self, *args, archive_ledger: Callable[[], DataFrame], **kwargs) -> None:
        super().__init__(*args, **kwargs)
        self.archive_ledger = archive_ledger

    def _run_link(self, link: str | None) -> str | None:
        if link is not None:
            return link
        links = self.config.filter("enabled_flag = 'Y'").agg(
            F.min("source_link").alias("link"), F.countDistinct("source_link").alias("n")
        )
        row = links.first()
        if row["n"] != 1:
            raise ValueError(f"a replica run needs exactly one enabled archive link; found {row['n']}")
        return row["link"]

    def _found_units(self) -> DataFrame:
        units = op.replica_source_units(self.archive_ledger(), self.config)
        return units.drop("days_online", "base_date", "cutoff_date")

    def _bases(self) -> DataFrame:
        return op.base_dates(op.replica_source_units(self.archive_ledger(), self.config))

    def _loadable(self) -> DataFrame:
        return op.replicable(self.ledger(), self.config, self._bases())

    def _checked(self, binding: Binding, units: DataFrame) -> DataFrame:
        source = read_source(self.spark, binding.source)
        source_counts = op.unit_row_counts(source, units, binding.key, binding.list_col)
        target_counts = op.stored_row_counts(self.spark.table(binding.target), units)
        return op.reconcile_recounted(units, source_counts, target_counts)

    def _cleanable(self, owner: str | None, table: str | None) -> DataFrame:
        units = op.scope(op.purgeable(self.ledger(), self.config, self._bases()), owner, table)
        return units.withColumn("preserve_date", F.lit(None).cast("date"))

    def _cleanup_table(self, binding: Binding) -> str:
        return binding.target
