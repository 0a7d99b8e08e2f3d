"""Counters and summaries of a step, and the declared constraints of the control tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sliceward.functions import summary_cell
from sliceward.schema import (
    ARCHIVE,
    HIGH_VALUES,
    NAMES,
    NO_SUBPARTITION,
    PARTITION,
    REPLICA,
    RUN_STATUSES,
    SOURCE,
    SUBPARTITION,
    TARGET,
    UNIT_KEY,
    Layer,
)
from sliceward.sources.stored import settle


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def step_counters(units: DataFrame, step: str, layer: Layer = ARCHIVE, execute: bool = False) -> DataFrame:
    """A4: totals of one step over the units it worked on, as one row. Only failed units make it a WARNING."""
    _known_step(step, layer)
    done = F.count(F.lit(1)) if execute else F.lit(0).cast("long")
    nothing = F.lit(0).cast("long")
    counters = {
        "tables": F.countDistinct(*SOURCE),
        "partitions": F.countDistinct(*SOURCE, "partition_hv"),
        "units": F.count(F.lit(1)),
        "ok": nothing,
        "failed": nothing,
        "done": done,
        "preserved": nothing,
    }
    if step == "QUALITY":
        counters["ok"] = _count_if(F.col("quality_status") == "Y")
        counters["failed"] = _count_if(F.col("quality_status") == "N")
        counters["done"] = nothing
    if step == "TRUNCATE":
        counters["preserved"] = _count_if(F.col("preserve_date").isNotNull())
        counters["done"] = _count_if(F.col("preserve_date").isNull()) if execute else nothing
    totals = units.agg(*[c.alias(name) for name, c in counters.items()])
    return totals.select(
        F.lit(step).alias("step"),
        "*",
        F.when(F.col("failed") > 0, "WARNING").otherwise("SUCCESS").alias("run_status"),
    )


def _known_step(step: str, layer: Layer) -> None:
    if step not in layer.steps:
        raise ValueError(f"unsupported {layer.name} step: {step}")


def step_note(step: str, layer: Layer, execute: bool) -> Column:
    """First cell of a summary row: what happened to the unit. The texts of the notes."""
    _known_step(step, layer)
    if step == "DISCOVER":
        return F.col("unit_type")
    if step == layer.load_step:
        return F.lit("EXCHANGED" if execute else "PREVIEW")
    if step == "QUALITY":
        return F.when(F.col("quality_status") == "Y", "OK").otherwise("MISMATCH")
    if step == "PURGE":
        return F.lit("PURGED" if execute else "PREVIEW")
    kept = F.concat(F.lit("PRESERVED per MAX_preserve_date="), F.date_format("preserve_date", "yyyy-MM-dd"))
    return F.coalesce(kept, F.lit("TRUNCATED" if execute else "SKIP"))


def step_summary(units: DataFrame, step: str, layer: Layer = ARCHIVE, execute: bool = False) -> DataFrame:
    """A5: one row of text cells per unit, in working order; units carry the state after the step.

    The truncate status printed for a preserved unit is its real one.
    """
    cells = {"note": step_note(step, layer, execute)}
    cells.update({c: F.col(c) for c in NAMES + HIGH_VALUES + layer.statuses + ["source_rows", "target_rows"]})
    if step == "TRUNCATE":
        cells["max_preserve_date"] = F.date_format("preserve_date", "yyyy-MM-dd")
    return units.orderBy(*SOURCE, "high", "subpartition_hv").select(
        *SOURCE, *[summary_cell(c).alias(name) for name, c in cells.items()]
    )


def _broken(rows: DataFrame, key: list[str], rules: dict[str, Column]) -> DataFrame:
    """Row-level rules in one pass: a rule is broken unless it is known to hold."""
    names = F.array(*[F.when(~F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()])
    return rows.select(F.explode(F.array_compact(names)).alias("constraint_name"), _key_text(key).alias("key_text"))


def _key_text(key: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in key])


def _duplicates(rows: DataFrame, key: list[str], name: str) -> DataFrame:
    return (
        rows.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.lit(name).alias("constraint_name"), _key_text(key).alias("key_text"), "n")
    )


def _orphans(rows: DataFrame, parents: DataFrame, key: list[str], parent_key: list[str], name: str) -> DataFrame:
    """References without a parent. A reference with a NULL part refers to nothing and passes."""
    parent = parents.select(*[F.col(p).alias(k) for k, p in zip(key, parent_key)])
    return (
        rows.dropna(subset=key)
        .join(parent, key, "left_anti")
        .select(F.lit(name).alias("constraint_name"), _key_text(key).alias("key_text"))
    )


def ledger_violations(ledger: DataFrame, config: DataFrame, runs: DataFrame, layer: Layer = ARCHIVE) -> DataFrame:
    """Every broken constraint of ledger, config and runs as (constraint_name, key_text, n)."""
    # Runs are often a fold over their events; it is done once for all rules.
    runs = settle(runs.select("run_id", *SOURCE, "run_type", "run_status", "execute_flag"), "runs")
    whole = F.col("unit_type") == PARTITION

    def marks(column: str) -> Column:
        return whole == (F.col(column) == NO_SUBPARTITION)

    unit_rules = {
        "unit_type": F.col("unit_type").isin(PARTITION, SUBPARTITION),
        "source_subpartition_mark": marks("source_subpartition_name"),
        "subpartition_mark": marks("subpartition_name"),
        "subpartition_hv_mark": marks("subpartition_hv"),
        **{f"{s}_flag": F.col(s).isin("Y", "N") for s in layer.statuses},
    }
    config_rules = {
        "config_enabled_flag": F.col("enabled_flag").isin("Y", "N"),
        "config_source_link": ~F.upper(F.trim("source_link")).isin("LOCAL", "NONE"),
    }
    if layer is REPLICA:
        config_rules["config_days_online"] = F.col("days_online") >= 0
    run_rules = {
        "run_type": F.col("run_type").isin(*layer.processes),
        "run_status": F.col("run_status").isin(*RUN_STATUSES),
        "run_execute_flag": F.col("execute_flag").isin("Y", "N"),
    }
    single = [
        _broken(ledger, UNIT_KEY, unit_rules),
        _broken(config, SOURCE, config_rules),
        _broken(runs, ["run_id"], run_rules),
        _orphans(ledger, config, SOURCE, SOURCE, "unit_config_reference"),
        _orphans(ledger, runs, ["last_run_id"], ["run_id"], "unit_run_reference"),
        _orphans(runs, config, SOURCE, SOURCE, "run_config_reference"),
    ]
    counted = [
        _duplicates(ledger, UNIT_KEY, "unit_key"),
        _duplicates(ledger, TARGET + HIGH_VALUES, "unit_target_key"),
        _duplicates(config, SOURCE, "config_key"),
        _duplicates(config, TARGET, "config_target_key"),
        _duplicates(runs, ["run_id"], "run_key"),
    ]
    if layer is REPLICA:
        links = config.filter(F.col("enabled_flag") == "Y").agg(F.countDistinct("source_link").alias("n"))
        counted.append(
            links.filter("n <> 1").select(
                F.lit("single_source_link").alias("constraint_name"), F.lit("config").alias("key_text"), "n"
            )
        )
    rows = reduce(DataFrame.unionByName, single).groupBy("constraint_name", "key_text").agg(
        F.count(F.lit(1)).alias("n")
    )
    return reduce(DataFrame.unionByName, counted, rows)


def rejected_events(
    events: DataFrame, ledger: DataFrame, config: DataFrame, runs: DataFrame, layer: Layer = ARCHIVE
) -> DataFrame:
    """A6 before a write: every event of a batch that would break a constraint of the ledger, as (unit key, seq,
    constraint_name).

    events: ledger events; one with a unit_type describes a new unit. ledger, config, runs: the state the batch meets.
    What an event does not say is not checked. A NULL part of the unit key, a unit that is described though it is known or
    twice, two units with one target, an event about a unit that neither the ledger nor the batch describes, and a unit or
    run without its config or run row are rejected. An empty batch has nothing to reject.
    """
    said = {s: F.col(s).isNull() | F.col(s).isin("Y", "N") for s in layer.statuses}
    whole = F.col("unit_type") == PARTITION
    rules = {
        "unit_key_known": reduce(Column.__and__, [F.col(c).isNotNull() for c in UNIT_KEY]),
        "unit_type": F.col("unit_type").isNull() | F.col("unit_type").isin(PARTITION, SUBPARTITION),
        "subpartition_hv_mark": F.col("unit_type").isNull() | (whole == (F.col("subpartition_hv") == NO_SUBPARTITION)),
        **{f"{s}_flag": rule for s, rule in said.items()},
    }
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(r, F.lit(False)), F.lit(n)) for n, r in rules.items()]))
    key = [*UNIT_KEY, "seq"]
    new = events.filter(F.col("unit_type").isNotNull())

    def found(rows: DataFrame, name: str) -> DataFrame:
        return rows.select(*key, F.lit(name).alias("constraint_name"))

    def twice(columns: list[str]) -> DataFrame:
        counts = new.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*columns)
        return new.join(counts, columns, "left_semi")

    target = TARGET + HIGH_VALUES
    other = ledger.select(*target, *[F.col(c).alias(f"held_{c}") for c in UNIT_KEY if c not in HIGH_VALUES])
    differs = reduce(Column.__or__, [F.col(c) != F.col(f"held_{c}") for c in UNIT_KEY if c not in HIGH_VALUES])
    described = ledger.select(*UNIT_KEY).unionByName(new.select(*UNIT_KEY))
    parts = [
        events.select(*key, F.explode(broken).alias("constraint_name")),
        found(new.join(ledger.select(*UNIT_KEY), UNIT_KEY, "left_semi"), "unit_key"),
        found(twice(UNIT_KEY), "unit_key"),
        found(new.join(other, target).filter(differs), "unit_target_key"),
        found(twice(target).join(twice(UNIT_KEY).select(*UNIT_KEY).distinct(), UNIT_KEY, "left_anti"), "unit_target_key"),
        found(events.dropna(subset=UNIT_KEY).join(described, UNIT_KEY, "left_anti"), "unit_described"),
        found(new.dropna(subset=SOURCE).join(config.select(*SOURCE), SOURCE, "left_anti"), "unit_config_reference"),
        found(events.join(runs.select(F.col("run_id").alias("last_run_id")), "last_run_id", "left_anti"), "unit_run_reference"),
    ]
    return reduce(DataFrame.unionByName, parts).distinct()


def require_valid(events: DataFrame, ledger: DataFrame, config: DataFrame, runs: DataFrame, layer: Layer = ARCHIVE) -> None:
    """Raise if a batch has an event that would break a constraint. The batch should be stored rows."""
    rejected = rejected_events(events, ledger, config, runs, layer)
    first = rejected.orderBy("constraint_name", *UNIT_KEY, "seq").first()
    if first is not None:
        raise ValueError(f"a batch of events was not appended: {first['constraint_name']} is broken for {tuple(first)[:-2]}, among others")
