"""Which units a step works on. Every function maps DataFrames to a DataFrame.

The comparison signs differ on purpose: load below the business date is strict, cleanup at the limit is
included, replication needs to lie strictly above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceward.functions import business_date
from sliceward.schema import (
    ARCHIVE,
    BOUNDS,
    HIGH_VALUES,
    MAXVALUE,
    NAMES,
    REPLICA,
    SOURCE,
    TARGET,
    UNIT_KEY,
    Layer,
)


def _enabled(config: DataFrame) -> DataFrame:
    return config.filter(F.col("enabled_flag") == "Y")


def _ledger_with(ledger: DataFrame, config: DataFrame, *policy: str) -> DataFrame:
    """Ledger rows of enabled tables with the table's policy columns. A table without a last business date is an
    error where that date decides: taking nothing from it would look like nothing to do."""
    known = {"last_business_date": business_date(F.col("last_business_date").cast("string")).alias("last_business_date")}
    return ledger.join(_enabled(config).select(*SOURCE, *[known.get(c, F.col(c)) for c in policy]), SOURCE)


def source_units(config: DataFrame, catalog: DataFrame) -> DataFrame:
    """Catalog units of enabled tables, with their target. Units without an upper bound are left out."""
    tables = _enabled(config).select(*SOURCE, *TARGET)
    return (
        catalog.filter(F.upper(F.trim("partition_hv")) != MAXVALUE)
        .join(tables, SOURCE)
        .select(
            *SOURCE,
            *TARGET,
            "unit_type",
            F.col("partition_name").alias("source_partition_name"),
            F.col("subpartition_name").alias("source_subpartition_name"),
            "partition_name",
            "subpartition_name",
            *HIGH_VALUES,
            *BOUNDS,
            "position",
        )
    )


def undiscovered(units: DataFrame, ledger: DataFrame) -> DataFrame:
    """C2, both layers: units the ledger does not know."""
    return units.join(ledger.select(*UNIT_KEY), UNIT_KEY, "left_anti")


def archivable(ledger: DataFrame, config: DataFrame) -> DataFrame:
    """Not yet archived and closed before the last business date."""
    open_units = ledger.filter(F.col("archive_status") == "N")
    return _ledger_with(open_units, config, "last_business_date").filter(
        F.col("high") < F.col("last_business_date")
    )


def quality_pending(ledger: DataFrame, config: DataFrame, layer: Layer = ARCHIVE) -> DataFrame:
    """C4, both layers: loaded and not yet confirmed."""
    waiting = ledger.filter((F.col(layer.load_status) == "Y") & (F.col("quality_status") == "N"))
    return _ledger_with(waiting, config)


def truncatable(ledger: DataFrame, config: DataFrame) -> DataFrame:
    """Confirmed units at or below the online window of the source."""
    confirmed = ledger.filter(
        (F.col("archive_status") == "Y") & (F.col("quality_status") == "Y") & (F.col("truncate_status") == "N")
    )
    return (
        _ledger_with(confirmed, config, "last_business_date", "days_online")
        .withColumn("cutoff_date", F.date_sub("last_business_date", F.col("days_online")))
        .filter(F.col("high") <= F.col("cutoff_date"))
    )


def replica_source_units(archive_ledger: DataFrame, replica_config: DataFrame) -> DataFrame:
    """Confirmed archive units of the tables the replica follows.

    base_date is the newest confirmed bound of the table, not today. It is a per-table maximum joined back
    rather than a window, so a table with most of the units is not handled by one task.
    """
    tables = _enabled(replica_config).select(
        *SOURCE, *TARGET, "days_online"
    )
    confirmed = archive_ledger.filter(
        (F.col("archive_status") == "Y")
        & (F.col("quality_status") == "Y")
        & (F.upper(F.trim("partition_hv")) != MAXVALUE)
    ).select(
        F.col("target_owner").alias("source_owner"),
        F.col("target_table").alias("source_table"),
        "unit_type",
        F.col("partition_name").alias("source_partition_name"),
        F.col("subpartition_name").alias("source_subpartition_name"),
        "partition_name",
        "subpartition_name",
        *HIGH_VALUES,
        *BOUNDS,
    )
    units = confirmed.join(tables, ["source_owner", "source_table"])
    return (
        units.join(base_dates(units), SOURCE)
        .withColumn("cutoff_date", F.date_sub("base_date", F.col("days_online")))
        .select(
            *SOURCE,
            *TARGET,
            "unit_type",
            *NAMES,
            *HIGH_VALUES,
            *BOUNDS,
            "days_online",
            "base_date",
            "cutoff_date",
        )
    )


def base_dates(units: DataFrame) -> DataFrame:
    return units.groupBy(*SOURCE).agg(F.max("high").alias("base_date"))


def _with_cutoff(ledger: DataFrame, config: DataFrame, bases: DataFrame) -> DataFrame:
    return (
        _ledger_with(ledger, config, "days_online")
        .join(bases.select(*SOURCE, "base_date"), SOURCE)
        .withColumn("cutoff_date", F.date_sub("base_date", F.col("days_online")))
    )


def replicable(ledger: DataFrame, config: DataFrame, bases: DataFrame) -> DataFrame:
    """C11: untouched replica units strictly inside the replica's window."""
    untouched = ledger.filter(" AND ".join(f"{s} = 'N'" for s in REPLICA.statuses))
    return _with_cutoff(untouched, config, bases).filter(F.col("high") > F.col("cutoff_date"))


def purgeable(ledger: DataFrame, config: DataFrame, bases: DataFrame) -> DataFrame:
    """Confirmed replica units at or below the replica's window."""
    confirmed = ledger.filter(
        (F.col("replica_status") == "Y") & (F.col("quality_status") == "Y") & (F.col("purge_status") == "N")
    )
    return _with_cutoff(confirmed, config, bases).filter(F.col("high") <= F.col("cutoff_date"))


def scope(df: DataFrame, target_owner: str | None = None, target_table: str | None = None) -> DataFrame:
    """Optional restriction of a step to one target owner or table; names are matched in upper case."""
    for column, wanted in (("target_owner", target_owner), ("target_table", target_table)):
        if wanted is not None and wanted.strip():
            df = df.filter(F.col(column) == wanted.strip().upper())
    return df


def scoped_tables(df: DataFrame, target_owner: str | None = None, target_table: str | None = None) -> DataFrame:
    """The distinct tables of a step in working order."""
    return scope(df, target_owner, target_table).select(*SOURCE, *TARGET).distinct().orderBy(*SOURCE)
