"""A1-A3: row counts per unit and their reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sliceward.functions import flag
from sliceward.operators.assign import assign_units, only_units, source_of_units, unit_extent, within_extent
from sliceward.schema import HIGH_VALUES, MISMATCH_MESSAGE, UNIT_KEY


def day_histogram(df: DataFrame, key: str, list_col: str | None = None) -> DataFrame:
    """Rows per (day, list value). Only the key columns are scanned, and every task sends one row per pair it
    saw, so a hot day or value costs nothing extra."""
    columns = [F.to_date(key).alias(key)] + ([F.col(list_col)] if list_col else [])
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("day_rows"))


def unit_row_counts(df: DataFrame, units: DataFrame, key: str, list_col: str | None = None) -> DataFrame:
    """A1: (unit key, n) for every unit of one table, 0 for a unit without rows.

    The rows are counted per day first; only the day counts meet the units.
    """
    extent = unit_extent(units)
    rows = within_extent(source_of_units(df, units, extent), key, extent)
    days = day_histogram(rows, key, list_col)
    per_day = assign_units(days, units, key, list_col, extent=extent)
    return zero_filled(units, per_day.groupBy(*HIGH_VALUES).agg(F.sum("day_rows").alias("n")))


def stored_row_counts(stored: DataFrame, units: DataFrame) -> DataFrame:
    """A1 on a table laid out by unit: the physical rows of each unit.

    Only partition columns are used, so the scan reads the footers of the units' files and no data pages.
    """
    held = only_units(stored, units, unit_extent(units))
    return zero_filled(units, held.groupBy(*HIGH_VALUES).agg(F.count(F.lit(1)).alias("n")))


def zero_filled(units: DataFrame, counts: DataFrame) -> DataFrame:
    """(unit key, n) for every unit, 0 for one without a count."""
    return units.select(*UNIT_KEY).join(counts, HIGH_VALUES, "left").select(
        *UNIT_KEY, F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def _compared(df: DataFrame) -> DataFrame:
    equal = F.col("source_rows") == F.col("target_rows")
    return df.withColumns(
        {
            "quality_status": flag(equal),
            "error_message": F.when(flag(equal) == "N", MISMATCH_MESSAGE),
        }
    )


def reconcile_recorded(ledger: DataFrame, source_counts: DataFrame) -> DataFrame:
    """A2: recount of the source against the recorded load; an unknown count on either side is a mismatch."""
    counts = source_counts.select(*UNIT_KEY, F.col("n").alias("source_rows"))
    recorded = ledger.drop("source_rows", "quality_status", "error_message")
    return _compared(recorded.join(counts, UNIT_KEY, "left"))


def reconcile_recounted(units: DataFrame, source_counts: DataFrame, target_counts: DataFrame) -> DataFrame:
    """A3: recount of both sides; both counts are kept."""
    source = source_counts.select(*UNIT_KEY, F.col("n").alias("source_rows"))
    target = target_counts.select(*UNIT_KEY, F.col("n").alias("target_rows"))
    bare = units.drop("source_rows", "target_rows", "quality_status", "error_message")
    return _compared(bare.join(source, UNIT_KEY, "left").join(target, UNIT_KEY, "left"))
