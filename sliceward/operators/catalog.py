"""The unit catalog. A unit is a date range, optionally narrowed to a list of values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sliceward.functions import high_value_date, list_values, partition_hv, subpartition_hv
from sliceward.schema import BOUNDS, HIGH_VALUES, NO_SUBPARTITION, PARTITION, SOURCE, SUBPARTITION

UNIT_COLUMNS = SOURCE + HIGH_VALUES + ["partition_name", "subpartition_name", "unit_type"] + BOUNDS + ["position"]


def _with_previous_bound(partitions: DataFrame) -> DataFrame:
    """Attach the high of the partition before. A group is one table's partition list, not its rows."""
    by_position = Window.partitionBy(*SOURCE).orderBy("position")
    return partitions.withColumn("low", F.lag("high").over(by_position))


def unit_catalog(partitions: DataFrame, subpartitions: DataFrame | None = None) -> DataFrame:
    """Units of the declared partitions.

    partitions: source columns, partition_name, high_value (text), position.
    subpartitions: source columns, partition_name, subpartition_name, subpartition_high_value (text).
    """
    bounded = partitions.select(
        *SOURCE,
        "partition_name",
        "position",
        partition_hv(F.col("high_value")).alias("partition_hv"),
        high_value_date(F.col("high_value")).alias("high"),
    )
    bounded = _with_previous_bound(bounded)
    if subpartitions is None:
        return _as_units(
            bounded.withColumns(
                {
                    "subpartition_name": F.lit(None).cast("string"),
                    "list_values": F.lit(None).cast("array<string>"),
                }
            )
        )
    lists = subpartitions.select(
        *SOURCE,
        "partition_name",
        "subpartition_name",
        list_values(F.col("subpartition_high_value")).alias("list_values"),
    )
    return _as_units(bounded.join(lists, SOURCE + ["partition_name"], "left"))


def _as_units(bounded: DataFrame) -> DataFrame:
    whole = F.col("subpartition_name").isNull()
    return bounded.withColumns(
        {
            "unit_type": F.when(whole, PARTITION).otherwise(SUBPARTITION),
            "subpartition_hv": subpartition_hv(F.col("list_values")),
            "subpartition_name": F.coalesce("subpartition_name", F.lit(NO_SUBPARTITION)),
        }
    ).select(*UNIT_COLUMNS)


def interval_units(df: DataFrame, key: str, source: tuple[str, str, str], every: str = "day") -> DataFrame:
    """S3: units that exist because data exists, one per day or month holding a row, named P + first day.

    ``df`` is reduced to its distinct intervals on the map side, so the shuffle carries one row per interval
    and task.
    """
    if every not in ("day", "month"):
        raise ValueError(f"unsupported interval: {every}")
    first = F.to_date(key) if every == "day" else F.trunc(F.to_date(key), "month")
    after = F.date_add("first_day", 1) if every == "day" else F.add_months("first_day", 1)
    link, owner, table = source
    intervals = (
        df.select(first.alias("first_day"))
        .distinct()
        .filter(F.col("first_day").isNotNull())
        .select(
            F.lit(link).alias("source_link"),
            F.lit(owner).alias("source_owner"),
            F.lit(table).alias("source_table"),
            F.concat(F.lit("P"), F.date_format("first_day", "yyyyMMdd")).alias("partition_name"),
            "first_day",
            after.alias("high"),
        )
    )
    by_bound = Window.partitionBy(*SOURCE).orderBy("high")
    numbered = intervals.withColumns(
        {
            "position": F.row_number().over(by_bound),
            "low": F.col("first_day"),
            "partition_hv": F.col("high").cast("string"),
            "subpartition_name": F.lit(None).cast("string"),
            "list_values": F.lit(None).cast("array<string>"),
        }
    )
    return _as_units(numbered)


def list_subunits(units: DataFrame, groups: DataFrame) -> DataFrame:
    """Every partition of a table gets every list group of that table's template.

    groups: source columns, subpartition_name, list_values. Tables without a template keep whole partitions.
    """
    template = groups.select(*SOURCE, "subpartition_name", "list_values")
    bare = units.drop("subpartition_hv", "subpartition_name", "unit_type", "list_values")
    return _as_units(bare.join(template, SOURCE, "left"))
