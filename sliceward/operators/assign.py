"""Which unit a row belongs to.

Bounds are whole days, so "low <= key < high and value in list" is an equi-join on calendar cells: a block of years, a
year, a month or a day that no bound cuts. Every day lies in exactly one cell, every unit is a whole number of cells, and
rows are matched on (cell, list value). A unit of two centuries is some blocks and years, a month is one cell, and only
months that a bound cuts are written out as days. The pairs are few, whatever the number of rows, and their size is
worked out from the units before they are broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, timedelta

import numpy as np
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from sliceward.schema import HIGH_VALUES

# Above this size the (cell, value) pairs are shuffled to the rows instead of broadcast.
BROADCAST_BYTES = 64 * 1024 * 1024
_PAIR_OVERHEAD = 64

_CELL, _VALUE = "__unit_cell", "__unit_value"
_EPOCH = date(1970, 1, 1)
#: Years of the largest cell.
_BLOCK = 16


def unit_extent(units: DataFrame) -> Row:
    """First and last declared bound, open ends, the calendar periods that bounds cut and the size of the pairs, as one
    row of scalars."""
    low, high = F.unix_date("low"), F.unix_date("high")
    cut = {
        f"{name}_{end}": F.collect_set(F.when(F.col(end) != start(F.col(end)), period(F.col(end))))
        for end in ("low", "high")
        for name, period, start in (
            ("blocks", _block, lambda d: F.make_date(_block(d) * _BLOCK, F.lit(1), F.lit(1))),
            ("years", F.year, lambda d: F.make_date(F.year(d), F.lit(1), F.lit(1))),
            ("months", _month, lambda d: F.make_date(F.year(d), F.month(d), F.lit(1))),
        )
    }
    # A value is never longer than the text of its list.
    width = F.length("partition_hv") + F.length("subpartition_hv") * 2 + F.lit(_PAIR_OVERHEAD)
    extent = (
        units.agg(
            F.min(F.coalesce(F.least(low, high), low, high)).alias("first"),
            F.max(F.coalesce(F.greatest(low, high), low, high)).alias("last"),
            F.count(F.when(F.col("low").isNull(), 1)).alias("open_low"),
            F.count(F.when(F.col("high").isNull(), 1)).alias("open_high"),
            F.count(F.when(F.col("list_values").isNull(), 1)).alias("whole"),
            F.count("list_values").alias("listed"),
            F.size(F.array_distinct(F.flatten(F.collect_set("list_values")))).alias("values"),
            F.max(width).alias("width"),
            F.min("partition_hv").alias("first_hv"),
            F.max("partition_hv").alias("last_hv"),
            *[column.alias(name) for name, column in cut.items()],
        )
    ).first()
    pair_bytes = Calendar.of(extent).most_cells() * max(extent["values"] or 0, 1) * (extent["width"] or 0)
    return Row(**extent.asDict(), pair_bytes=pair_bytes)


def _block(day: Column) -> Column:
    return F.floor(F.year(day) / _BLOCK).cast("int")


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


@dataclass(frozen=True)
class Calendar:
    """The days from ``first`` to ``last`` in cells; blocks, years and months are those that a bound cuts."""

    first: int
    last: int
    blocks: frozenset[int]
    years: frozenset[int]
    months: frozenset[int]

    @classmethod
    def of(cls, extent: Row) -> Calendar:
        """Open ends reach one day beyond the declared bounds; these two days are bounds as well."""
        first = (extent["first"] if extent["first"] is not None else 0) - 1
        last = extent["last"] if extent["last"] is not None else 0
        cut = [{*extent[f"{name}_low"], *extent[f"{name}_high"]} for name in ("blocks", "years", "months")]
        for bound in (first, last + 1):
            month = int(np.datetime64(bound, "D").astype("datetime64[M]").astype(int)) + 1970 * 12
            starts = bound == int(np.datetime64(month - 1970 * 12, "M").astype("datetime64[D]").astype(int))
            year = month // 12
            if not starts:
                cut[2].add(month)
            if not starts or month % 12:
                cut[1].add(year)
            if not starts or month % (12 * _BLOCK):
                cut[0].add(year // _BLOCK)
        return cls(first, last, *map(frozenset, cut))

    def most_cells(self) -> int:
        """Not fewer than the cells there are: each cut period is written out as its parts."""
        return (self.last - self.first) // (365 * _BLOCK) + 2 + _BLOCK * len(self.blocks) + 12 * len(self.years) + 31 * len(self.months)

    def cell(self, day: Column) -> Column:
        """The cell of a day, given as days since the epoch; days outside count as the nearest one inside."""
        at = F.date_from_unix_date(F.greatest(F.least(day, F.lit(self.last)), F.lit(self.first)))
        return (
            F.when(~_block(at).isin(*self.blocks), _block(at) * 4)
            .when(~F.year(at).isin(*self.years), F.year(at) * 4 + 1)
            .when(~_month(at).isin(*self.months), _month(at) * 4 + 2)
            .otherwise(F.unix_date(at) * 4 + 3)
        )

    def cells(self, spans: DataFrame) -> DataFrame:
        """A row for each cell between the days ``lo`` and ``hi``, the latter left out."""
        low, high = F.date_from_unix_date("lo"), F.date_from_unix_date(F.col("hi") - 1)
        nothing = F.array(F.lit(None).cast("int"))

        def month_start(month: Column) -> Column:
            return F.unix_date(F.make_date(F.floor(month / 12).cast("int"), F.pmod(month, F.lit(12)) + 1, F.lit(1)))

        def parts(period: str, cut: frozenset[int], start: Column, end: Column, low: Column, high: Column) -> Column:
            inside = F.sequence(F.greatest(start, low), F.least(end, high))
            return F.explode(F.when(F.col(period).isin(*cut), inside).otherwise(nothing))

        b, y, m = F.col("__b"), F.col("__y"), F.col("__m")
        spans = spans.withColumn("__b", F.explode(F.sequence(_block(low), _block(high))))
        spans = spans.withColumn("__y", parts("__b", self.blocks, b * _BLOCK, b * _BLOCK + _BLOCK - 1, F.year(low), F.year(high)))
        spans = spans.withColumn("__m", parts("__y", self.years, y * 12, y * 12 + 11, _month(low), _month(high)))
        spans = spans.withColumn("__d", parts("__m", self.months, month_start(m), month_start(m + 1) - 1, F.col("lo"), F.col("hi") - 1))
        return spans.withColumn(_CELL, F.coalesce(F.col("__d") * 4 + 3, m * 4 + 2, y * 4 + 1, b * 4))


def unit_cells(units: DataFrame, calendar: Calendar, by_list: bool) -> DataFrame:
    """One row per (cell, list value) of every unit.

    Where two units claim a day, the one with the lower high bound keeps it: a row lies in the first range above its key.
    """
    value = F.explode("list_values") if by_list else F.lit("")
    spans = units.select(
        *HIGH_VALUES,
        value.alias(_VALUE),
        F.coalesce(F.unix_date("low"), F.lit(calendar.first)).alias("lo"),
        F.coalesce(F.unix_date("high"), F.lit(calendar.last + 1)).alias("hi"),
    )
    along = Window.partitionBy(_VALUE).orderBy("hi")
    taken = F.lag("hi").over(along)
    spans = spans.withColumn("lo", F.greatest(F.col("lo"), F.coalesce(taken, F.col("lo"))))
    return calendar.cells(spans.filter("lo < hi")).select(*HIGH_VALUES, *([_VALUE] if by_list else []), _CELL)


def within_extent(df: DataFrame, key: str, extent: Row) -> DataFrame:
    """Range filter on the raw key, so that the scan can skip files and row groups."""
    if not extent["open_low"]:
        df = df.filter(F.col(key) >= F.lit(_EPOCH + timedelta(days=extent["first"])))
    if not extent["open_high"]:
        df = df.filter(F.col(key) < F.lit(_EPOCH + timedelta(days=extent["last"])))
    return df


def laid_out_by_unit(df: DataFrame) -> bool:
    return set(HIGH_VALUES) <= set(df.columns)


def only_units(df: DataFrame, units: DataFrame, extent: Row) -> DataFrame:
    """The partitions of ``units`` in a table laid out by unit.

    The range of bounds is a constant filter on the partition column, so that partitions outside it are not
    even listed. Within it a semi join prunes by dynamic partition pruning, which Spark plans only for a
    filtered side; that filter holds for every unit.
    """
    wanted = units.select(*HIGH_VALUES).filter(F.col("partition_hv") > "")
    ranged = df.filter(F.col("partition_hv").between(extent["first_hv"], extent["last_hv"]))
    return ranged.join(wanted, HIGH_VALUES, "left_semi")


def source_of_units(df: DataFrame, units: DataFrame, extent: Row) -> DataFrame:
    """Rows of a source without unit columns, cut down to what ``units`` can need."""
    return only_units(df, units, extent).drop(*HIGH_VALUES) if laid_out_by_unit(df) else df


def assign_units(
    df: DataFrame,
    units: DataFrame,
    key: str,
    list_col: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    extent: Row | None = None,
    outside: bool = False,
) -> DataFrame:
    """``df`` with (partition_hv, subpartition_hv) of its unit; rows outside all units are left out.

    ``units`` are those of one table and should be stored rows (``settle``): their extent is read first.
    With ``outside`` the result is the opposite, the rows of no unit, without unit columns.
    """
    extent = extent or unit_extent(units)
    by_list = list_col is not None
    if by_list and extent["whole"]:
        raise ValueError("a list value is required for every subpartition unit")
    if not by_list and extent["listed"]:
        raise ValueError("subpartition units need the list column")
    calendar = Calendar.of(extent)
    pairs = unit_cells(units, calendar, by_list)
    if extent["pair_bytes"] <= broadcast_bytes:
        pairs = F.broadcast(pairs)

    rows = df if outside else within_extent(source_of_units(df, units, extent), key, extent)
    rows = rows.withColumn(_CELL, calendar.cell(F.unix_date(F.to_date(key))))
    match = rows[_CELL] == pairs[_CELL]
    if by_list:
        match = match & (rows[list_col] == pairs[_VALUE])
    if outside:
        return rows.join(pairs, match, "left_anti").drop(_CELL)
    return rows.join(pairs, match).drop(pairs[_CELL]).drop(_CELL, _VALUE)


def unit_predicate(unit: Mapping, key: str, list_col: str | None = None) -> Column:
    """The row predicate of one unit: half-open day range, optional value list."""
    if unit["high"] is None:
        raise ValueError("a unit slice needs a date as high bound")
    predicate = F.col(key) < F.lit(unit["high"])
    if unit["low"] is not None:
        predicate = predicate & (F.col(key) >= F.lit(unit["low"]))
    if list_col is not None:
        if not unit["list_values"]:
            raise ValueError("a list value is required for a subpartition unit")
        predicate = predicate & F.col(list_col).isin(*unit["list_values"])
    return predicate


def unit_slice(df: DataFrame, unit: Mapping, key: str, list_col: str | None = None) -> DataFrame:
    """The rows of one unit; the predicate reaches the scan."""
    return df.filter(unit_predicate(unit, key, list_col))


def unit_slices(df: DataFrame, units: DataFrame, key: str, list_col: str | None = None) -> DataFrame:
    """S6 for many units: the rows of any of them."""
    return assign_units(df, units, key, list_col).drop(*HIGH_VALUES)


def predicate_text(key: str, list_col: str | None = None) -> Column:
    """The row predicate of a unit as SQL text, for sources that are read by predicates."""
    quoted = F.transform("list_values", lambda v: F.concat(F.lit("'"), F.replace(v, F.lit("'"), F.lit("''")), F.lit("'")))
    parts = [
        F.coalesce(F.concat(F.lit(f"{key} >= DATE '"), F.col("low").cast("string"), F.lit("'")), F.lit(f"{key} IS NOT NULL")),
        F.concat(F.lit(f"{key} < DATE '"), F.col("high").cast("string"), F.lit("'")),
    ]
    if list_col is not None:
        parts.append(F.concat(F.lit(f"{list_col} IN ("), F.array_join(quoted, ", "), F.lit(")")))
    return F.concat(F.lit("("), F.concat_ws(" AND ", *parts), F.lit(")"))


def source_predicates(units: DataFrame, counts: DataFrame, bins: int, key: str, list_col: str | None = None) -> DataFrame:
    """Read partitions for ``units``: bin, units, n and predicate, no two bins apart by more rows than the largest unit.

    counts: (unit key, n), from a catalog, a ledger or an estimate. Units are dealt in turn by falling count: of two bins
    the one that gets its unit first in each turn gets, turn by turn, at least what the other has, and no more than that
    plus what the next turn takes off again, so they differ by at most one unit's rows. Every unit is in one bin, so
    each row of the units is read once; a bin without units is left out. The window runs over the catalog's rows, not over
    data. ``read_source`` takes the predicates for JDBC.
    """
    counted = units.join(counts.select(*HIGH_VALUES, "n"), HIGH_VALUES, "left").fillna(0, ["n"])
    turn = F.row_number().over(Window.orderBy(F.desc("n"), *HIGH_VALUES)) - 1
    dealt = counted.withColumns({"bin": F.pmod(turn, F.lit(bins)), "predicate": predicate_text(key, list_col)})
    return dealt.groupBy("bin").agg(
        F.count(F.lit(1)).alias("units"),
        F.sum("n").alias("n"),
        F.array_join(F.sort_array(F.collect_list("predicate")), " OR ").alias("predicate"),
    )
