"""Column expressions shared by the operators. All of them stay inside code generation or built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sliceward.schema import MAXVALUE, NO_SUBPARTITION

_ISO_DAY = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"
_TIME_OF_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}[ T]([0-9]{2}:[0-9]{2}:[0-9]{2})"
_QUOTED = r"'((?:[^']|'')*)'"


def text_or_null(c: Column) -> Column:
    """The empty string counts as NULL in ledger and log text."""
    return F.nullif(c, F.lit(""))


def flag(condition: Column) -> Column:
    """'Y' when the condition holds; 'N' when it is false or unknown."""
    return F.when(condition, F.lit("Y")).otherwise(F.lit("N"))


def stamp(c: Column) -> Column:
    """``2024-01-31 12:00:00``. Cut from the text of the time, so no session time zone comes in."""
    return F.substring(c.cast("string"), 1, 19)


def log_stamp(c: Column) -> Column:
    """``31-01-2024 12:00:00``, the form used inside log texts."""
    text = c.cast("string")
    day = F.concat_ws("-", F.substring(text, 9, 2), F.substring(text, 6, 2), F.substring(text, 1, 4))
    return F.concat(day, F.substring(text, 11, 9))


def interval_seconds(c: Column) -> Column:
    """Whole seconds of a day-time interval."""
    parts = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}
    seconds = [F.extract(F.lit(field), c).cast("long") * size for field, size in parts.items()]
    return seconds[0] + seconds[1] + seconds[2] + seconds[3]


def strip_text(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def summary_cell(c: Column) -> Column:
    """One cell of a step summary: single line, no column separator, '-' for a missing value."""
    text = c.cast("string")
    missing = text.isNull() | (text == NO_SUBPARTITION) | (text == "")
    return F.when(missing, F.lit("-")).otherwise(F.translate(F.trim(text), "\r\n|", "  /"))


def high_value_date(c: Column) -> Column:
    """Upper bound text (``DATE '2024-02-01'``, ``TO_DATE(' 2024-02-01 00:00:00', ...)``, ISO) to a date.

    NULL for NULL, MAXVALUE and text without a readable day.
    """
    return F.try_to_date(text_or_null(F.regexp_extract(c, _ISO_DAY, 1)))


def business_date(c: Column) -> Column:
    """As ``high_value_date``, but a missing date is an error: no limit can be derived from it."""
    return F.coalesce(
        high_value_date(c),
        F.raise_error(F.concat(F.lit("not a date: "), F.coalesce(c, F.lit("NULL")))).cast("date"),
    )


def partition_hv(c: Column) -> Column:
    """Identity text of a range bound: the ISO day, or MAXVALUE for the open end, or NULL for no bound.

    Two spellings of one day give one identity. Bounds are whole days, so a time of day is refused.
    """
    time_of_day = F.regexp_extract(c, _TIME_OF_DAY, 1)
    refused = F.raise_error(F.concat(F.lit("partition bound is not a whole day: "), c)).cast("string")
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(F.upper(F.trim(c)) == MAXVALUE, F.lit(MAXVALUE))
        .when(~time_of_day.isin("", "00:00:00"), refused)
        .otherwise(F.coalesce(high_value_date(c).cast("string"), refused))
    )


def list_values(c: Column) -> Column:
    """List bound text (``'NEW', 'PAID'``) to an array; NULL stays NULL."""
    quoted = F.regexp_extract_all(c, F.lit(_QUOTED), F.lit(1))
    return F.transform(quoted, lambda v: F.replace(v, F.lit("''"), F.lit("'")))


def list_text(values: Column) -> Column:
    """Identity text of a list bound. Commas inside a value are escaped, so two lists never share a text."""
    escaped = F.transform(
        values,
        lambda v: F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit(","), F.lit("\\,")),
    )
    return F.array_join(escaped, ",")


def subpartition_hv(values: Column) -> Column:
    return F.coalesce(list_text(values), F.lit(NO_SUBPARTITION))
