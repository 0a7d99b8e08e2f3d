"""Catalog, assignment, slices and counts on the demo tables, at the bounds and with odd bounds."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.functions import high_value_date, list_text, list_values, partition_hv, summary_cell
from sliceward.operators.assign import Calendar, unit_cells, unit_extent
from sliceward.schema import HIGH_VALUES
from sliceward.sources import settle
from tests import fixtures as fx


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    ("text", "day", "identity"),
    [
        ("DATE '2024-02-01'", date(2024, 2, 1), "2024-02-01"),
        ("TO_DATE(' 2024-02-01 00:00:00', 'SYYYY-MM-DD HH24:MI:SS')", date(2024, 2, 1), "2024-02-01"),
        (" maxvalue ", None, "MAXVALUE"),
        (None, None, None),
    ],
)
def test_bound_text(spark, text, day, identity):
    c = F.lit(text).cast("string")
    assert value(spark, high_value_date(c)) == day
    assert value(spark, partition_hv(c)) == identity


@pytest.mark.parametrize("text", ["TO_DATE(' 2024-02-01 06:00:00', 'X')", "not a date"])
def test_bound_text_refused(spark, text):
    with pytest.raises(PySparkException):
        value(spark, partition_hv(F.lit(text)))


def test_list_text(spark):
    values = list_values(F.lit("'NEW', 'O''K', 'a,b'"))
    assert value(spark, values) == ["NEW", "O'K", "a,b"]
    assert value(spark, list_text(values)) == "NEW,O'K,a\\,b"


def test_summary_cell(spark):
    assert value(spark, summary_cell(F.lit("a|b\nc "))) == "a/b c"
    assert value(spark, summary_cell(F.lit("#"))) == "-"
    assert value(spark, summary_cell(F.lit(None).cast("long"))) == "-"


def test_catalog_has_previous_bounds(spark):
    units = fx.catalog(spark, "CLIENT1", "ORDERS_SUBPART_SRC").orderBy("position", "subpartition_name").collect()
    assert len(units) == 24
    assert units[0]["low"] is None and units[0]["high"] == date(1800, 1, 1)
    gap = [u for u in units if u["partition_name"] == "P202512"]
    assert {(u["low"], u["high"]) for u in gap} == {(date(2024, 5, 1), date(2026, 1, 1))}
    last = units[-1]
    assert last["partition_hv"] == "MAXVALUE" and last["high"] is None and last["low"] == date(2026, 6, 1)
    assert {u["subpartition_hv"] for u in units} == {"NEW,PAID", "SHIPPED,CLOSED"}


@pytest.mark.parametrize(("client", "table"), list(fx.GOLDEN))
def test_golden_counts(spark, client, table):
    units = fx.catalog(spark, client, table)
    rows = fx.orders(spark, client, table)
    counts = op.unit_row_counts(rows, units, "order_date", fx.list_column(table))
    named = counts.join(units, HIGH_VALUES).select("partition_name", "subpartition_name", "n").collect()
    found = {(r[0], r[1]): r[2] for r in named}
    for name, n in zip(fx.HIGHS, fx.GOLDEN[(client, table)]):
        if isinstance(n, tuple):
            assert (found[(name, "SP_OPEN")], found[(name, "SP_DONE")]) == n
        else:
            assert found[(name, "#")] == n
    assert sum(found.values()) == rows.count() == fx.SIZES[(client, table)][0]


def test_golden_daily_counts(spark):
    units = fx.catalog(spark, "CLIENT2", "ORDERS_DAILY_INT_SRC")
    rows = fx.orders(spark, "CLIENT2", "ORDERS_DAILY_INT_SRC")
    counts = op.unit_row_counts(rows, units, "order_date", "status_code").join(units, HIGH_VALUES)
    found = {(r["partition_name"], r["subpartition_name"]): r["n"] for r in counts.collect()}
    for name, n in fx.GOLDEN_DAILY.items():
        assert (found[(name, "SP_OPEN")], found[(name, "SP_DONE")]) == n


def test_interval_units_follow_the_data(spark):
    rows = fx.orders(spark, "CLIENT1", "ORDERS_DAILY_INT_SRC")
    units = op.interval_units(rows, "order_date", (fx.LINK, "CLIENT1", "T")).orderBy("position").collect()
    assert [u["partition_name"] for u in units] == list(fx.GOLDEN_DAILY)
    assert units[0]["low"] == date(2024, 5, 1) and units[1]["low"] == units[0]["high"] == date(2024, 5, 2)


def test_late_row_on_a_gap_day_counts_in_no_other_unit(spark):
    source = (fx.LINK, "CLIENT1", "T")
    rows = spark.createDataFrame([("2024-05-01",), ("2024-05-04",)], "d string").select(F.to_date("d").alias("d"))
    known = settle(op.interval_units(rows, "d", source), "gap_units")
    late = rows.unionByName(spark.sql("SELECT DATE'2024-05-02' AS d"))
    after = op.interval_units(late, "d", source)
    may_4 = known.filter("partition_name = 'P20240504'")
    counts = [op.unit_row_counts(late, u, "d").filter("partition_hv = '2024-05-05'").first()["n"] for u in (may_4, known, after)]
    assert counts == [1, 1, 1]
    assert after.count() == 3


def brute_force(rows, units, key, list_col):
    """Every row against every unit; of several matches the unit with the lowest high bound."""
    far = date(9999, 12, 31)
    found = {}
    for r in rows:
        hits = [
            u
            for u in units
            if (u["low"] is None or r[key] >= u["low"])
            and (u["high"] is None or r[key] < u["high"])
            and (list_col is None or r[list_col] in u["list_values"])
        ]
        if hits:
            best = min(hits, key=lambda u: u["high"] or far)
            found[r["id"]] = (best["partition_hv"], best["subpartition_hv"])
    return found


ODD_UNITS = [
    # partition_hv, subpartition_hv, low, high, list_values
    ("2024-01-10", "a", None, "2024-01-10", ["a"]),
    ("2024-01-10", "b,c", "2024-01-05", "2024-01-10", ["b", "c"]),
    ("2024-01-20", "a", "2024-01-08", "2024-01-20", ["a"]),
    ("2024-01-20", "b", "2024-01-15", "2024-01-20", ["b"]),
    ("2024-01-05", "c", "2024-01-06", "2024-01-05", ["c"]),
    ("MAXVALUE", "c", "2024-01-25", None, ["c"]),
]


def odd(spark, by_list=True):
    rows = [("L", "O", "T", *u) for u in ODD_UNITS]
    units = spark.createDataFrame(
        rows, "source_link string, source_owner string, source_table string, partition_hv string, "
        "subpartition_hv string, low string, high string, list_values array<string>",
    ).withColumns({"low": F.col("low").cast("date"), "high": F.col("high").cast("date")})
    if not by_list:
        units = units.filter("subpartition_hv IN ('a')").withColumns(
            {"list_values": F.lit(None).cast("array<string>"), "subpartition_hv": F.lit("#")}
        )
    return settle(units, "odd_units")


def days(spark):
    day = F.date_add(F.lit("2023-12-28").cast("date"), (F.col("id") % 45).cast("int"))
    letter = F.element_at(F.array(*[F.lit(x) for x in "abcd"]), (F.col("id") % 4 + 1).cast("int"))
    return spark.range(400).select("id", day.alias("day"), letter.alias("letter"))


@pytest.mark.parametrize("by_list", [True, False])
@pytest.mark.parametrize("limit", [64 * 2**20, 0])
def test_assignment_equals_brute_force(spark, by_list, limit):
    """Open ends, gaps, overlaps, an empty range; broadcast and shuffled."""
    units, rows = odd(spark, by_list), days(spark)
    list_col = "letter" if by_list else None
    assigned = op.assign_units(rows, units, "day", list_col, broadcast_bytes=limit)
    found = {r["id"]: (r["partition_hv"], r["subpartition_hv"]) for r in assigned.collect()}
    assert assigned.count() == len(found)
    wanted = brute_force(rows.collect(), units.collect(), "day", list_col)
    assert found == wanted
    outside = {r["id"] for r in op.rows_outside(rows, units, "day", list_col).collect()}
    assert outside == set(range(400)) - set(wanted)
    counts = {(r["partition_hv"], r["subpartition_hv"]): r["n"] for r in op.unit_row_counts(rows, units, "day", list_col).collect()}
    for key in counts:
        assert counts[key] == list(wanted.values()).count(key)
    assert len(counts) == units.count()


def test_assignment_with_times(spark):
    """The last moment of a day belongs to it, the first moment of the bound does not."""
    units = odd(spark, by_list=False)
    rows = spark.sql(
        "SELECT * FROM VALUES (1, TIMESTAMP_NTZ'2024-01-09 23:59:59.999999'), (2, TIMESTAMP_NTZ'2024-01-10 00:00:00'), "
        "(3, TIMESTAMP_NTZ'2024-01-20 00:00:00'), (4, CAST(NULL AS TIMESTAMP_NTZ)), (5, TIMESTAMP_NTZ'0900-01-01 00:00:00') t(id, ts)"
    )
    found = {r["id"]: r["partition_hv"] for r in op.assign_units(rows, units, "ts").collect()}
    assert found == {1: "2024-01-10", 2: "2024-01-20", 5: "2024-01-10"}


def test_broadcast_needs_a_small_map(spark):
    units, rows = odd(spark), days(spark)
    small = op.assign_units(rows, units, "day", "letter")._jdf.queryExecution().optimizedPlan().toString()
    large = op.assign_units(rows, units, "day", "letter", broadcast_bytes=0)._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in small and "strategy=broadcast" not in large
    assert unit_extent(units)["pair_bytes"] > 0


def test_no_nested_loop_and_pushed_filter(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    units = odd(spark, by_list=False).filter("low IS NOT NULL")
    plan = op.assign_units(rows, units, "l_shipdate").select("l_orderkey", *HIGH_VALUES)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "GreaterThanOrEqual(l_shipdate" in text and "LessThan(l_shipdate" in text
    assert "l_comment" not in text and "l_tax" not in text


def test_long_spans_are_few_cells(spark):
    """Two centuries below the data add fewer pairs than the data has months, and a day is still told from the next."""
    bounds = ["1800-01-01", *(f"{y}-{m:02}-01" for y in range(1992, 1999) for m in range(1, 13)), "1999-01-18"]
    units = spark.createDataFrame([(b, "#", low, b) for low, b in zip([None, *bounds], bounds)], "partition_hv string, subpartition_hv string, low string, high string")
    units = settle(units.withColumns({c: F.col(c).cast("date") for c in ("low", "high")}).withColumn("list_values", F.lit(None).cast("array<string>")))
    calendar = Calendar.of(unit_extent(units))
    cells = unit_cells(units, calendar, False)
    per_unit = {r["partition_hv"]: r["count"] for r in cells.groupBy("partition_hv").count().collect()}
    assert per_unit["1992-01-01"] < 7 * 12 and per_unit["1995-06-01"] == 1 and sum(per_unit.values()) <= calendar.most_cells()
    assert cells.groupBy("__unit_cell").count().filter("count > 1").isEmpty()
    days = spark.createDataFrame([("1700-02-28",), ("1799-12-31",), ("1800-01-01",), ("1991-12-31",), ("1992-01-01",), ("1999-01-17",), ("1999-01-18",), (None,)], "day string").select(F.col("day").cast("date"))
    assigned = op.assign_units(days, units, "day")
    found = {str(r["day"]): r["partition_hv"] for r in assigned.collect()}
    assert found == {"1700-02-28": "1800-01-01", "1799-12-31": "1800-01-01", "1800-01-01": "1992-01-01", "1991-12-31": "1992-01-01", "1992-01-01": "1992-02-01", "1999-01-17": "1999-01-18"}
    assert "NestedLoop" not in assigned._jdf.queryExecution().toString()


def test_slice_needs_bounds(spark):
    rows = days(spark)
    unit = {"low": None, "high": date(2024, 1, 10), "list_values": ["a"]}
    assert op.unit_slice(rows, unit, "day").filter("day >= '2024-01-10'").isEmpty()
    assert op.unit_slice(rows, unit, "day", "letter").select("letter").distinct().collect()[0][0] == "a"
    with pytest.raises(ValueError):
        op.unit_slice(rows, {**unit, "high": None}, "day")
    with pytest.raises(ValueError):
        op.unit_slice(rows, {**unit, "list_values": None}, "day", "letter")
    with pytest.raises(ValueError):
        op.assign_units(rows, odd(spark, by_list=False), "day", "letter")
    with pytest.raises(ValueError):
        op.assign_units(rows, odd(spark), "day")
