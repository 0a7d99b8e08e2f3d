"""Candidate sets one day below, at and one day above every limit; preserve rules; replica windows."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.schema import ARCHIVE, REPLICA
from tests import fixtures as fx

LEDGER = (
    "source_link string, source_owner string, source_table string, partition_hv string, subpartition_hv string, "
    "target_owner string, target_table string, unit_type string, partition_name string, subpartition_name string, "
    "low string, high string"
)


def ledger(spark, highs, statuses, table="T", layer=ARCHIVE, low="2000-01-01"):
    rows = [("L", "O", table, h, "#", "A", f"{table}_A", "PARTITION", f"P{h}", "#", low, h) for h in highs]
    return spark.createDataFrame(rows, LEDGER).withColumns(
        {
            "low": F.col("low").cast("date"),
            "high": F.col("high").cast("date"),
            "list_values": F.lit(None).cast("array<string>"),
            **{c: F.lit(s) for c, s in zip(layer.statuses, statuses)},
            "source_rows": F.lit(1).cast("long"),
            "target_rows": F.lit(1).cast("long"),
        }
    )


def config(spark, business_date="2024-06-01", days=30, enabled="Y", table="T", link="L"):
    return fx.config_rows(spark, [(link, "O", table, "A", f"{table}_A", business_date, days, None, enabled)])


def highs(df):
    return sorted(r["partition_hv"] for r in df.collect())


NEAR_BUSINESS = ["2024-05-31", "2024-06-01", "2024-06-02"]
NEAR_CUTOFF = ["2024-05-01", "2024-05-02", "2024-05-03"]


def test_archivable_is_strictly_below_the_business_date(spark):
    units = ledger(spark, NEAR_BUSINESS, "NNN")
    assert highs(op.archivable(units, config(spark))) == ["2024-05-31"]
    assert highs(op.archivable(units, config(spark, enabled="N"))) == []
    assert highs(op.archivable(ledger(spark, NEAR_BUSINESS, "YNN"), config(spark))) == []


def test_truncatable_includes_the_cutoff(spark):
    units = ledger(spark, NEAR_CUTOFF, "YYN")
    assert highs(op.truncatable(units, config(spark))) == ["2024-05-01", "2024-05-02"]
    for statuses in ("NYN", "YNN", "YYY"):
        assert highs(op.truncatable(ledger(spark, NEAR_CUTOFF, statuses), config(spark))) == []


@pytest.mark.parametrize("layer", [ARCHIVE, REPLICA])
def test_quality_pending(spark, layer):
    found = {s: op.quality_pending(ledger(spark, ["2024-01-01"], s, layer=layer), config(spark), layer).count()
             for s in ("NNN", "YNN", "YYN", "YNY")}
    assert found == {"NNN": 0, "YNN": 1, "YYN": 0, "YNY": 1}


def replica_setup(spark):
    archive = ledger(spark, ["2023-01-01", "2023-12-31", "2024-01-01", "2024-12-31"], "YYN").unionByName(
        ledger(spark, ["2025-06-01"], "YNN")
    )
    cfg = fx.config_rows(spark, [("V", "A", "T_A", "R", "T_R", None, 365, None, "Y")])
    return archive, cfg


def test_replica_base_is_the_newest_confirmed_unit(spark):
    archive, cfg = replica_setup(spark)
    units = op.replica_source_units(archive, cfg).collect()
    assert len(units) == 4
    assert {u["base_date"] for u in units} == {date(2024, 12, 31)}
    assert {u["cutoff_date"] for u in units} == {date(2024, 1, 1)}
    assert {(u["source_link"], u["source_table"], u["target_table"]) for u in units} == {("V", "T_A", "T_R")}


def test_replicable_and_purgeable_meet_at_the_cutoff(spark):
    archive, cfg = replica_setup(spark)
    bases = op.base_dates(op.replica_source_units(archive, cfg))
    names = ["2023-12-31", "2024-01-01", "2024-01-02"]

    def units(statuses):
        found = ledger(spark, names, statuses, "T_A", REPLICA)
        return found.withColumns({"source_link": F.lit("V"), "source_owner": F.lit("A")})

    assert highs(op.replicable(units("NNN"), cfg, bases)) == ["2024-01-02"]
    assert highs(op.purgeable(units("YYN"), cfg, bases)) == ["2023-12-31", "2024-01-01"]
    assert highs(op.replicable(units("YNN"), cfg, bases)) == []
    assert highs(op.purgeable(units("YYY"), cfg, bases)) == []


def test_undiscovered_compares_the_whole_key(spark):
    units = ledger(spark, ["2024-01-01", "2024-02-01"], "NNN")
    assert highs(op.undiscovered(units, units.filter("partition_hv = '2024-01-01'"))) == ["2024-02-01"]
    other = units.withColumn("subpartition_hv", F.lit("NEW,PAID"))
    assert op.undiscovered(units, other).count() == 2


def test_source_units_skip_open_ends_and_disabled_tables(spark):
    catalog = fx.catalog(spark, "CLIENT1", "ORDERS_ARCH_SRC")
    cfg = fx.config(spark)
    assert op.source_units(cfg, catalog).count() == 11
    off = cfg.withColumn("enabled_flag", F.lit("N"))
    assert op.source_units(off, catalog).count() == 0


def preserved(spark, units, days):
    rows = spark.createDataFrame([("A", "T_A", i, d) for i, d in enumerate(days)], "target_owner string, "
                                 "target_table string, ordinal bigint, preserve_date string")
    rows = rows.withColumn("preserve_date", F.col("preserve_date").cast("date")).withColumn("rule_state", F.lit("ROWS"))
    cfg = config(spark).withColumn("preserve_rule", F.lit("rule"))
    matched = op.preserve_match(units, op.preserve_dates(cfg, rows))
    return {r["partition_hv"]: r["preserve_date"] for r in matched.collect()}


def test_preserve_date_at_the_bounds_of_a_unit(spark):
    units = ledger(spark, ["2024-03-01"], "YYN", low="2024-02-01")
    assert preserved(spark, units, ["2024-02-01"]) == {"2024-03-01": date(2024, 2, 1)}
    assert preserved(spark, units, ["2024-03-01"]) == {"2024-03-01": None}
    assert preserved(spark, units, ["2024-01-31"]) == {"2024-03-01": None}
    assert preserved(spark, units, ["2024-02-10", "2024-02-29", "2024-02-10", None]) == {"2024-03-01": date(2024, 2, 29)}
    assert preserved(spark, units, []) == {"2024-03-01": None}


def test_preserve_without_lower_bound_and_over_years(spark):
    open_low = ledger(spark, ["2024-03-01"], "YYN", low=None)
    assert preserved(spark, open_low, ["1700-05-05"]) == {"2024-03-01": date(1700, 5, 5)}
    wide = ledger(spark, ["2026-01-01"], "YYN", low="2024-05-01")
    assert preserved(spark, wide, ["2024-04-30", "2025-12-31", "2026-01-01"]) == {"2026-01-01": date(2025, 12, 31)}


def test_rule_states(spark):
    cfg = fx.config_rows(
        spark,
        [("L", "O", t, "A", t, "2024-01-01", 1, rule, "Y") for t, rule in
         [("none", None), ("empty", "r"), ("good", "r"), ("two", "r"), ("nulls", "r"), ("broken", "r"), ("text", "r"),
          ("at_run", "r"), ("not_run", "r")]],
    )
    rows = op.rule_rows(
        spark,
        {
            ("A", "empty"): "SELECT DATE'2024-01-01' WHERE false",
            ("A", "good"): "SELECT DATE'2024-01-01'",
            ("A", "two"): "SELECT * FROM VALUES (DATE'2024-01-01'), (NULL) t(d)",
            ("A", "nulls"): "SELECT * FROM VALUES (CAST(NULL AS DATE)), (DATE'2024-01-01') t(d)",
            ("A", "broken"): "SELEC DATE'2024-01-01'",
            ("A", "text"): "SELECT 'someday'",
            ("A", "at_run"): "SELECT CAST(concat('no day ', id) AS DATE) FROM range(3)",
        },
    )
    found = {r["target_table"]: r["preserve_calc"] for r in op.preserve_status(cfg, rows).collect()}
    assert found == {
        "none": None, "empty": "CORRECT", "good": "CORRECT", "two": "CORRECT",
        "nulls": "ERROR: execute failed", "broken": "ERROR: execute failed", "text": "ERROR: execute failed",
        "at_run": "ERROR: execute failed", "not_run": "ERROR: rule was not executed",
    }
    single = {r["target_table"]: r["retention_date"] for r in op.single_date_rule(cfg, rows).collect()}
    assert single["good"] == date(2024, 1, 1)
    assert [single[t] for t in ("none", "empty", "two", "nulls", "broken", "text", "at_run", "not_run")] == [None] * 8


def test_scope(spark):
    units = ledger(spark, ["2024-01-01"], "NNN", "B").unionByName(ledger(spark, ["2024-01-01"], "NNN", "A"))
    assert [r["source_table"] for r in op.scoped_tables(units).collect()] == ["A", "B"]
    assert op.scope(units, "a", " b_a ").count() == 1
    assert op.scope(units, "a", "").count() == 2
    assert op.scope(units, "nobody").count() == 0
    assert op.scope(units, None, "A_A").first()["source_table"] == "A"
