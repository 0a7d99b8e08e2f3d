"""Times the headline queries and prints one JSON line. Every query runs once to warm up and once timed."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from querybook import roles  # noqa: E402
from querybook.spark_queries import QUERIES, clustered  # noqa: E402
from sliceward import operators as op  # noqa: E402
from sliceward.operators.catalog import UNIT_COLUMNS  # noqa: E402
from sliceward.schema import HIGH_VALUES  # noqa: E402
from sliceward.sources import scratch_database, settle  # noqa: E402

HEADLINE = [
    "assign_units",
    "unit_row_counts",
    "reconcile_recorded",
    "reconcile_recounted",
    "archive",
    "current_runs",
    "consolidate_log",
    "latest_summaries",
    "recent_issues",
]


def _monthly_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = (roles.LINK, roles.OWNER, "LINEITEM")
    months = op.interval_units(roles.source_rows(spark, sf_dir, "LINEITEM"), "l_shipdate", source, "month")
    units = op.list_subunits(months, roles.list_groups(spark, sf_dir, "LINEITEM"))
    return settle(units.select(*UNIT_COLUMNS), "monthly")


def _probe(spark: SparkSession, sf_dir: str, units: DataFrame) -> DataFrame:
    rows = roles.source_rows(spark, sf_dir, "LINEITEM")
    return op.assign_units(rows, units, "l_shipdate", "l_returnflag").groupBy(*HIGH_VALUES).count()


def _histogram_probe(spark: SparkSession, sf_dir: str, units: DataFrame) -> DataFrame:
    rows = roles.source_rows(spark, sf_dir, "LINEITEM")
    return op.unit_row_counts(rows, units, "l_shipdate", "l_returnflag")


def _reload(spark: SparkSession, sf_dir: str, units: DataFrame) -> DataFrame:
    """The shipments are loaded into a table that is filled once and then replaced by every call."""
    rows, name = roles.source_rows(spark, sf_dir, "LINEITEM"), f"{scratch_database(spark)}.bench_reload"
    if not spark.catalog.tableExists(name):
        op.create_unit_table(rows, name)
    return op.load_units(rows, units, name, "l_shipdate", "l_returnflag")


def _seconds(build) -> float:
    started = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", shared)
        .config("spark.sql.warehouse.dir", f"{shared}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    units = _monthly_units(spark, sf_dir)
    work = {
        "probe_assign_and_count": lambda: _probe(spark, sf_dir, units),
        "probe_count_by_day": lambda: _histogram_probe(spark, sf_dir, units),
        # The shipments alone, as in earlier rounds; the registered query loads all sources.
        "clustered_write": lambda: clustered(spark, sf_dir, ("LINEITEM",)),
        "reload": lambda: _reload(spark, sf_dir, units),
        **{name: (lambda fn=QUERIES[name]: fn(spark, sf_dir)) for name in HEADLINE},
    }
    times = {}
    for name, build in work.items():
        _seconds(build)
        times[name] = _seconds(build)
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
