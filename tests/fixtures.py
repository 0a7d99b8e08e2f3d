"""The demo tables: two clients, three table shapes each, with known row counts per unit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators.catalog import UNIT_COLUMNS
from sliceward.sources import settle

LINK = "SRC_LINK"
# Those of the demo tables.
OPEN, DONE = ["NEW", "PAID"], ["SHIPPED", "CLOSED"]
EOD = "2026-06-01"

# Upper bounds of the monthly tables.
HIGHS = {
    "P_ERROR": "TO_DATE(' 1800-01-01 00:00:00', 'SYYYY-MM-DD HH24:MI:SS', 'NLS_CALENDAR=GREGORIAN')",
    "P202401": "DATE '2024-02-01'",
    "P202402": "DATE '2024-03-01'",
    "P202403": "DATE '2024-04-01'",
    "P202404": "DATE '2024-05-01'",
    "P202512": "DATE '2026-01-01'",
    "P202601": "DATE '2026-02-01'",
    "P202602": "DATE '2026-03-01'",
    "P202603": "DATE '2026-04-01'",
    "P202604": "DATE '2026-05-01'",
    "P202605": "DATE '2026-06-01'",
    "PMAX": "MAXVALUE",
}

# Expected rows per unit, in the order of HIGHS; for the list tables (open, done).
GOLDEN = {
    ("CLIENT1", "ORDERS_ARCH_SRC"): [0, 82, 58, 62, 48, 30, 30, 28, 31, 30, 31, 0],
    ("CLIENT2", "ORDERS_ARCH_SRC"): [0, 82, 58, 62, 48, 0, 0, 0, 0, 0, 0, 0],
    ("CLIENT1", "ORDERS_SUBPART_SRC"): [
        (0, 0), (54, 54), (43, 44), (47, 46), (36, 36), (15, 15), (15, 15), (14, 14), (15, 16), (16, 14), (15, 16),
        (0, 0),
    ],
    ("CLIENT2", "ORDERS_SUBPART_SRC"): [(0, 0), (54, 54), (43, 44), (47, 46), (36, 36)] + [(0, 0)] * 7,
}
GOLDEN_DAILY = {"P20240501": (24, 0), "P20240502": (0, 24), "P20240503": (0, 24), "P20240504": (24, 0)}

# Rows, base customer id, first amount, amount step.
# Those of the demo tables.
SIZES = {
    ("CLIENT1", "ORDERS_ARCH_SRC"): (430, 1000, 10, 1.37),
    ("CLIENT2", "ORDERS_ARCH_SRC"): (250, 1000, 10, 1.37),
    ("CLIENT1", "ORDERS_SUBPART_SRC"): (540, 2000, 20, 2.11),
    ("CLIENT2", "ORDERS_SUBPART_SRC"): (360, 4000, 40, 3.22),
    ("CLIENT1", "ORDERS_DAILY_INT_SRC"): (96, 3000, 30, 1.91),
    ("CLIENT2", "ORDERS_DAILY_INT_SRC"): (96, 5000, 50, 2.77),
}
TARGETS = {"ORDERS_ARCH_SRC": "ORDERS", "ORDERS_SUBPART_SRC": "SUBPART", "ORDERS_DAILY_INT_SRC": "DAILY_INT"}


def orders(spark: SparkSession, client: str, table: str) -> DataFrame:
    rows, base, amount, step = SIZES[(client, table)]
    n = F.col("n")
    if table == "ORDERS_DAILY_INT_SRC":
        day = F.date_add(F.lit("2024-05-01").cast("date"), ((n - 1) % 4).cast("int"))
        spread = 19
    else:
        first = 250 if table == "ORDERS_ARCH_SRC" else 360
        spread = 17 if table == "ORDERS_ARCH_SRC" else 23
        day = F.date_add(F.lit("2024-01-01").cast("date"), ((n - 1) % 115).cast("int"))
        limit = first
        for month, length in (("12", 30), ("01", 30), ("02", 28), ("03", 31), ("04", 30), ("05", 31)):
            year = "2025" if month == "12" else "2026"
            start = F.lit(f"{year}-{month}-01").cast("date")
            day = F.when(n > limit, F.date_add(start, (n - limit - 1).cast("int"))).otherwise(day)
            limit += length
    columns = [
        n.alias("order_id"),
        (base + n % spread).alias("customer_id"),
        day.alias("order_date"),
        F.element_at(F.array(*[F.lit(s) for s in ("NEW", "PAID", "SHIPPED", "CLOSED")]), (n % 4 + 1).cast("int")).alias(
            "status_code"
        ),
    ]
    if table != "ORDERS_ARCH_SRC":
        columns.append(
            F.element_at(F.array(F.lit("N"), F.lit("S"), F.lit("W")), (n % 3 + 1).cast("int")).alias("region_code")
        )
    columns.append(F.round(amount + n * step, 2).cast("decimal(12,2)").alias("amount"))
    return spark.range(1, rows + 1).withColumnRenamed("id", "n").select(*columns)


def list_column(table: str) -> str | None:
    return None if table == "ORDERS_ARCH_SRC" else "status_code"


def groups(spark: SparkSession, client: str, table: str) -> DataFrame:
    rows = [(LINK, client, table, "SP_OPEN", OPEN), (LINK, client, table, "SP_DONE", DONE)]
    return spark.createDataFrame(
        rows, "source_link string, source_owner string, source_table string, subpartition_name string, "
        "list_values array<string>",
    )


def partitions(spark: SparkSession, client: str, table: str, highs: dict[str, str] | None = None) -> DataFrame:
    rows = [(LINK, client, table, p, h, i) for i, (p, h) in enumerate((highs or HIGHS).items(), 1)]
    return spark.createDataFrame(
        rows, "source_link string, source_owner string, source_table string, partition_name string, "
        "high_value string, position int",
    )


def catalog(spark: SparkSession, client: str, table: str) -> DataFrame:
    if table == "ORDERS_DAILY_INT_SRC":
        highs = {"P_ERROR": HIGHS["P_ERROR"]}
        highs |= {f"P2024050{d}": f"DATE '2024-05-0{d + 1}'" for d in range(1, 5)}
        units = op.unit_catalog(partitions(spark, client, table, highs))
    else:
        units = op.unit_catalog(partitions(spark, client, table))
    if list_column(table):
        units = op.list_subunits(units, groups(spark, client, table))
    return settle(units.select(*UNIT_COLUMNS), "fixture_catalog")


def config(spark: SparkSession) -> DataFrame:
    rules = {"ORDERS_ARCH_SRC": "end of year", "ORDERS_SUBPART_SRC": "turn of year", "ORDERS_DAILY_INT_SRC": None}
    rows = [
        (LINK, client, table, "ARCH", f"{client}_{TARGETS[table]}", EOD, 30, rules[table], "Y")
        for client, table in SIZES
    ]
    return config_rows(spark, rows)


def replica_config(spark: SparkSession) -> DataFrame:
    rows = [
        ("ARCH_LINK", "ARCH", f"{client}_{TARGETS[table]}", "REPLICA", f"{client}_{TARGETS[table]}_R", None,
         365, None, "Y")
        for client, table in SIZES
    ]
    return config_rows(spark, rows)


def config_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(
        rows, "source_link string, source_owner string, source_table string, target_owner string, "
        "target_table string, last_business_date string, days_online int, preserve_rule string, "
        "enabled_flag string",
    ).withColumn("last_business_date", F.col("last_business_date").cast("date"))


def rules() -> dict[tuple[str, str], str]:
    found = {}
    for client in ("CLIENT1", "CLIENT2"):
        found[("ARCH", f"{client}_ORDERS")] = "SELECT DATE'2025-12-31'"
        found[("ARCH", f"{client}_SUBPART")] = "SELECT explode(array(DATE'2026-01-01', DATE'2025-12-31'))"
    return found
