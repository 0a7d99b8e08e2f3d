"""The driver's tables in the roles of the lifecycle: sources, catalog, config, ledger, runs and log.

Nothing here is invented data: bounds, list groups, counts, runs and log entries are derived from the tables.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceward import operators as op
from sliceward.operators.catalog import UNIT_COLUMNS
from sliceward.operators.reports import SUMMARY_BEGIN, SUMMARY_END
from sliceward.schema import SOURCE, UNIT_KEY
from sliceward.sources import SourceSpec, for_each_table, read_source, settle

LINK = "CORE"
OWNER = "SALES"
ARCHIVE_LINK = "VAULT"
ARCHIVE_OWNER = "ARCHIVE"
REPLICA_OWNER = "REPLICA"
AS_OF = "2024-01-31 00:00:00"

# source table: (driver table, key, list column)
SOURCES = {
    "ORDERS": ("orders", "o_orderdate", None),
    "LINEITEM": ("lineitem", "l_shipdate", "l_returnflag"),
    "EVENTS": ("events", "ts", "event_type"),
}

# Policy per source table: last business date, days online, preserve rule, enabled.
POLICIES = {
    "ORDERS": ("2001-06-01", 30, "year ends", "Y"),
    "LINEITEM": ("2001-06-01", 30, "turn of the year", "Y"),
    "EVENTS": ("2024-01-25", 10, None, "Y"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_source(spark, SourceSpec("parquet", f"{sf_dir}/{name}.parquet"))


def as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


def source_rows(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    return table(spark, sf_dir, SOURCES[source][0])


def _named(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns(
        {"source_link": F.lit(LINK), "source_owner": F.lit(OWNER), "source_table": F.lit(source)}
    )


def partitions(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Declared range partitions: years up to 2001, months after that, below them P_ERROR, above them PMAX.

    A bound exists where the table holds rows below it.
    """
    key = SOURCES[source][1]
    day = F.to_date(key)
    bound = F.when(F.year(day) < 2001, F.make_date(F.year(day) + 1, F.lit(1), F.lit(1))).otherwise(
        F.add_months(F.trunc(day, "month"), 1)
    )
    highs = source_rows(spark, sf_dir, source).select(bound.alias("high")).distinct()
    highs = highs.filter("high IS NOT NULL AND high <= DATE'2001-07-01'")
    declared = highs.select(
        F.when(F.col("high") <= F.lit("2001-01-01").cast("date"), F.date_format(F.date_sub("high", 1), "'P'yyyy"))
        .otherwise(F.date_format(F.date_sub("high", 1), "'P'yyyyMM"))
        .alias("partition_name"),
        F.concat(F.lit("DATE '"), F.col("high").cast("string"), F.lit("'")).alias("high_value"),
        F.col("high").alias("sort_day"),
    )
    # The two catch-all bounds exist once the table holds any row. Fixed value: the text of the lower one.
    error_high = "TO_DATE(' 1800-01-01 00:00:00', 'SYYYY-MM-DD HH24:MI:SS')"
    ends = (
        highs.limit(1)
        .select(F.explode(F.array(F.lit("P_ERROR"), F.lit("PMAX"))).alias("partition_name"))
        .withColumns(
            {
                "high_value": F.when(F.col("partition_name") == "PMAX", "MAXVALUE").otherwise(error_high),
                "sort_day": F.when(F.col("partition_name") == "PMAX", "9999-12-31")
                .otherwise("1800-01-01")
                .cast("date"),
            }
        )
    )
    numbered = declared.unionByName(ends).select(
        "partition_name", "high_value", F.expr("row_number() OVER (ORDER BY sort_day)").alias("position")
    )
    return _named(numbered, source)


def list_groups(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The subpartition template: which list values of the table form a group."""
    _, _, list_col = SOURCES[source]
    group = {
        "LINEITEM": "CASE WHEN l_returnflag = 'N' THEN 'SP_OPEN' ELSE 'SP_DONE' END",
        "EVENTS": "CASE WHEN event_type IN ('purchase', 'error') THEN 'SP_B' ELSE 'SP_A' END",
    }[source]
    values = source_rows(spark, sf_dir, source).select(list_col).distinct().filter(F.col(list_col).isNotNull())
    groups = values.groupBy(F.expr(group).alias("subpartition_name")).agg(
        F.sort_array(F.collect_set(list_col)).alias("list_values")
    )
    return _named(groups, source)


def catalog(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """Unit catalog of one source, stored."""
    if source == "EVENTS":
        units = op.interval_units(source_rows(spark, sf_dir, source), "ts", (LINK, OWNER, source))
    else:
        units = op.unit_catalog(partitions(spark, sf_dir, source))
    if SOURCES[source][2] is not None:
        units = op.list_subunits(units, list_groups(spark, sf_dir, source))
    return settle(units.select(*UNIT_COLUMNS), "catalog")


def catalogs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dict(zip(SOURCES, for_each_table(spark, lambda source: catalog(spark, sf_dir, source), SOURCES)))


def union(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def config(spark: SparkSession) -> DataFrame:
    rows = [
        (LINK, OWNER, source, ARCHIVE_OWNER, f"{source}_ARCH", *POLICIES[source]) for source in SOURCES
    ]
    columns = "source_link string, source_owner string, source_table string, target_owner string, "
    columns += "target_table string, last_business_date string, days_online int, preserve_rule string, "
    columns += "enabled_flag string"
    return spark.createDataFrame(rows, columns).withColumn(
        "last_business_date", F.col("last_business_date").cast("date")
    )


def replica_config(spark: SparkSession) -> DataFrame:
    days = {"ORDERS": 365, "LINEITEM": 365, "EVENTS": 7}
    rows = [
        (ARCHIVE_LINK, ARCHIVE_OWNER, f"{s}_ARCH", REPLICA_OWNER, f"{s}_REPL", None, days[s], None, "Y")
        for s in SOURCES
    ]
    columns = "source_link string, source_owner string, source_table string, target_owner string, "
    columns += "target_table string, last_business_date date, days_online int, preserve_rule string, "
    columns += "enabled_flag string"
    return spark.createDataFrame(rows, columns)


def faulty(df: DataFrame, source: str) -> DataFrame:
    """An archived copy that lost rows: those of a few days of 1997 or, for events, of one user."""
    lost = {
        "ORDERS": "year(o_orderdate) = 1997 AND o_orderkey % 97 = 0",
        "LINEITEM": "year(l_shipdate) = 1997 AND l_orderkey % 97 = 0",
        "EVENTS": "user_id = 7 AND event_type = 'error'",
    }[source]
    return df.filter(~F.coalesce(F.expr(lost), F.lit(False)))


def counts(spark: SparkSession, sf_dir: str, cats: dict[str, DataFrame], broken: bool = False) -> DataFrame:
    """Row count per unit over all sources; of the faulty copy when ``broken``."""

    def of_source(source: str) -> DataFrame:
        _, key, list_col = SOURCES[source]
        rows = source_rows(spark, sf_dir, source)
        return op.unit_row_counts(faulty(rows, source) if broken else rows, cats[source], key, list_col)

    return union(for_each_table(spark, of_source, cats))


def archive_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger after discovery, archiving from the faulty copy and quality: stored rows.

    Units closed before the business date are archived with the rows of the faulty copy and checked against
    the source. Two tables' oldest unit was cleaned up before.
    """
    cats = catalogs(spark, sf_dir)
    cfg = config(spark)
    units = op.source_units(cfg, union(cats.values()))
    loaded = counts(spark, sf_dir, cats, broken=True).withColumnRenamed("n", "loaded_rows")
    source_counts = counts(spark, sf_dir, cats)
    archived = F.col("high") < F.col("last_business_date")
    recorded = (
        units.join(cfg.select(*SOURCE, "last_business_date"), SOURCE)
        .join(loaded, UNIT_KEY, "left")
        .select(
            *units.columns,
            F.when(archived, "Y").otherwise("N").alias("archive_status"),
            F.when(archived, F.col("loaded_rows")).alias("target_rows"),
        )
    )
    checked = op.reconcile_recorded(recorded, source_counts)
    quality = F.when(F.col("archive_status") == "Y", F.col("quality_status")).otherwise("N")
    ledger = checked.withColumns(
        {
            "source_rows": F.when(F.col("archive_status") == "Y", F.col("source_rows")),
            "error_message": F.when(F.col("archive_status") == "Y", F.col("error_message")),
            "truncate_status": F.when(
                (F.col("partition_name") == "P_ERROR") & (quality == "Y"), "Y"
            ).otherwise("N"),
            "quality_status": quality,
            "last_run_id": F.lit(1).cast("long"),
        }
    )
    return settle(ledger, "ledger")


def replica_ledger(archive: DataFrame, cfg: DataFrame) -> DataFrame:
    """A replica ledger over the confirmed archive units.

    Yearly units and the first half of a month of daily units were replicated and confirmed; newer ones are
    untouched.
    """
    units = op.replica_source_units(archive, cfg)
    rows = archive.select(
        F.col("target_owner").alias("source_owner"),
        F.col("target_table").alias("source_table"),
        "partition_hv",
        "subpartition_hv",
        F.col("target_rows").alias("replica_rows"),
    )
    done = (F.month("high") == 1) & (F.dayofmonth("high") <= 15)
    ledger = units.join(rows, ["source_owner", "source_table", "partition_hv", "subpartition_hv"]).withColumns(
        {
            "replica_status": F.when(done, "Y").otherwise("N"),
            "quality_status": F.when(done, "Y").otherwise("N"),
            "purge_status": F.lit("N"),
            "source_rows": F.when(done, F.col("replica_rows")),
            "target_rows": F.when(done, F.col("replica_rows")),
            "last_run_id": F.lit(1).cast("long"),
            "error_message": F.lit(None).cast("string"),
        }
    )
    return ledger.drop("replica_rows", "days_online", "base_date", "cutoff_date")


def rules(spark: SparkSession, sf_dir: str) -> dict[tuple[str, str], str]:
    """Preserve rules as SQL over the sources: every year end with orders, and both sides of the last turn of
    a year with shipments. Events have none."""
    for source in SOURCES:
        source_rows(spark, sf_dir, source).createOrReplaceTempView(f"rule_{source.lower()}")
    year_ends = "SELECT make_date(y, 12, 31) FROM (SELECT DISTINCT year(o_orderdate) y FROM rule_orders) ORDER BY y"
    turn = (
        "SELECT day FROM (SELECT explode(array(make_date(y, 12, 31), make_date(y + 1, 1, 1))) day "
        "FROM (SELECT max(year(l_shipdate)) - 1 y FROM rule_lineitem)) ORDER BY day"
    )
    return {(ARCHIVE_OWNER, "ORDERS_ARCH"): year_ends, (ARCHIVE_OWNER, "LINEITEM_ARCH"): turn}


# Runs and log entries are events: what happened, when, to whom.
_RUN_TYPE = (
    "CASE event_type WHEN 'view' THEN 'DISCOVER' WHEN 'click' THEN 'ARCHIVE' WHEN 'signup' THEN 'QUALITY' "
    "WHEN 'purchase' THEN 'TRUNCATE' ELSE 'RUNNER' END"
)
_STATUS = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'SUCCESS' END"


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two events per run: the start, and the finish for all but clicks, which are still running."""
    events = table(spark, sf_dir, "events")
    start = events.select(
        F.col("event_id").alias("run_id"),
        F.expr(f"lower({_RUN_TYPE})").alias("run_type"),
        F.lit("RUNNING").alias("run_status"),
        F.lit("core").alias("source_link"),
        F.lit("sales").alias("source_owner"),
        F.col("event_type").alias("source_table"),
        F.col("user_id").alias("mstr_log_id"),
        F.col("ts").alias("started_at"),
        F.lit(None).cast("timestamp_ntz").alias("ended_at"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END").alias("execute_flag"),
        F.lit(None).cast("string").alias("error_message"),
        F.col("ts").alias("event_ts"),
        F.lit(0).alias("seq"),
    )
    nothing = {c: F.lit(None).cast("string").alias(c) for c in ("run_type", *SOURCE, "execute_flag")}
    finish = events.filter("event_type <> 'click'").select(
        F.col("event_id").alias("run_id"),
        nothing["run_type"],
        F.expr(_STATUS).alias("run_status"),
        *[nothing[c] for c in SOURCE],
        F.lit(None).cast("long").alias("mstr_log_id"),
        F.lit(None).cast("timestamp_ntz").alias("started_at"),
        F.expr("ts + make_dt_interval(0, 0, 0, event_id % 600)").alias("ended_at"),
        nothing["execute_flag"],
        F.expr("CASE WHEN event_type = 'error' THEN props END").alias("error_message"),
        F.expr("ts + make_dt_interval(0, 0, 0, event_id % 600)").alias("event_ts"),
        F.lit(1).alias("seq"),
    )
    return start.unionByName(finish)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.current_runs(run_events(spark, sf_dir))


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log entry per event, many entries per user's log. Clicks name no master id; views are debug."""
    return table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_type <> 'click' THEN user_id END").alias("mstr_log_id"),
        F.col("user_id").alias("log_id"),
        F.expr("CASE WHEN event_type = 'view' THEN 'D' ELSE 'N' END").alias("log_level"),
        F.expr("CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'TEXT' END").alias("log_type"),
        F.expr(f"CASE WHEN event_type <> 'click' THEN {_RUN_TYPE} END").alias("log_categ"),
        F.lit(None).cast("string").alias("mstr_fun"),
        F.expr(f"CASE WHEN event_type IN ('error', 'signup') THEN {_STATUS} END").alias("log_status"),
        F.expr("CASE WHEN event_type = 'signup' THEN ts END").alias("start_date"),
        F.expr("CASE WHEN event_type IN ('error', 'purchase') THEN ts END").alias("end_date"),
        F.concat("event_type", F.lit(" "), "props").alias("log_msg"),
        F.expr("CASE WHEN event_type = 'error' THEN cast(event_id AS string) END").alias("last_err_code"),
        F.expr("CASE WHEN event_type = 'error' THEN props END").alias("last_err_desc"),
        F.col("ts").alias("event_ts"),
        F.lit(0).alias("seq"),
        F.col("event_id").cast("string").alias("entry_key"),
    )


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A consolidated log with one row per event; all but clicks carry a marked summary."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("mstr_log_id"),
        F.col("event_id").alias("log_id"),
        F.expr(_RUN_TYPE).alias("log_categ"),
        F.lit(None).cast("string").alias("mstr_fun"),
        F.expr(_STATUS).alias("log_status"),
        F.col("ts").alias("start_date"),
        F.expr("ts + make_dt_interval(0, 0, 0, event_id % 600)").alias("end_date"),
        F.expr(
            "CASE WHEN event_type = 'click' THEN concat('no summary ', props) ELSE concat('started\\n', "
            f"'{SUMMARY_BEGIN}', '\\n  ', event_type, ' ', props, '\\n', '{SUMMARY_END}') END"
        ).alias("log_msg"),
        F.expr("CASE WHEN event_type = 'error' THEN cast(event_id AS string) END").alias("last_err_code"),
    )
