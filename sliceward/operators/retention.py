"""Preserve rules. A rule is SQL text whose first column is a list of days to keep."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sliceward.schema import TARGET, UNIT_KEY
from sliceward.sources import for_each_table, settle

RULE_SCHEMA = "target_owner string, target_table string, ordinal bigint, preserve_date date, rule_state string"
#: What became of a rule. A table without any row has a rule that was not executed.
ROWS, EMPTY, FAILED = "ROWS", "EMPTY", "FAILED"
# Fixed value: the text of a rule that cannot be executed.
RULE_FAILED = "ERROR: execute failed"
RULE_NOT_RUN = "ERROR: rule was not executed"


def _run_rule(spark: SparkSession, text: str) -> DataFrame:
    """Stored result of one rule, in a job of its own: a rule that fails at any time fails alone."""
    try:
        result = spark.sql(text)
        day = F.expr(f"try_cast(`{result.columns[0]}` AS DATE)").alias("preserve_date")
        rows = settle(result.select(F.monotonically_increasing_id().alias("ordinal"), day), "rule")
        state = EMPTY if rows.isEmpty() else ROWS
    except (PySparkException, Py4JError):
        state = FAILED
    if state == ROWS:
        return rows.withColumn("rule_state", F.lit(ROWS))
    return spark.range(1).select(
        F.lit(0).cast("long").alias("ordinal"), F.lit(None).cast("date").alias("preserve_date"), F.lit(state).alias("rule_state")
    )


def rule_rows(spark: SparkSession, rules: dict[tuple[str, str], str]) -> DataFrame:
    """Execute the given rules; their rows, tagged with (target_owner, target_table) and the state of the rule.

    A value that is no date gives a NULL date. A rule that gives nothing or fails, when it is analysed or when it
    runs, gives one row with that state and a NULL date. ``ordinal`` follows the order in which the rule delivers
    its rows. Every rule runs once; the rows are stored.
    """

    def run(rule: tuple[tuple[str, str], str]) -> DataFrame:
        (owner, table), text = rule
        tags = [F.lit(owner).alias("target_owner"), F.lit(table).alias("target_table")]
        return _run_rule(spark, text).select(*tags, "ordinal", "preserve_date", "rule_state")

    parts = for_each_table(spark, run, rules.items())
    if not parts:
        return spark.createDataFrame([], RULE_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def configured_rules(config: DataFrame) -> DataFrame:
    """The executed rules of a config: the text in ``preserve_rule`` of every table that has one."""
    named = config.filter("preserve_rule IS NOT NULL").select(*TARGET, "preserve_rule").distinct()
    texts = {(r["target_owner"], r["target_table"]): r["preserve_rule"] for r in named.toLocalIterator()}
    return rule_rows(config.sparkSession, texts)


def business_dates(config: DataFrame) -> DataFrame:
    """The config with ``last_business_date`` evaluated, and ``business_date_state``.

    The column holds text, each a SQL expression or a scalar subquery. A text is evaluated once, in a job of its own, for
    all tables that have it. ROWS: a date; EMPTY: no text, NULL or something that is no date; FAILED: it cannot be
    analysed or run. Without a date ``last_business_date`` is NULL, which the candidate sets refuse.
    """
    spark = config.sparkSession
    named = config.filter("last_business_date IS NOT NULL").select("last_business_date").distinct()
    texts = [r[0] for r in named.toLocalIterator()]

    def evaluate(text: str) -> tuple[str, object, str]:
        try:
            day = spark.sql(f"SELECT try_cast(({text}) AS DATE)").first()[0]
        except (PySparkException, Py4JError):
            return text, None, FAILED
        return text, day, ROWS if day is not None else EMPTY

    found = spark.createDataFrame(for_each_table(spark, evaluate, texts), "text string, day date, state string")
    others = [c for c in config.columns if c != "last_business_date"]
    joined = config.join(F.broadcast(found), F.col("last_business_date") == F.col("text"), "left")
    dated = joined.select(*others, F.col("day").alias("last_business_date"), F.coalesce("state", F.lit(EMPTY)).alias("business_date_state"))
    return dated.select(*config.columns, "business_date_state")


def preserve_dates(config: DataFrame, rows: DataFrame) -> DataFrame:
    """Every configured table with each of its rule's days, or one NULL day when there is none."""
    days = rows.filter(F.col("rule_state") == ROWS).select(*TARGET, "preserve_date")
    return config.select(*TARGET, "preserve_rule").join(days, TARGET, "left")


def preserve_match(units: DataFrame, dates: DataFrame) -> DataFrame:
    """Units with the latest preserve date in [low, high); NULL means the unit may be cleaned up.

    Units and dates meet on (target, month). A month holds a bounded number of both, so no table's units are
    compared with all of its dates, and a table with many units is spread over its months. A unit is first
    clipped to the span of its table's dates, which leaves most units without a month to look at.
    """
    known = dates.filter(F.col("preserve_date").isNotNull()).select(*TARGET, "preserve_date").distinct()
    span = known.groupBy(*TARGET).agg(
        F.min("preserve_date").alias("span_first"), F.max("preserve_date").alias("span_last")
    )
    clipped = (
        units.select(*UNIT_KEY, *TARGET, "low", "high")
        .join(span, TARGET)
        .withColumns(
            {
                "from_day": F.greatest("span_first", F.coalesce("low", "span_first")),
                "to_day": F.least("span_last", F.date_sub(F.coalesce("high", F.date_add("span_last", 1)), 1)),
            }
        )
        .filter(F.col("from_day") <= F.col("to_day"))
        .select(
            *UNIT_KEY,
            *TARGET,
            "from_day",
            "to_day",
            F.explode(
                F.sequence(F.trunc("from_day", "month"), F.trunc("to_day", "month"), F.expr("INTERVAL 1 MONTH"))
            ).alias("month"),
        )
    )
    by_month = known.withColumn("month", F.trunc("preserve_date", "month"))
    kept = (
        clipped.join(by_month, TARGET + ["month"])
        .filter(F.col("preserve_date").between(F.col("from_day"), F.col("to_day")))
        .groupBy(*UNIT_KEY)
        .agg(F.max("preserve_date").alias("preserve_date"))
    )
    return units.drop("preserve_date").join(kept, UNIT_KEY, "left")


def preserve_status(config: DataFrame, rows: DataFrame) -> DataFrame:
    """NULL without a rule, CORRECT when the rule ran and gave nothing or starts with a date, else an ERROR text.

    A rule without an executed result is an error too, so that a cleanup never takes it for one that keeps nothing.
    """
    first = rows.groupBy(*TARGET).agg(
        F.min_by("preserve_date", "ordinal").alias("first_date"), F.max("rule_state").alias("rule_state")
    )
    usable = (F.col("rule_state") == EMPTY) | (F.col("rule_state") == ROWS) & F.col("first_date").isNotNull()
    return (
        config.join(first, TARGET, "left")
        .withColumn(
            "preserve_calc",
            F.when(F.col("preserve_rule").isNull(), F.lit(None).cast("string"))
            .when(F.col("rule_state").isNull(), RULE_NOT_RUN)
            .when(usable, "CORRECT")
            .otherwise(RULE_FAILED),
        )
        .drop("first_date", "rule_state")
    )


def single_date_rule(config: DataFrame, rows: DataFrame) -> DataFrame:
    """A retention rule counts only if it yields exactly one date."""
    days = rows.filter(F.col("rule_state") == ROWS).groupBy(*TARGET).agg(
        F.when(F.count(F.lit(1)) == 1, F.max("preserve_date")).alias("retention_date")
    )
    return config.select(*TARGET).join(days, TARGET, "left")
