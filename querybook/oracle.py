"""The same questions in SQL over the same tables, written without regard to how Spark answers them."""

from __future__ import annotations

# Every source row as (source_table, day, list value, missing in the faulty copy).
_FACTS = """
facts AS (
  SELECT 'ORDERS' AS source_table, CAST(o_orderdate AS DATE) AS d, CAST(NULL AS VARCHAR) AS v,
         coalesce(year(o_orderdate) = 1997 AND o_orderkey % 97 = 0, FALSE) AS lost
  FROM orders
  UNION ALL
  SELECT 'LINEITEM', CAST(l_shipdate AS DATE), l_returnflag,
         coalesce(year(l_shipdate) = 1997 AND l_orderkey % 97 = 0, FALSE)
  FROM lineitem
  UNION ALL
  SELECT 'EVENTS', CAST(ts AS DATE), event_type, coalesce(user_id = 7 AND event_type = 'error', FALSE)
  FROM events
)"""

_UNITS = _FACTS + """,
bounds AS (
  SELECT DISTINCT source_table, high
  FROM (SELECT source_table,
               CASE WHEN year(d) < 2001 THEN make_date(year(d) + 1, 1, 1)
                    ELSE CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) END AS high
        FROM facts WHERE source_table <> 'EVENTS')
  WHERE high <= DATE '2001-07-01'
),
named AS (
  SELECT source_table, high,
         CASE WHEN high <= DATE '2001-01-01' THEN strftime(high - 1, 'P%Y') ELSE strftime(high - 1, 'P%Y%m') END
           AS partition_name
  FROM bounds
  UNION ALL SELECT DISTINCT source_table, DATE '1800-01-01', 'P_ERROR' FROM bounds
  UNION ALL SELECT DISTINCT source_table, CAST(NULL AS DATE), 'PMAX' FROM bounds
  UNION ALL SELECT DISTINCT source_table, d + 1, strftime(d, 'P%Y%m%d') FROM facts WHERE source_table = 'EVENTS'
),
parts AS (
  SELECT source_table, partition_name, high, CASE WHEN source_table = 'EVENTS' THEN high - 1 ELSE lag(high) OVER w END AS low,
         CAST(row_number() OVER w AS INTEGER) AS position
  FROM named WINDOW w AS (PARTITION BY source_table ORDER BY coalesce(high, DATE '9999-12-31'))
),
groups AS (
  SELECT source_table, subpartition_name, list(v ORDER BY v) AS lst
  FROM (SELECT DISTINCT source_table, v,
               CASE WHEN source_table = 'LINEITEM' AND v = 'N' THEN 'SP_OPEN'
                    WHEN source_table = 'LINEITEM' THEN 'SP_DONE'
                    WHEN v IN ('purchase', 'error') THEN 'SP_B' ELSE 'SP_A' END AS subpartition_name
        FROM facts WHERE v IS NOT NULL)
  GROUP BY source_table, subpartition_name
),
units AS (
  SELECT 'CORE' AS source_link, 'SALES' AS source_owner, p.source_table,
         coalesce(CAST(p.high AS VARCHAR), 'MAXVALUE') AS partition_hv,
         coalesce(array_to_string(g.lst, ','), '#') AS subpartition_hv,
         p.partition_name, coalesce(g.subpartition_name, '#') AS subpartition_name,
         CASE WHEN g.lst IS NULL THEN 'PARTITION' ELSE 'SUBPARTITION' END AS unit_type,
         p.low, p.high, g.lst, p.position
  FROM parts p LEFT JOIN groups g USING (source_table)
)"""

_COUNTS = _UNITS + """,
counts AS (
  SELECT u.source_table, u.partition_hv, u.subpartition_hv,
         count(f.d) AS n, count(f.d) FILTER (WHERE NOT f.lost) AS kept
  FROM units u
  LEFT JOIN facts f
    ON f.source_table = u.source_table
   AND (u.low IS NULL OR f.d >= u.low) AND (u.high IS NULL OR f.d < u.high)
   AND (u.lst IS NULL OR list_contains(u.lst, f.v))
  GROUP BY u.source_table, u.partition_hv, u.subpartition_hv
)"""

_POLICY = """,
policy AS (
  SELECT * FROM (VALUES
    ('ORDERS', DATE '2001-06-01', 30, 'year ends'),
    ('LINEITEM', DATE '2001-06-01', 30, 'turn of the year'),
    ('EVENTS', DATE '2024-01-25', 10, NULL)
  ) AS t(source_table, last_business_date, days_online, preserve_rule)
)"""

_LEDGER = _COUNTS + _POLICY + """,
loaded AS (
  SELECT u.*, 'ARCHIVE' AS target_owner, u.source_table || '_ARCH' AS target_table,
         last_business_date, days_online, u.high < last_business_date AS closed, n, kept
  FROM units u JOIN policy USING (source_table) JOIN counts USING (source_table, partition_hv, subpartition_hv)
  WHERE u.high IS NOT NULL
),
ledger AS (
  SELECT * EXCLUDE (closed, n, kept),
         CASE WHEN closed THEN 'Y' ELSE 'N' END AS archive_status,
         CASE WHEN closed AND n = kept THEN 'Y' ELSE 'N' END AS quality_status,
         CASE WHEN closed AND n = kept AND partition_name = 'P_ERROR' THEN 'Y' ELSE 'N' END AS truncate_status,
         CASE WHEN closed THEN n END AS source_rows,
         CASE WHEN closed THEN kept END AS target_rows,
         CAST(1 AS BIGINT) AS last_run_id,
         CASE WHEN closed AND n <> kept THEN 'Source row count does not match target row count' END AS error_message
  FROM loaded
)"""

# The day below which units count as early.
_EARLY = "(CASE WHEN u.source_table = 'EVENTS' THEN DATE '2024-01-15' ELSE DATE '1998-01-01' END)"
_KEY = "source_link, source_owner, source_table, partition_hv, subpartition_hv"
_DATES = "CAST(low AS VARCHAR) AS low, CAST(high AS VARCHAR) AS high"
_UNIT = f"{_KEY}, partition_name, subpartition_name, unit_type, {_DATES}, array_to_string(lst, ',') AS list_values"
_ROW = f"{_KEY}, target_owner, target_table, {_DATES}"
_STATE = "archive_status, quality_status, truncate_status, source_rows, target_rows, last_run_id, error_message"

# Units at or below the online window of the source, with the latest day of their rule inside them.
_CLEANABLE = _LEDGER + """,
rule_days AS (
  SELECT 'ORDERS' AS source_table, make_date(y, 12, 31) AS day FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
  UNION ALL
  SELECT 'LINEITEM', unnest([make_date(y, 12, 31), make_date(y + 1, 1, 1)])
  FROM (SELECT max(year(l_shipdate)) - 1 AS y FROM lineitem)
),
limits AS (
  SELECT *, last_business_date - days_online AS cutoff_date FROM ledger
  WHERE archive_status = 'Y' AND quality_status = 'Y' AND truncate_status = 'N'
),
truncatable AS (SELECT * FROM limits WHERE high <= cutoff_date),
cleanable AS (
  SELECT t.*, (SELECT max(day) FROM rule_days r
               WHERE r.source_table = t.source_table AND r.day >= coalesce(t.low, DATE '0001-01-01')
                 AND r.day < t.high) AS preserve_date
  FROM truncatable t
)"""

_REPLICA = _LEDGER + """,
window_days AS (
  SELECT * FROM (VALUES ('ORDERS', 365), ('LINEITEM', 365), ('EVENTS', 7)) AS t(source_table, keep_days)
),
followed AS (
  SELECT 'VAULT' AS source_link, 'ARCHIVE' AS source_owner, target_table AS source_table,
         partition_hv, subpartition_hv, 'REPLICA' AS target_owner,
         l.source_table || '_REPL' AS target_table, l.low, l.high, unit_type, target_rows, keep_days, l.lst,
         partition_name, subpartition_name
  FROM ledger l JOIN window_days USING (source_table)
  WHERE archive_status = 'Y' AND quality_status = 'Y'
),
based AS (
  SELECT *, max(high) OVER (PARTITION BY source_table) AS base_date,
         max(high) OVER (PARTITION BY source_table) - keep_days AS cutoff_date,
         month(high) = 1 AND day(high) <= 15 AS done
  FROM followed
),
replica AS (
  SELECT * EXCLUDE (target_rows), CASE WHEN done THEN 'Y' ELSE 'N' END AS replica_status,
         CASE WHEN done THEN 'Y' ELSE 'N' END AS quality_status, 'N' AS purge_status,
         CASE WHEN done THEN target_rows END AS source_rows, CASE WHEN done THEN target_rows END AS target_rows,
         CAST(NULL AS VARCHAR) AS error_message
  FROM based
)"""

_LIMITS = "CAST(base_date AS VARCHAR) AS base_date, CAST(cutoff_date AS VARCHAR) AS cutoff_date"

# Runs and log entries.
_TYPE = """CASE event_type WHEN 'view' THEN 'DISCOVER' WHEN 'click' THEN 'ARCHIVE' WHEN 'signup' THEN 'QUALITY'
           WHEN 'purchase' THEN 'TRUNCATE' ELSE 'RUNNER' END"""
_STATUS = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'SUCCESS' END"
_END = "ts + to_seconds(event_id % 600)"
_RUNS = f"""
runs AS (
  SELECT event_id AS run_id, {_TYPE} AS run_type,
         CASE WHEN event_type = 'click' THEN 'RUNNING' ELSE {_STATUS} END AS run_status,
         'CORE' AS source_link, 'SALES' AS source_owner, upper(event_type) AS source_table,
         user_id AS mstr_log_id, ts AS started_at, CASE WHEN event_type <> 'click' THEN {_END} END AS ended_at,
         CASE WHEN event_id % 2 = 0 THEN 'Y' ELSE 'N' END AS execute_flag,
         CASE WHEN event_type = 'error' THEN props END AS error_message
  FROM events
),
recent AS (SELECT * FROM runs WHERE started_at >= TIMESTAMP '2024-01-24 00:00:00')"""
_LOG = f"""
log AS (
  SELECT event_id AS log_id, {_TYPE} AS log_categ, {_STATUS} AS log_status, ts AS start_date, {_END} AS end_date,
         CASE WHEN event_type = 'click' THEN 'no summary ' || props
              ELSE 'started' || chr(10) || '<<<SUMMARY_BEGIN>>>' || chr(10) || '  ' || event_type || ' ' || props
                   || chr(10) || '<<<SUMMARY_END>>>' END AS log_msg,
         CASE WHEN event_type = 'click' THEN NULL ELSE event_type || ' ' || props END AS summary_text,
         CASE WHEN event_type = 'error' THEN CAST(event_id AS VARCHAR) END AS last_err_code
  FROM events
)"""
_SECONDS = "'%Y-%m-%d %H:%M:%S'"
_MICROS = "'%Y-%m-%d %H:%M:%S.%f'"


def _tally(prefix: str = "") -> str:
    tests = {
        "success_runs": "run_status = 'SUCCESS'",
        "warning_runs": "run_status = 'WARNING'",
        "error_runs": "run_status = 'ERROR'",
        "execute_runs": "execute_flag = 'Y'",
        "preview_runs": "execute_flag = 'N'",
    }
    return ", ".join(f"count(*) FILTER (WHERE {prefix}{test}) AS {name}" for name, test in tests.items())


def _processes() -> str:
    return "(VALUES ('DISCOVER'), ('ARCHIVE'), ('QUALITY'), ('TRUNCATE'), ('RUNNER')) AS p(run_type)"


def _cell(expression: str) -> str:
    text = f"CAST({expression} AS VARCHAR)"
    return f"CASE WHEN {text} IS NULL OR {text} = '#' THEN '-' ELSE {text} END"


_SUMMARY_CELLS = ", ".join(
    f"{_cell(e)} AS {name}"
    for name, e in {
        "source_partition_name": "partition_name",
        "source_subpartition_name": "subpartition_name",
        "partition_name": "partition_name",
        "subpartition_name": "subpartition_name",
        "partition_hv": "partition_hv",
        "subpartition_hv": "subpartition_hv",
        "archive_status": "archive_status",
        "quality_status": "quality_status",
        "truncate_status": "truncate_status",
        "source_rows": "source_rows",
        "target_rows": "target_rows",
    }.items()
)

_ONE_TABLE = "SELECT source_table, partition_hv, subpartition_hv, n FROM counts"


def _held(where_gone: str, cte: str, source: str | None = None, suffix: str = "") -> str:
    """Rows per unit of one source or of all after the units in ``where_gone`` were emptied."""
    of_source = f"WHERE u.source_table = '{source}'" if source else ""
    return f"""WITH {cte}
SELECT 'CORE' AS source_link, 'SALES' AS source_owner, u.source_table, u.partition_hv, u.subpartition_hv,
       CASE WHEN EXISTS (SELECT 1 FROM {where_gone} g
                         WHERE g.source_table = u.source_table || '{suffix}'
                           AND g.partition_hv = u.partition_hv AND g.subpartition_hv = u.subpartition_hv)
            THEN 0 ELSE c.n END AS n
FROM units u JOIN counts c USING (source_table, partition_hv, subpartition_hv)
{of_source}"""


# The whole archive run: the source is loaded in full, so every closed unit is confirmed.
_RUN = _COUNTS + _POLICY + """,
rule_days AS (
  SELECT 'ORDERS' AS source_table, make_date(y, 12, 31) AS day FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders)
  UNION ALL
  SELECT 'LINEITEM', unnest([make_date(y, 12, 31), make_date(y + 1, 1, 1)])
  FROM (SELECT max(year(l_shipdate)) - 1 AS y FROM lineitem)
),
run AS (
  SELECT u.*, n, u.high < last_business_date AS closed,
         u.high <= last_business_date - days_online
           AND NOT EXISTS (SELECT 1 FROM rule_days r
                           WHERE r.source_table = u.source_table AND r.day < u.high
                             AND r.day >= coalesce(u.low, DATE '0001-01-01')) AS cleaned
  FROM units u JOIN policy USING (source_table) JOIN counts USING (source_table, partition_hv, subpartition_hv)
  WHERE u.high IS NOT NULL
)"""

ORACLE: dict[str, str] = {
    "read_source": f"""WITH {_FACTS}
SELECT source_table, count(*) AS n, CAST(min(d) AS VARCHAR) AS first_day, CAST(max(d) AS VARCHAR) AS last_day
FROM facts GROUP BY source_table""",
    "unit_catalog": f"""WITH {_UNITS}
SELECT {_UNIT}, position FROM units WHERE source_table <> 'EVENTS'""",
    "interval_units": f"""WITH {_UNITS},
months AS (
  SELECT DISTINCT CAST(date_trunc('month', d) AS DATE) AS m FROM facts WHERE source_table = 'ORDERS'
),
monthly AS (
  SELECT m, CAST(m + INTERVAL 1 MONTH AS DATE) AS high FROM months
),
both_kinds AS (
  SELECT source_table, partition_name, low, high, position FROM parts WHERE source_table = 'EVENTS'
  UNION ALL
  SELECT 'ORDERS', strftime(m, 'P%Y%m%d'), m, high,
         CAST(row_number() OVER (ORDER BY m) AS INTEGER)
  FROM monthly
)
SELECT 'CORE' AS source_link, 'SALES' AS source_owner, source_table, CAST(high AS VARCHAR) AS partition_hv,
       '#' AS subpartition_hv, partition_name, '#' AS subpartition_name, 'PARTITION' AS unit_type, {_DATES},
       CAST(NULL AS VARCHAR) AS list_values, position
FROM both_kinds""",
    "list_subunits": f"""WITH {_UNITS}
SELECT {_UNIT}, position FROM units WHERE source_table = 'EVENTS'""",
    "assign_units": f"""WITH {_UNITS}
SELECT l_orderkey, l_linenumber, partition_hv, subpartition_hv
FROM lineitem JOIN units u
  ON u.source_table = 'LINEITEM' AND (u.low IS NULL OR l_shipdate >= u.low)
 AND (u.high IS NULL OR l_shipdate < u.high) AND list_contains(u.lst, l_returnflag)""",
    "unit_slice": f"""SELECT l_orderkey, l_linenumber, l_returnflag, strftime(l_shipdate, {_MICROS}) AS l_shipdate
FROM lineitem
WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1998-01-01' AND l_returnflag IN ('A', 'R')""",
    "unit_slices": f"""WITH {_UNITS}
SELECT o_orderkey, o_custkey, strftime(o_orderdate, {_MICROS}) AS o_orderdate
FROM orders WHERE EXISTS (
  SELECT 1 FROM units u WHERE u.source_table = 'ORDERS' AND u.high IS NOT NULL AND u.position % 2 = 0
     AND (u.low IS NULL OR o_orderdate >= u.low) AND o_orderdate < u.high)""",
    "source_predicates": f"""WITH {_COUNTS},
turns AS (
  SELECT source_table, n, (row_number() OVER (PARTITION BY source_table ORDER BY n DESC, partition_hv, subpartition_hv) - 1) % 5 AS bin
  FROM units JOIN counts USING (source_table, partition_hv, subpartition_hv)
)
SELECT source_table, CAST(bin AS INTEGER) AS bin, count(*) AS units, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n) AS BIGINT) AS rows_read
FROM turns GROUP BY ALL""",
    "clustered_write": f"""WITH {_UNITS},
keyed AS (
  SELECT 'ORDERS' AS source_table, CAST(o_orderdate AS DATE) AS d, CAST(NULL AS VARCHAR) AS v, CAST(o_custkey AS BIGINT) AS k FROM orders
  UNION ALL SELECT 'LINEITEM', CAST(l_shipdate AS DATE), l_returnflag, l_partkey FROM lineitem
  UNION ALL SELECT 'EVENTS', CAST(ts AS DATE), event_type, user_id FROM events
)
SELECT source_table, partition_hv, subpartition_hv, count(*) AS n, min(k) AS first_key, max(k) AS last_key,
       0::BIGINT AS files_overlap
FROM keyed JOIN units u USING (source_table)
WHERE (u.low IS NULL OR d >= u.low) AND (u.high IS NULL OR d < u.high) AND (u.lst IS NULL OR list_contains(u.lst, v))
GROUP BY ALL""",
    "swap_units": f"""WITH {_UNITS},
marked AS (
  SELECT 'ORDERS' AS source_table, CAST(o_orderdate AS DATE) AS d, CAST(NULL AS VARCHAR) AS v,
         year(o_orderdate) <> 1998 AND o_orderkey % 3 <> 0 AS kept FROM orders
  UNION ALL SELECT 'LINEITEM', CAST(l_shipdate AS DATE), l_returnflag, year(l_shipdate) <> 1998 AND l_orderkey % 3 <> 0 FROM lineitem
  UNION ALL SELECT 'EVENTS', CAST(ts AS DATE), event_type, day(ts) <> 20 AND event_id % 3 <> 0 FROM events
)
SELECT source_link, source_owner, u.source_table, partition_hv, subpartition_hv, count(m.d) AS n
FROM units u LEFT JOIN marked m
  ON m.source_table = u.source_table AND (u.low IS NULL OR m.d >= u.low) AND (u.high IS NULL OR m.d < u.high)
 AND (u.lst IS NULL OR list_contains(u.lst, m.v)) AND (u.high <= {_EARLY} OR m.kept)
GROUP BY ALL""",
    "append_state": f"""SELECT run_type, run_status, count(*) AS n FROM (
  SELECT lower({_TYPE}) AS run_type, 'RUNNING' AS run_status FROM events
  UNION ALL
  SELECT '-', {_STATUS} FROM events WHERE event_type <> 'click')
GROUP BY run_type, run_status""",
    "unit_row_counts": f"""WITH {_COUNTS}
SELECT 'CORE' AS source_link, 'SALES' AS source_owner, source_table, partition_hv, subpartition_hv, n
FROM counts""",
    "day_histogram": f"""WITH {_FACTS}
SELECT source_table, CAST(d AS VARCHAR) AS day, coalesce(v, '#') AS list_value, count(*) AS n
FROM facts GROUP BY ALL""",
    "reconcile_recorded": f"""WITH {_LEDGER}
SELECT {_KEY}, source_rows, target_rows, quality_status, error_message
FROM ledger WHERE archive_status = 'Y'""",
    "reconcile_recounted": f"""WITH {_COUNTS}
SELECT {_KEY}, n AS source_rows, kept AS target_rows, CASE WHEN n = kept THEN 'Y' ELSE 'N' END AS quality_status,
       CASE WHEN n <> kept THEN 'Source row count does not match target row count' END AS error_message
FROM units JOIN counts USING (source_table, partition_hv, subpartition_hv)""",
    "step_counters": f"""WITH {_CLEANABLE},
archived AS (SELECT * FROM ledger WHERE archive_status = 'Y'),
totals AS (
  SELECT 'DISCOVER' AS step, count(DISTINCT source_table) AS tables,
         count(DISTINCT source_table || partition_hv) AS partitions, count(*) AS units,
         0 AS ok, 0 AS failed, count(*) AS done, 0 AS preserved FROM ledger
  UNION ALL
  SELECT 'ARCHIVE', count(DISTINCT source_table), count(DISTINCT source_table || partition_hv), count(*),
         0, 0, count(*), 0 FROM archived
  UNION ALL
  SELECT 'QUALITY', count(DISTINCT source_table), count(DISTINCT source_table || partition_hv), count(*),
         count(*) FILTER (WHERE quality_status = 'Y'), count(*) FILTER (WHERE quality_status = 'N'), 0, 0 FROM archived
  UNION ALL
  SELECT 'TRUNCATE', count(DISTINCT source_table), count(DISTINCT source_table || partition_hv), count(*),
         0, 0, 0, count(preserve_date) FROM cleanable
)
SELECT step, tables, partitions, units, CAST(ok AS BIGINT) AS ok, CAST(failed AS BIGINT) AS failed, done,
       CAST(preserved AS BIGINT) AS preserved, CASE WHEN failed > 0 THEN 'WARNING' ELSE 'SUCCESS' END AS run_status
FROM totals""",
    "step_summary": f"""WITH {_LEDGER}
SELECT source_link, source_owner, source_table,
       CASE WHEN quality_status = 'Y' THEN 'OK' ELSE 'MISMATCH' END AS note, {_SUMMARY_CELLS}
FROM ledger WHERE archive_status = 'Y'""",
    "step_summary_cleanup": f"""WITH {_CLEANABLE}
SELECT source_link, source_owner, source_table,
       coalesce('PRESERVED per MAX_preserve_date=' || CAST(preserve_date AS VARCHAR), 'SKIP') AS note,
       {_SUMMARY_CELLS}, {_cell("preserve_date")} AS max_preserve_date
FROM cleanable""",
    "ledger_violations": f"""WITH {_LEDGER}, {_RUNS},
odd AS (
  SELECT * REPLACE (
      target_rows AS last_run_id,
      CASE WHEN target_rows = 0 THEN 'X' ELSE truncate_status END AS truncate_status,
      CASE WHEN partition_name = 'P1996' THEN '#' ELSE subpartition_name END AS subpartition_name)
  FROM (SELECT * FROM ledger UNION ALL SELECT * FROM ledger WHERE partition_name = 'P1997')
),
keyed AS (SELECT *, concat_ws('|', {_KEY}) AS unit_text FROM odd),
config AS (
  SELECT 'CORE' AS source_link, 'SALES' AS source_owner, source_table, 'Y' AS enabled_flag FROM policy
  WHERE source_table <> 'ORDERS'
  UNION ALL SELECT 'local ', 'SALES', source_table, '?' FROM policy WHERE source_table <> 'ORDERS'
),
found AS (
  SELECT 'truncate_status_flag' AS constraint_name, unit_text AS key_text FROM keyed WHERE truncate_status = 'X'
  UNION ALL SELECT 'subpartition_mark', unit_text FROM keyed
    WHERE (unit_type = 'PARTITION') <> (subpartition_name = '#')
  UNION ALL SELECT 'config_enabled_flag', concat_ws('|', source_link, source_owner, source_table) FROM config
    WHERE enabled_flag = '?'
  UNION ALL SELECT 'config_source_link', concat_ws('|', source_link, source_owner, source_table) FROM config
    WHERE upper(trim(source_link)) IN ('LOCAL', 'NONE')
  UNION ALL SELECT 'unit_config_reference', concat_ws('|', source_link, source_owner, source_table) FROM odd
    WHERE source_table = 'ORDERS'
  UNION ALL SELECT 'unit_run_reference', CAST(last_run_id AS VARCHAR) FROM odd
    WHERE last_run_id IS NOT NULL AND last_run_id NOT IN (SELECT run_id FROM runs)
  UNION ALL SELECT 'run_config_reference', concat_ws('|', source_link, source_owner, source_table) FROM runs
)
SELECT constraint_name, key_text, count(*) AS n FROM found GROUP BY constraint_name, key_text
UNION ALL
SELECT 'unit_key', unit_text, count(*) FROM keyed GROUP BY unit_text HAVING count(*) > 1
UNION ALL
SELECT 'unit_target_key', concat_ws('|', target_owner, target_table, partition_hv, subpartition_hv), count(*)
FROM odd GROUP BY target_owner, target_table, partition_hv, subpartition_hv HAVING count(*) > 1
UNION ALL
SELECT 'config_target_key', 'ARCHIVE|' || source_table || '_ARCH', count(*) FROM config
GROUP BY source_table HAVING count(*) > 1""",
    "source_units": f"""WITH {_UNITS}
SELECT {_KEY}, 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, {_DATES}, unit_type,
       partition_name AS source_partition_name, subpartition_name AS source_subpartition_name,
       array_to_string(lst, ',') AS list_values
FROM units WHERE high IS NOT NULL AND source_table <> 'EVENTS'""",
    "undiscovered": f"""WITH {_LEDGER}
SELECT {_ROW}, unit_type FROM ledger WHERE archive_status <> 'Y'""",
    "archivable": f"""WITH {_UNITS}{_POLICY}
SELECT {_KEY}, 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, {_DATES}, unit_type,
       'N' AS archive_status, CAST(last_business_date AS VARCHAR) AS last_business_date
FROM units JOIN policy USING (source_table) WHERE high < last_business_date""",
    "quality_pending": f"""WITH {_LEDGER}
SELECT {_ROW}, {_STATE} FROM ledger WHERE archive_status = 'Y' AND quality_status = 'N'""",
    "truncatable": f"""WITH {_CLEANABLE}
SELECT {_ROW}, CAST(last_business_date AS VARCHAR) AS last_business_date, days_online,
       CAST(cutoff_date AS VARCHAR) AS cutoff_date, target_rows
FROM truncatable""",
    "preserve_match": f"""WITH {_CLEANABLE}
SELECT {_ROW}, CAST(preserve_date AS VARCHAR) AS preserve_date FROM cleanable""",
    "preserve_dates": f"""WITH {_CLEANABLE}
SELECT 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, preserve_rule,
       CAST(day AS VARCHAR) AS preserve_date
FROM policy LEFT JOIN rule_days USING (source_table)""",
    "configured_rules": f"""WITH {_CLEANABLE}
SELECT 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, CAST(day AS VARCHAR) AS preserve_date,
       CASE WHEN source_table = 'EVENTS' OR day IS NULL THEN 'ERROR: execute failed' ELSE 'CORRECT' END AS preserve_calc
FROM policy LEFT JOIN rule_days USING (source_table)""",
    "preserve_status": """
SELECT * FROM (
  SELECT 'ARCHIVE' AS target_owner, 'ORDERS_ARCH' AS target_table,
         CASE WHEN count(o_orderdate) > 0 THEN 'CORRECT' ELSE 'ERROR: execute failed' END AS preserve_calc FROM orders
  UNION ALL
  SELECT 'ARCHIVE', 'LINEITEM_ARCH',
         CASE WHEN min(l_returnflag) = 'A' THEN 'ERROR: execute failed' ELSE 'CORRECT' END FROM lineitem
  UNION ALL SELECT 'ARCHIVE', 'EVENTS_ARCH', 'ERROR: execute failed'
  UNION ALL SELECT 'ARCHIVE', 'ORDERS_ARCH_2', NULL
  UNION ALL SELECT 'ARCHIVE', 'LINEITEM_ARCH_2', 'ERROR: rule was not executed'
  UNION ALL SELECT 'ARCHIVE', 'ORDERS_ARCH_3', 'CORRECT'
  UNION ALL SELECT 'ARCHIVE', 'LINEITEM_ARCH_3',
         CASE WHEN count(l_orderkey) > 0 THEN 'ERROR: execute failed' ELSE 'CORRECT' END FROM lineitem
  UNION ALL SELECT 'ARCHIVE', 'EVENTS_ARCH_2', NULL)""",
    "single_date_rule": """
SELECT 'ARCHIVE' AS target_owner, 'ORDERS_ARCH' AS target_table,
       CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS retention_date FROM orders
UNION ALL
SELECT 'ARCHIVE', 'LINEITEM_ARCH',
       CASE WHEN count(DISTINCT l_returnflag) = 1 AND min(l_returnflag) <> 'A'
            THEN CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR) END FROM lineitem
UNION ALL
SELECT 'ARCHIVE', 'EVENTS_ARCH', NULL""",
    "replica_source_units": f"""WITH {_REPLICA}
SELECT {_ROW}, unit_type, {_LIMITS} FROM based""",
    "replicable": f"""WITH {_REPLICA}
SELECT {_ROW}, {_LIMITS} FROM replica WHERE replica_status = 'N' AND high > cutoff_date""",
    "purgeable": f"""WITH {_REPLICA}
SELECT {_ROW}, {_LIMITS}, target_rows FROM replica WHERE replica_status = 'Y' AND high <= cutoff_date""",
    "scope": f"""WITH {_CLEANABLE}
SELECT DISTINCT source_link, source_owner, source_table, target_owner, target_table, '*' AS partition_hv
FROM truncatable
UNION ALL
SELECT DISTINCT source_link, source_owner, source_table, target_owner, target_table, partition_hv
FROM truncatable WHERE target_table = 'LINEITEM_ARCH'""",
    "discover": f"""WITH {_UNITS}
SELECT {_KEY}, 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, {_DATES}, unit_type,
       subpartition_name AS source_subpartition_name,
       CASE WHEN unit_type = 'PARTITION' THEN '#' ELSE 'T_' || subpartition_name END AS subpartition_name,
       'N' AS archive_status, 'N' AS quality_status, 'N' AS truncate_status, CAST(NULL AS BIGINT) AS source_rows,
       CAST(NULL AS BIGINT) AS target_rows, CAST(1 AS BIGINT) AS last_run_id, CAST(NULL AS VARCHAR) AS error_message
FROM units WHERE high IS NOT NULL""",
    "archive": f"""WITH {_LEDGER}
SELECT {_KEY}, source_rows AS n FROM ledger WHERE archive_status = 'Y'""",
    "replicate": f"""WITH {_REPLICA}
SELECT r.source_link, r.source_owner, r.source_table, r.partition_hv, r.subpartition_hv, c.n
FROM replica r JOIN counts c ON c.source_table || '_ARCH' = r.source_table
 AND c.partition_hv = r.partition_hv AND c.subpartition_hv = r.subpartition_hv
WHERE replica_status = 'N' AND high > cutoff_date""",
    "cleanup_units": f"""WITH {_COUNTS},
held AS (
  SELECT u.source_table, partition_hv, subpartition_hv, n, coalesce(high <= {_EARLY}, FALSE) AS early
  FROM units u JOIN counts USING (source_table, partition_hv, subpartition_hv)
),
left_over AS (
  SELECT source_table, count(*) FILTER (WHERE n > 0 AND NOT early) AS dropped, count(*) FILTER (WHERE n > 0 OR early) AS emptied
  FROM held GROUP BY source_table
)
SELECT source_table, cleanup_mode, partition_hv, subpartition_hv, CASE WHEN early THEN 0 ELSE n END AS n,
       CASE WHEN cleanup_mode = 'DROP' THEN dropped ELSE emptied END AS partitions_kept
FROM held JOIN left_over USING (source_table), (VALUES ('TRUNCATE'), ('DELETE'), ('DROP')) AS m(cleanup_mode)""",
    "rows_outside": f"""SELECT 'ORDERS' AS source_table, CAST(o_orderkey AS VARCHAR) AS row_key, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
FROM orders WHERE o_orderdate >= DATE '1998-01-01'
UNION ALL SELECT 'LINEITEM', l_orderkey || '-' || l_linenumber, CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
FROM lineitem WHERE l_shipdate >= DATE '1998-01-01'
UNION ALL SELECT 'EVENTS', CAST(event_id AS VARCHAR), CAST(CAST(ts AS DATE) AS VARCHAR)
FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-15'""",
    "truncate_flat_source": f"""WITH {_COUNTS}
SELECT {_KEY}, CASE WHEN position % 2 = 0 THEN 0 ELSE n END AS rows_left, CASE WHEN position % 2 = 0 THEN n END AS rows_removed
FROM units JOIN counts USING (source_table, partition_hv, subpartition_hv)""",
    "business_dates": """SELECT * FROM (VALUES
  ('ORDERS', '2001-06-01', 'ROWS'),
  ('LINEITEM', (SELECT CAST(CAST(max(l_shipdate) AS DATE) - 30 AS VARCHAR) FROM lineitem), 'ROWS'),
  ('EVENTS', NULL, 'EMPTY'), ('PARTS', NULL, 'FAILED'), ('SUPPLIERS', NULL, 'EMPTY')
) AS t(source_table, last_business_date, business_date_state)""",
    "truncate_source": _held("(SELECT * FROM cleanable WHERE preserve_date IS NULL)", _CLEANABLE),
    "purge": _held("(SELECT * FROM replica WHERE replica_status = 'Y' AND high <= cutoff_date)", _REPLICA, suffix="_ARCH"),
    "mark_units": f"""WITH {_COUNTS},
u AS (SELECT {_KEY}, n FROM units JOIN counts USING (source_table, partition_hv, subpartition_hv)
      WHERE high IS NOT NULL)
SELECT {_KEY}, seq, archive_status, quality_status, truncate_status, source_rows, target_rows, last_run_id,
       error_message
FROM (
  SELECT *, 0 AS seq, 'N' AS archive_status, 'N' AS quality_status, 'N' AS truncate_status,
         CAST(NULL AS BIGINT) AS source_rows, CAST(NULL AS BIGINT) AS target_rows, CAST(1 AS BIGINT) AS last_run_id,
         CAST(NULL AS VARCHAR) AS error_message FROM u
  UNION ALL SELECT *, 1, 'N', NULL, NULL, NULL, NULL, 2, NULL FROM u
  UNION ALL SELECT *, 2, 'Y', 'N', NULL, NULL, n, 2, NULL FROM u
  UNION ALL SELECT *, 3, NULL, 'Y', NULL, n, NULL, 3, NULL FROM u
  UNION ALL SELECT *, 4, 'N', NULL, NULL, NULL, NULL, 4, 'load was cut off' FROM u WHERE n % 2 = 1
  UNION ALL SELECT *, 5, 'Y', 'N', NULL, NULL, n + 1, 5, NULL FROM u WHERE n % 4 = 0)""",
    "current_units": f"""WITH {_COUNTS}
SELECT {_KEY}, 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, {_DATES}, unit_type,
       CASE WHEN n % 2 = 1 THEN 'N' ELSE 'Y' END AS archive_status,
       CASE WHEN n % 4 = 0 THEN 'N' ELSE 'Y' END AS quality_status, 'N' AS truncate_status,
       n AS source_rows, CASE WHEN n % 4 = 0 THEN n + 1 ELSE n END AS target_rows,
       CAST(CASE WHEN n % 4 = 0 THEN 5 WHEN n % 2 = 1 THEN 4 ELSE 3 END AS BIGINT) AS last_run_id,
       CASE WHEN n % 2 = 1 THEN 'load was cut off' END AS error_message
FROM units JOIN counts USING (source_table, partition_hv, subpartition_hv) WHERE high IS NOT NULL""",
    "rejected_events": f"""WITH {_UNITS},
u AS (SELECT source_link, source_owner, source_table, partition_hv, subpartition_hv, high FROM units WHERE high IS NOT NULL),
o AS (SELECT * FROM u WHERE source_table = 'ORDERS')
SELECT {_KEY}, 0 AS seq, 'unit_key' AS constraint_name FROM o WHERE month(high) = 1
UNION ALL SELECT {_KEY}, 1, 'quality_status_flag' FROM u WHERE source_table = 'LINEITEM' AND subpartition_hv = 'N'
UNION ALL SELECT source_link, 'NOBODY', source_table, partition_hv, subpartition_hv, 2, 'unit_described' FROM o
UNION ALL SELECT source_link, 'OTHER', source_table, partition_hv, subpartition_hv, 3, c
FROM o, (VALUES ('unit_target_key'), ('unit_config_reference')) AS t(c)
UNION ALL SELECT {_KEY}, 4, 'unit_run_reference' FROM o
UNION ALL SELECT {_KEY}, 0, 'unit_target_key' FROM o WHERE month(high) = 1""",
    "compact_state": f"""WITH {_COUNTS}
SELECT {_KEY}, 'ARCHIVE' AS target_owner, source_table || '_ARCH' AS target_table, {_DATES}, unit_type,
       CASE WHEN n % 2 = 1 THEN 'N' ELSE 'Y' END AS archive_status,
       CASE WHEN n % 4 = 0 THEN 'N' ELSE 'Y' END AS quality_status, 'N' AS truncate_status,
       n AS source_rows, CASE WHEN n % 4 = 0 THEN n + 1 ELSE n END AS target_rows,
       CAST(CASE WHEN n % 4 = 0 THEN 5 WHEN n % 2 = 1 THEN 4 ELSE 3 END AS BIGINT) AS last_run_id,
       CASE WHEN n % 2 = 1 THEN 'load was cut off' END AS error_message, 1 AS batches
FROM units JOIN counts USING (source_table, partition_hv, subpartition_hv) WHERE high IS NOT NULL""",
    "run_archive": f"""WITH {_RUN}
SELECT {_KEY}, CASE WHEN closed THEN 'Y' ELSE 'N' END AS archive_status,
       CASE WHEN closed THEN 'Y' ELSE 'N' END AS quality_status, CASE WHEN cleaned THEN 'Y' ELSE 'N' END AS truncate_status,
       CASE WHEN closed THEN n END AS source_rows, CASE WHEN closed THEN n END AS target_rows,
       CASE WHEN cleaned THEN 0 ELSE n END AS source_left, CASE WHEN closed THEN n ELSE 0 END AS target_held
FROM run""",
    "run_replica": f"""WITH {_RUN},
window_days AS (
  SELECT * FROM (VALUES ('ORDERS', 365), ('LINEITEM', 365), ('EVENTS', 7)) AS t(source_table, keep_days)
),
followed AS (
  SELECT run.*, high > max(high) OVER (PARTITION BY source_table) - keep_days AS kept_online
  FROM run JOIN window_days USING (source_table) WHERE closed
)
SELECT 'VAULT' AS source_link, 'ARCHIVE' AS source_owner, source_table || '_ARCH' AS source_table, partition_hv,
       subpartition_hv, CASE WHEN kept_online THEN 'Y' ELSE 'N' END AS replica_status,
       CASE WHEN kept_online THEN 'Y' ELSE 'N' END AS quality_status, 'N' AS purge_status,
       CASE WHEN kept_online THEN n END AS source_rows, CASE WHEN kept_online THEN n END AS target_rows,
       CASE WHEN kept_online THEN n ELSE 0 END AS target_held
FROM followed""",
    "run_replica_purge": f"""WITH {_RUN},
window_days AS (
  SELECT * FROM (VALUES ('ORDERS', 365, 100), ('LINEITEM', 365, 100), ('EVENTS', 7, 3)) AS t(source_table, first_days, then_days)
),
followed AS (
  SELECT run.*, high > max(high) OVER (PARTITION BY source_table) - first_days AS loaded,
         high <= max(high) OVER (PARTITION BY source_table) - then_days AS left_window
  FROM run JOIN window_days USING (source_table) WHERE closed
)
SELECT 'VAULT' AS source_link, 'ARCHIVE' AS source_owner, source_table || '_ARCH' AS source_table, partition_hv,
       subpartition_hv, CASE WHEN loaded THEN 'Y' ELSE 'N' END AS replica_status,
       CASE WHEN loaded THEN 'Y' ELSE 'N' END AS quality_status, CASE WHEN loaded AND left_window THEN 'Y' ELSE 'N' END AS purge_status,
       CASE WHEN loaded THEN n END AS source_rows, CASE WHEN loaded THEN n END AS target_rows,
       CASE WHEN loaded AND NOT left_window THEN n ELSE 0 END AS target_held
FROM followed""",
    "current_runs": f"""WITH {_RUNS}
SELECT run_id, run_type, run_status, source_link, source_owner, source_table, mstr_log_id,
       strftime(started_at, {_MICROS}) AS started_at, strftime(ended_at, {_MICROS}) AS ended_at, execute_flag,
       error_message
FROM runs""",
    "consolidate_log": f"""
WITH entries AS (
  SELECT *, strftime(ts, '%d-%m-%Y %H:%M:%S') AS stamp, event_type || ' ' || props AS msg FROM events
  WHERE event_type <> 'view'
)
SELECT user_id AS mstr_log_id, user_id AS log_id,
       arg_max({_TYPE}, ts) FILTER (WHERE event_type <> 'click') AS log_categ,
       coalesce(arg_max({_STATUS}, ts) FILTER (WHERE event_type IN ('error', 'signup')), 'UNDEFINED') AS log_status,
       strftime(coalesce(max(ts) FILTER (WHERE event_type = 'signup'), min(ts)), {_MICROS}) AS start_date,
       strftime(max(ts) FILTER (WHERE event_type IN ('error', 'purchase')), {_MICROS}) AS end_date,
       string_agg(chr(10) || stamp || ' | ' || msg || chr(10), '' ORDER BY ts, CAST(event_id AS VARCHAR)) AS log_msg,
       '[' || string_agg('{{"type":"' || CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'TEXT' END
                         || '","timestamp":"' || stamp || '","message":"' || replace(msg, '"', '\\"') || '"}}', ','
                         ORDER BY ts, CAST(event_id AS VARCHAR)) || ']' AS log_json,
       arg_max(CAST(event_id AS VARCHAR), ts) FILTER (WHERE event_type = 'error') AS last_err_code,
       arg_max(props, ts) FILTER (WHERE event_type = 'error') AS last_err_desc
FROM entries GROUP BY user_id""",
    "log_durations": f"""WITH {_LOG}
SELECT log_id, date_diff('second', start_date, start_date + (end_date - start_date)) AS seconds,
       CAST(log_id % 60 AS BIGINT) AS second_part
FROM log""",
    "expired_log_partitions": """
SELECT CAST(m AS VARCHAR) AS log_month, CAST(CAST(m + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS partition_high,
       count(*) AS entries
FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS m FROM orders
      WHERE o_orderdate >= TIMESTAMP '1996-01-01 00:00:00')
WHERE m + INTERVAL 1 MONTH < TIMESTAMP '2001-06-01 12:00:00' - INTERVAL 90 DAY
GROUP BY m""",
    "in_window": f"""WITH {_RUNS}
SELECT 7 AS lookback_days, '2024-01-24 00:00:00' AS window_start, '2024-01-31 00:00:00' AS window_end,
       count(*) AS rows_in_window
FROM recent""",
    "exec_summary": f"""WITH {_RUNS},
newest AS (SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1)
SELECT count(*) AS runs_total, {_tally()},
       (SELECT run_status FROM newest) AS latest_status,
       (SELECT strftime(started_at, {_SECONDS}) FROM newest) AS latest_started,
       (SELECT substr(error_message, 1, 240) FROM newest) AS latest_error
FROM recent""",
    "process_summary": f"""WITH {_RUNS}
SELECT p.run_type, count(r.run_id) AS runs_total, {_tally("r.")},
       strftime(max(started_at), {_SECONDS}) AS latest_started
FROM {_processes()} LEFT JOIN recent r ON r.run_type = p.run_type
GROUP BY p.run_type""",
    "latest_summaries": f"""WITH {_LOG}
SELECT p.run_type, coalesce(arg_max(log_status, start_date), 'N/A') AS latest_status,
       coalesce(strftime(max(start_date), {_SECONDS}), 'N/A') AS latest_started,
       coalesce(arg_max(summary_text, start_date), 'No summary available') AS summary_text
FROM {_processes()}
LEFT JOIN log ON log_categ = p.run_type AND summary_text IS NOT NULL
             AND start_date >= TIMESTAMP '2024-01-24 00:00:00'
GROUP BY p.run_type""",
    "data_status": f"""WITH {_LEDGER}
SELECT target_owner, target_table, count(*) AS units_total,
       count(*) FILTER (WHERE archive_status = 'Y') AS archived_units,
       count(*) FILTER (WHERE archive_status = 'N') AS archive_pending,
       count(*) FILTER (WHERE quality_status = 'Y') AS quality_ok_units,
       count(*) FILTER (WHERE quality_status = 'N') AS quality_pending,
       count(*) FILTER (WHERE truncate_status = 'Y') AS truncated_units,
       count(*) FILTER (WHERE truncate_status = 'N') AS truncate_pending,
       CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows
FROM ledger GROUP BY target_owner, target_table""",
    "replica_data_status": f"""WITH {_REPLICA}
SELECT target_owner, target_table, count(*) AS units_total,
       count(*) FILTER (WHERE replica_status = 'Y') AS replicated_units,
       count(*) FILTER (WHERE replica_status = 'N') AS replicate_pending,
       count(*) FILTER (WHERE quality_status = 'Y') AS quality_ok_units,
       count(*) FILTER (WHERE quality_status = 'N') AS quality_pending,
       count(*) FILTER (WHERE purge_status = 'Y') AS purged_units,
       count(*) FILTER (WHERE purge_status = 'N') AS purge_pending,
       CAST(sum(source_rows) AS BIGINT) AS source_rows, CAST(sum(target_rows) AS BIGINT) AS target_rows
FROM replica GROUP BY target_owner, target_table""",
    "pending_work": f"""WITH {_LEDGER}
SELECT source_link, source_owner, source_table, target_table,
       count(*) FILTER (WHERE archive_status = 'N') AS pending_archive,
       count(*) FILTER (WHERE archive_status = 'Y' AND quality_status = 'N') AS pending_quality,
       count(*) FILTER (WHERE quality_status = 'Y' AND truncate_status = 'N') AS truncate_candidates,
       count(error_message) AS units_with_error
FROM ledger GROUP BY ALL
HAVING count(*) FILTER (WHERE truncate_status = 'N' OR error_message IS NOT NULL) > 0""",
    "replica_pending_work": f"""WITH {_REPLICA}
SELECT source_link, source_owner, source_table, target_table,
       count(*) FILTER (WHERE replica_status = 'N') AS pending_replicate,
       CAST(0 AS BIGINT) AS pending_quality,
       count(*) FILTER (WHERE quality_status = 'Y') AS purge_candidates,
       count(error_message) AS units_with_error
FROM replica GROUP BY ALL""",
    "recent_issues": f"""WITH {_RUNS}, {_LOG},
issues AS (
  SELECT started_at AS happened, 'RUN ' || run_type AS source_name, run_status AS status_name,
         substr(coalesce(error_message, source_owner || '.' || source_table), 1, 300) AS message_text
  FROM recent WHERE run_status IN ('WARNING', 'ERROR')
  UNION ALL
  SELECT start_date, log_categ, log_status, substr(log_msg, 1, 300) FROM log
  WHERE start_date >= TIMESTAMP '2024-01-24 00:00:00'
    AND (log_status IN ('WARNING', 'ERROR') OR last_err_code IS NOT NULL)
)
SELECT strftime(happened, {_SECONDS}) AS issue_time, source_name, status_name, message_text
FROM (SELECT * FROM issues ORDER BY happened DESC, source_name, status_name, message_text LIMIT 20)""",
    "latest_summary": f"""WITH {_LOG}
SELECT log_categ AS process, log_status, strftime(start_date, {_MICROS}) AS start_date,
       strftime(end_date, {_MICROS}) AS end_date, log_id, summary_text
FROM log WHERE log_categ = 'QUALITY' ORDER BY log.start_date DESC, log_id DESC LIMIT 1""",
    "cap_rows": f"""WITH {_RUNS}
SELECT run_id, run_type, run_status, execute_flag FROM runs ORDER BY run_type, run_id LIMIT 100""",
}
