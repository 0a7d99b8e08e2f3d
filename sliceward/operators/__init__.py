"""The lifecycle operators; every public function takes and returns DataFrames."""

from sliceward.operators.assign import assign_units, laid_out_by_unit, source_predicates, unit_slice, unit_slices
from sliceward.operators.candidates import (
    archivable,
    base_dates,
    purgeable,
    quality_pending,
    replica_source_units,
    replicable,
    scope,
    scoped_tables,
    source_units,
    truncatable,
    undiscovered,
)
from sliceward.operators.catalog import interval_units, list_subunits, unit_catalog
from sliceward.operators.checks import ledger_violations, rejected_events, require_valid, step_counters, step_summary
from sliceward.operators.counts import (
    day_histogram,
    reconcile_recorded,
    reconcile_recounted,
    stored_row_counts,
    unit_row_counts,
)
from sliceward.operators.movement import (
    cleanup_events,
    cleanup_units,
    clustered_write,
    create_unit_table,
    discover_events,
    drop_partitions,
    load_units,
    resolve_targets,
    rows_outside,
    swap_units,
    truncate_flat_source,
)
from sliceward.operators.reports import (
    cap_rows,
    data_status,
    exec_summary,
    in_window,
    latest_summaries,
    latest_summary,
    latest_summary_of,
    pending_work,
    process_summary,
    recent_issues,
    report_sections,
    report_window,
)
from sliceward.operators.retention import (
    business_dates,
    configured_rules,
    preserve_dates,
    preserve_match,
    preserve_status,
    rule_rows,
    single_date_rule,
)
from sliceward.operators.state import (
    consolidate_log,
    current_runs,
    current_units,
    deciding_run_events,
    deciding_unit_events,
    expired_log_partitions,
    log_durations,
    mark_units,
    unit_events,
)

__all__ = [name for name in dir() if not name.startswith("_")]
