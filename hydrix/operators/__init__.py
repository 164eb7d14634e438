"""DataFrame -> DataFrame operators."""

from hydrix.operators.check_states import partition_states, state_results
from hydrix.operators.columns import (
    count_parse_failures,
    date_window,
    not_null_all,
    numeric_columns,
    parse_failures,
    require_fields,
    select_numeric,
    standardize_columns,
)
from hydrix.operators.dedup import dedup_any, dedup_keys, dedup_stats
from hydrix.operators.metrics import (
    conformity_by_group,
    distinct_values,
    nonconformity_by_group,
    value_counts,
    worst_k,
    yearly_trend,
)
from hydrix.operators.profile import describe_numeric, null_profile, numeric_extremes, row_count
from hydrix.operators.rejects import RejectRule, observed, reject_reasons, split_rejects, write_split
from hydrix.operators.quality import (
    aggregate_consistency,
    assert_checks,
    at_least,
    at_least_mostly,
    between,
    check_between,
    check_min,
    check_min_tolerance,
    check_not_null,
    check_subset,
    expect,
    failing_rows,
    render_report,
    greater_than,
    not_null,
    run_checks,
    suite_summary,
)

from hydrix.operators.rule_tables import categorize_by_table, rule_table

__all__ = [name for name in dir() if not name.startswith("_")]
