"""DataFrame -> DataFrame operators. All are lazy; none collects."""

from casemart.operators.dedup import dedup_by_priority, duplicate_audit, step_counts
from casemart.operators.keys import any_value_per_group, distinct_rows, with_surrogate_key
from casemart.operators.metrics import (
    Summary,
    delay_by_group,
    flag_counts,
    group_counts,
    rate_by_group,
    share_of_total,
    summarise,
    summarise_by_dimension,
    with_share,
)
from casemart.operators.partials import changed, fold
from casemart.operators.profile import null_audit, profile, value_counts
from casemart.operators.quality import (
    Check,
    check_not_null,
    check_unique,
    code_collisions,
    run_checks,
)
from casemart.operators.reshape import (
    long_form,
    matrix,
    merge_null_safe,
    sort_nulls_last,
    top_n,
)

__all__ = [
    "Check",
    "Summary",
    "any_value_per_group",
    "changed",
    "check_not_null",
    "check_unique",
    "code_collisions",
    "dedup_by_priority",
    "delay_by_group",
    "distinct_rows",
    "duplicate_audit",
    "flag_counts",
    "fold",
    "group_counts",
    "long_form",
    "matrix",
    "merge_null_safe",
    "null_audit",
    "profile",
    "rate_by_group",
    "run_checks",
    "share_of_total",
    "sort_nulls_last",
    "step_counts",
    "summarise",
    "summarise_by_dimension",
    "top_n",
    "value_counts",
    "with_share",
    "with_surrogate_key",
]
