"""DataFrame operators that SQL engines ship as statements and Spark composes from joins and aggregates."""

from silverlode.operators.keyed import (
    absent_from,
    first_per_key,
    latest_per_key,
    merge_rows,
    split_null_keys,
    update_columns,
)
from silverlode.operators.numbering import number_rows, pin
from silverlode.operators.reports import running_delta, share_of_total, top_rows
from silverlode.operators.quality import (
    Reference,
    Rule,
    check_references,
    check_rules,
    raise_on_critical,
    run_checks,
    summarize,
)

__all__ = [
    "Reference",
    "Rule",
    "absent_from",
    "check_references",
    "check_rules",
    "first_per_key",
    "latest_per_key",
    "merge_rows",
    "number_rows",
    "pin",
    "raise_on_critical",
    "run_checks",
    "running_delta",
    "share_of_total",
    "split_null_keys",
    "summarize",
    "top_rows",
    "update_columns",
]
