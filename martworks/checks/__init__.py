"""Data-quality checks. Each takes a DataFrame and returns its failing rows: no rows means the check passes. A column is
SQL text: usually a name, but any expression will do. Columns to group by are names."""

from martworks.checks.compare import (
    cardinality_equality,
    equal_rowcount,
    equal_rowcount_failures,
    equality,
    equality_failures,
    expect_rows,
    fewer_rows_than,
    fewer_rows_than_failures,
    orphans,
    relationships,
    relationships_where,
)
from martworks.checks.groups import (
    accepted_values,
    at_least_one,
    not_accepted_values,
    not_constant,
    not_null_proportion,
    recency,
    unique,
    unique_combination,
)
from martworks.checks.order import mutually_exclusive_ranges, sequential_values
from martworks.checks.rows import accepted_range, expression_is_true, not_empty_string, not_null
from martworks.checks.suite import (
    AcceptedValues,
    Check,
    Expression,
    NotNull,
    Query,
    Relationship,
    Unique,
    failure_count,
    run_checks,
)

__all__ = [
    "AcceptedValues", "Check", "Expression", "NotNull", "Query", "Relationship", "Unique", "accepted_range",
    "accepted_values", "at_least_one", "cardinality_equality", "equal_rowcount", "equal_rowcount_failures", "equality",
    "equality_failures", "expect_rows", "expression_is_true", "failure_count", "fewer_rows_than",
    "fewer_rows_than_failures", "mutually_exclusive_ranges", "not_accepted_values", "not_constant", "not_empty_string",
    "not_null", "not_null_proportion", "orphans", "recency", "relationships", "relationships_where", "run_checks",
    "sequential_values", "unique", "unique_combination",
]
