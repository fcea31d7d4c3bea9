"""DataFrame transforms."""

from martworks.operators.aggregates import (
    column_value_list,
    column_values,
    count_where,
    group_by_first,
    join_summary,
    not_null_share,
)
from martworks.operators.columns import filtered_columns, nullcheck, nullcheck_table, star
from martworks.operators.ordered import deduplicate, repeat_rows, sequence_no, with_next, with_previous
from martworks.operators.reshape import pivot, union_relations, unpivot
from martworks.operators.series import date_spine, date_spine_between, generate_series
from martworks.operators.setops import symmetric_diff

__all__ = [
    "column_value_list", "column_values", "count_where", "date_spine", "date_spine_between", "deduplicate",
    "filtered_columns", "generate_series", "group_by_first", "join_summary", "not_null_share", "nullcheck",
    "nullcheck_table", "pivot", "repeat_rows", "sequence_no", "star", "symmetric_diff", "union_relations", "unpivot",
    "with_next", "with_previous",
]
