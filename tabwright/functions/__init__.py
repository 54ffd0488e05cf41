"""Column expressions: everything here maps columns to a column and runs inside codegen."""

from tabwright.functions.columns import (
    binary_label,
    blank_to_null,
    bucket,
    count_matching,
    digest,
    log_uniform,
    pick,
    safe_ratio,
    to_double,
    unit_uniform,
    weight_for,
)

__all__ = [
    "binary_label",
    "blank_to_null",
    "bucket",
    "count_matching",
    "digest",
    "log_uniform",
    "pick",
    "safe_ratio",
    "to_double",
    "unit_uniform",
    "weight_for",
]
