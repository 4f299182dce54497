"""Column expressions shared by the operators."""

from riskspark.functions.scalars import (
    close_to,
    drift_level,
    instant,
    is_finite,
    is_infinite,
    micros_of,
    ratio,
    sigmoid,
    sql_literal,
    sql_name,
    stripped,
    texts_that_apply,
    tied_with_best,
    to_rows,
)

__all__ = [
    "close_to",
    "drift_level",
    "instant",
    "is_finite",
    "is_infinite",
    "micros_of",
    "ratio",
    "sigmoid",
    "sql_literal",
    "sql_name",
    "stripped",
    "texts_that_apply",
    "tied_with_best",
    "to_rows",
]
