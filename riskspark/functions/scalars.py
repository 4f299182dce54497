"""Built-in expressions with the edge cases the operators need."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from math import isfinite

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Drift bands and comparison tolerances.
MODERATE_DRIFT = 0.10
HIGH_DRIFT = 0.25
TIE_ABSOLUTE = 1e-12
TIE_RELATIVE = 1e-5


def sql_literal(value: str | int | float | bool | None) -> str:
    """A value as SQL text, for generated expressions with many constants."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    if isinstance(value, float):
        return f"{value!r}D" if isfinite(value) else f"double('{value!r}')"
    return str(value)


EPOCH = datetime(1970, 1, 1)


def micros_of(df: DataFrame, name: str) -> Column:
    """Microseconds of a time column, the same in every session time zone."""
    time = F.col(name)
    if df.schema[name].dataType.simpleString() != "timestamp_ntz":
        return F.unix_micros(time.cast("timestamp"))
    days = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = (days * 24 + F.hour(time)) * 60 + F.minute(time)
    seconds = F.extract(F.lit("SECOND"), time).cast("decimal(18,6)")
    return minutes * 60_000_000 + (seconds * 1_000_000).cast("long")


def instant(df: DataFrame, name: str, micros: int) -> Column:
    """The literal of a time column's type that lies at these microseconds."""
    if df.schema[name].dataType.simpleString() != "timestamp_ntz":
        return F.timestamp_micros(F.lit(micros))
    text = (EPOCH + timedelta(microseconds=micros)).isoformat(sep=" ", timespec="microseconds")
    return F.lit(text).cast("timestamp_ntz")


def sql_name(column: str) -> str:
    quoted = column.replace("`", "``")
    return f"`{quoted}`"


def ratio(numerator: Column, denominator: Column, default: float | None = None) -> Column:
    """Double division; ``default`` (NULL if not given) where the denominator is 0."""
    value = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def sigmoid(logit: Column) -> Column:
    """Logistic function that never exponentiates a positive number."""
    shrunk = F.exp(-F.abs(logit))
    return F.when(logit >= 0, 1.0 / (1.0 + shrunk)).otherwise(shrunk / (1.0 + shrunk))


def is_infinite(value: Column) -> Column:
    return F.abs(value.cast("double")) == F.lit(float("inf"))


def is_finite(value: Column) -> Column:
    """False for NULL, NaN and both infinities."""
    double = value.cast("double")
    return F.coalesce(~F.isnan(double) & (F.abs(double) < F.lit(float("inf"))), F.lit(False))


def close_to(actual: Column, expected: Column, *, rtol: float, atol: float) -> Column:
    return F.abs(actual - expected) <= F.lit(float(atol)) + F.lit(float(rtol)) * F.abs(expected)


def tied_with_best(
    value: Column, best: Column, *, rtol: float = TIE_RELATIVE, atol: float = TIE_ABSOLUTE
) -> Column:
    """Whether a metric counts as equal to the best one."""
    return close_to(value, best, rtol=rtol, atol=atol)


def drift_level(value: Column) -> Column:
    return (
        F.when(value < MODERATE_DRIFT, "low").when(value < HIGH_DRIFT, "moderate").otherwise("high")
    )


# The characters of the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def stripped(text: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.trim(text, F.lit(WHITE_SPACE))


def texts_that_apply(texts: Sequence[tuple[str, Column]]) -> Column:
    """Array of the texts whose condition holds, in order; the texts hold no comma.

    ``concat_ws`` skips NULLs in generated code, where filtering an array by a
    lambda would interpret it element by element.
    """
    joined = F.concat_ws(",", *[F.when(condition, F.lit(text)) for text, condition in texts])
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ","))


def to_rows(wide: DataFrame, entries: Sequence[tuple], names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Turn a narrow-row aggregate into long rows, one per entry.

    ``entries`` holds one tuple of columns per output row; only aggregates
    (a handful of rows) pass through here, never raw data.
    """
    structs = [
        F.struct(*[value.alias(name) for value, name in zip(entry, names, strict=True)])
        for entry in entries
    ]
    exploded = wide.select(*keep, F.explode(F.array(*structs)).alias("_row"))
    return exploded.select(*keep, *[F.col(f"_row.{name}").alias(name) for name in names])
