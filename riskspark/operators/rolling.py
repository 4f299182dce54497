"""A reference window that moves by days without reading the rows again.

Every day is reduced once to counts of its values. A window is the sum of its
days; moving it adds the days that enter and subtracts those that leave, so the
work is that of the days that change. Counts are whole numbers: a moved window
is exactly the one that a full pass gives.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.functions import micros_of
from riskspark.operators.monitor import PSI_BINS, NumericReference, require_finite
from riskspark.operators.ordering import quantiles_of_counts, value_counts

Days = tuple[dt.date, dt.date]


def day_counts(df: DataFrame, columns: Sequence[str], *, contract: Contract = DEFAULT_CONTRACT) -> DataFrame:
    """Rows ``(day, feature, value, n)``; values must be finite, as in any reference.

    Days are UTC days of the event time. Rows without a time belong to no day.
    Write the result partitioned by ``day``: a window then reads its days alone.
    """
    require_finite(df, columns, "Reference")
    micros = micros_of(df, contract.time)
    day = F.date_add(F.lit(dt.date(1970, 1, 1)), F.floor(micros / F.lit(86_400_000_000)).cast("int"))
    dated = df.select(*columns, day.alias("day")).filter(F.col("day").isNotNull())
    return value_counts(dated, columns, by=["day"])


def _between(days: DataFrame, span: Days) -> DataFrame:
    return days.filter(F.col("day").between(F.lit(span[0]), F.lit(span[1])))


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("feature", "value").agg(F.sum("n").alias("n")).filter("n > 0")


def window(days: DataFrame, span: Days) -> DataFrame:
    """Counts ``(feature, value, n)`` of the days from the first to the last of ``span``."""
    return _summed(_between(days, span).select("feature", "value", "n"))


def moved(counts: DataFrame, days: DataFrame, old: Days, new: Days) -> DataFrame:
    """The window ``new`` from that of ``old``; only the days in one of the two are read."""
    inside = lambda span: F.col("day").between(F.lit(span[0]), F.lit(span[1]))
    enter = days.filter(inside(new) & ~inside(old)).select("feature", "value", "n")
    leave = days.filter(inside(old) & ~inside(new)).select("feature", "value", (-F.col("n")).alias("n"))
    return _summed(counts.select("feature", "value", "n").unionByName(enter).unionByName(leave))


def window_reference(counts: DataFrame, *, bins: int = PSI_BINS) -> NumericReference:
    """Bin edges and medians of a window, as a full pass over its rows gives them."""
    inner = [i / bins for i in range(1, bins)]
    found = {r["feature"]: r["quantiles"] for r in quantiles_of_counts(counts, [*inner, 0.5]).collect()}
    return NumericReference({c: sorted(set(q[:-1])) for c, q in found.items()}, {c: q[-1] for c, q in found.items()})


def window_summary(counts: DataFrame) -> DataFrame:
    """``feature``, ``rows``, ``mean``, ``min``, ``median``, ``max`` of a window."""
    plain = counts.groupBy("feature").agg(
        F.sum("n").alias("rows"),
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    middle = quantiles_of_counts(counts, [0.5]).select("feature", F.element_at("quantiles", 1).alias("median"))
    return plain.join(middle, "feature")
