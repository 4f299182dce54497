"""Recent-behaviour columns per customer: activity in 24 hours, average in 30 days.

A look-back period is made of whole hours between two cut hours. Whole hours
are summed once per customer and hour; only the rows of the two cut hours are
summed one by one. So no task holds a customer's whole history, work grows with
the rows, and nothing is ever subtracted: each figure is a sum of exactly the
amounts of its period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.contract import DEFAULT_CONTRACT, Contract
from riskspark.functions import micros_of
from riskspark.sources.scratch import stored

# The two look-back periods.
ACTIVITY_HOURS = 24
AVERAGE_DAYS = 30
_HOUR = 3_600_000_000
# Per instant: rows, amounts, sum of the finite ones, and a bit for each kind of the others.
_SUMS = ("n", "amounts", "total", "odd")
_NAN, _HIGH, _LOW = 1, 2, 4


def velocity_features(
    df: DataFrame, *, customer: str = "customer_id", contract: Contract = DEFAULT_CONTRACT
) -> DataFrame:
    """Add ``transactions_last_24h`` and ``avg_amount_last_30d``, the row itself included.

    Rows without a customer are one customer. A NULL amount is not averaged; a
    NaN or infinite one affects the rows whose period holds it.
    """
    micros = micros_of(df, contract.time)
    amount = F.col(contract.amount).cast("double")
    finite = ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    odd = (
        F.when(F.isnan(amount), _NAN)
        .when(amount == float("inf"), _HIGH)
        .when(amount == float("-inf"), _LOW)
        .otherwise(0)
    )
    instants = stored(
        df.groupBy(F.col(customer).alias("_customer"), micros.alias("_at")).agg(
            F.count(F.lit(1)).alias("n"),
            F.count(amount).alias("amounts"),
            F.coalesce(F.sum(F.when(finite, amount)), F.lit(0.0)).alias("total"),
            F.bit_or(odd).alias("odd"),
        ),
        "instants",
    )
    figures = _look_back(instants).select(
        "_customer", "_at", F.col("n").cast("int").alias("transactions_last_24h"), _average().alias("avg_amount_last_30d")
    )
    # The instant is a column, as a sort would work an expression out at every comparison; it comes first, as it tells most rows apart.
    same = F.col("_micros").eqNullSafe(F.col("_at")) & F.col(customer).eqNullSafe(F.col("_customer"))
    return df.withColumn("_micros", micros).join(figures, same, "left").drop("_micros", "_customer", "_at")


def _average() -> Column:
    nans, highs, lows = [F.col("odd").bitwiseAND(bit) > 0 for bit in (_NAN, _HIGH, _LOW)]
    return (
        F.when(F.col("amounts") == 0, F.lit(None).cast("double"))
        .when(nans | (highs & lows), float("nan"))
        .when(highs, float("inf"))
        .when(lows, float("-inf"))
        .otherwise(F.col("total") / F.col("amounts"))
    )


def _summed(name: str) -> Column:
    return F.bit_or(name) if name == "odd" else F.sum(name)


def _look_back(instants: DataFrame) -> DataFrame:
    """Per customer and instant, both ends included: ``n`` of the shorter period, the other sums of the longer one.

    Both periods go through the same rows, as each has columns of its own.
    """
    by_hour = ["_customer", "_hour"]
    length = {c: ACTIVITY_HOURS if c == "n" else AVERAGE_DAYS * 24 for c in _SUMS}
    hour = F.expr(f"(_at - pmod(_at, {_HOUR}L)) div {_HOUR}L")
    points = instants.withColumn("_hour", hour)
    zeros = {c: F.lit(0).cast(points.schema[c].dataType) for c in _SUMS}
    # A marker stands where a period begins, in the hour that is cut there; before the first hour nothing is cut.
    first = points.agg(F.min("_hour")).first()[0]
    begins = points.select("_customer", "_hour", "_at", F.explode(F.array(*[F.lit(h) for h in sorted(set(length.values()))])).alias("_begin"))
    begins = begins.select(
        "_customer",
        (F.col("_hour") - F.col("_begin")).alias("_hour"),
        (F.col("_at") - F.col("_begin") * F.lit(_HOUR)).alias("_place"),
        "_at",
        "_begin",
        *[zeros[c].alias(c) for c in _SUMS],
    ).filter(F.coalesce(F.col("_hour") >= F.lit(first), F.lit(True)))
    # Whole hours between the two cut ones, one row for each hour that has any instant; it comes before the hour's instants.
    whole = points.groupBy(*by_hour).agg(*[_summed(c).alias(c) for c in _SUMS])
    earlier = Window.partitionBy("_customer").orderBy("_hour")
    whole = whole.select(
        *by_hour,
        F.coalesce(F.col("_hour") * F.lit(_HOUR) - 1, F.lit(0)).alias("_place"),
        F.lit(None).cast("long").alias("_at"),
        F.lit(-1).alias("_begin"),
        *[F.coalesce(_summed(c).over(earlier.rangeBetween(-(length[c] - 1), -1)), zeros[c]).alias(c) for c in _SUMS],
    )
    marks = points.select(*by_hour, F.col("_at").alias("_place"), "_at", F.lit(0).alias("_begin"), *_SUMS).unionByName(begins).unionByName(whole)
    inside = Window.partitionBy(*by_hour)
    upto = inside.orderBy("_place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    since = inside.orderBy(F.col("_place").desc()).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.col("_begin")
    cut = marks.select(
        "_customer",
        "_at",
        "_begin",
        *[F.when(begin == 0, _summed(c).over(upto)).when(begin == length[c], _summed(c).over(since)).otherwise(zeros[c]).alias(c) for c in _SUMS],
    )
    # The markers and the point of an instant meet; a marker with nothing after it in its hour adds nothing.
    adds = (begin == 0) | ((begin > 0) & ((F.col("n") > 0) | (F.col("amounts") > 0)))
    return cut.filter(adds).groupBy("_customer", "_at").agg(*[_summed(c).alias(c) for c in _SUMS])
