"""Ranks, running totals and quantiles over a total order, without one big task.

Spark's range partitioning samples the sort keys, so a key range that holds a
third of the rows still spreads over many chunks. Each chunk is summed on its
own, and only one row per chunk is summed across chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.contract import ContractError
from riskspark.functions import instant, micros_of
from riskspark.sources.scratch import stored

# monotonically_increasing_id() keeps the partition above bit 33, the row below.
_ROW_BITS = 33


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality of the key columns of two aliased frames."""
    return reduce(
        lambda a, b: a & b,
        [F.col(f"left.{key}").eqNullSafe(F.col(f"right.{key}")) for key in keys],
    )


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    values: Sequence[str],
    *,
    by: Sequence[str] = (),
    following: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<value>``, the inclusive running sum along ``order`` within ``by``,
    and ``total_<value>``, the sum of the whole group.

    ``following`` columns also get ``next_<column>``, their value in the next
    row of the order (NULL in the last). Ordering keys should be unique per
    ``by`` group; aggregate on them first.
    """
    by, order = list(by), list(order)
    keys = [*by, "_chunk"]
    ranged = df.repartitionByRange(*[F.col(c) for c in by], *order).withColumn(
        "_chunk", F.spark_partition_id()
    )
    # The chunk number must be the same in both uses below: write it down.
    table = stored(ranged, "ranged")

    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    inside = Window.partitionBy(*keys).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = table.withColumns(
        {f"cum_{v}": F.sum(v).over(so_far) for v in values}
        | {f"next_{c}": F.lead(c).over(inside) for c in following}
        | ({"_last": F.lead(F.lit(1)).over(inside).isNull()} if following else {})
    )
    heads = table if not following else table.withColumn("_place", place)
    chunks = heads.groupBy(*keys).agg(
        *[F.sum(v).alias(f"_total_{v}") for v in values],
        *[F.min_by(c, "_place").alias(f"_head_{c}") for c in following],
    )
    across = Window.partitionBy(*by).orderBy("_chunk")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        *keys,
        *[F.coalesce(F.sum(f"_total_{v}").over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(f"_total_{v}").over(Window.partitionBy(*by)).alias(f"total_{v}") for v in values],
        *[F.lead(f"_head_{c}").over(across).alias(f"_after_{c}") for c in following],
    )
    joined = local.alias("left").join(offsets.alias("right"), same_keys(local, offsets, keys))
    carried = [F.col(f"left.{c}").alias(c) for c in df.columns]
    sums = [(F.col(f"cum_{v}") + F.col(f"_before_{v}")).alias(f"cum_{v}") for v in values]
    nexts = [
        F.when(F.col("_last"), F.col(f"_after_{c}")).otherwise(F.col(f"next_{c}")).alias(f"next_{c}")
        for c in following
    ]
    return joined.select(*carried, *sums, *[f"total_{v}" for v in values], *nexts)


def global_rank(df: DataFrame, order: Sequence[str], *, name: str = "rank") -> DataFrame:
    """Add the exact 1-based rank of every row along ``order``.

    One range shuffle sorts the rows; the position inside a chunk comes from
    the row counter, the rest from the sizes of the earlier chunks.
    """
    ranged = (
        df.repartitionByRange(*[F.col(c) for c in order])
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    table = stored(ranged, "ranked").withColumn("_chunk", F.shiftright("_at", _ROW_BITS))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        table.groupBy("_chunk")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return table.join(offsets, "_chunk").select(
        *df.columns, (F.col("_before") + inside + 1).cast("long").alias(name)
    )


@dataclass(frozen=True)
class _Search:
    """Where one wanted position lies: a closed range of microseconds."""

    position: int
    low: int
    high: int
    before: int
    rows: int


def order_statistics(
    df: DataFrame,
    time: str,
    id: str,
    positions: Callable[[int], Sequence[int]],
    *,
    task_rows: int = 1_000_000,
    fanout: int = 4096,
) -> list[tuple[int, object]]:
    """Keys ``(time in microseconds, id)`` of the rows at 1-based positions of the order (time, id).

    ``positions`` gives the wanted positions from the number of rows.

    No row is shuffled to find them: each pass counts rows per time slice
    inside the slices that still hold a wanted position, until a slice is small
    enough to sort. A single instant with too many rows is ranked by id over
    the cluster. The driver only sees slice counts and the keys found.
    """
    keys = df.select(F.col(time), F.col(id), micros_of(df, time).alias("_micros"))

    def inside(search: _Search) -> Column:
        return F.col(time).between(instant(df, time, search.low), instant(df, time, search.high))

    def any_of(searches: Sequence[_Search]) -> Column:
        return reduce(lambda a, b: a | b, [inside(s) for s in searches])

    def tagged(searches: Sequence[_Search]) -> Column:
        tag = F.lit(None).cast("int")
        for number, search in reversed(list(enumerate(searches))):
            tag = F.when(inside(search), number).otherwise(tag)
        return tag

    def distinct_ranges(searches: Sequence[_Search]) -> list[_Search]:
        return list({(s.low, s.high): s for s in searches}.values())

    first = keys.agg(F.count(F.lit(1)), F.count("_micros"), F.min("_micros"), F.max("_micros")).first()
    total, rows, low, high = first
    wanted_positions = list(positions(total))
    if any(not 1 <= p <= rows for p in wanted_positions):
        raise ContractError("a position lies outside the rows that have a time")
    searches = [_Search(p, low, high, 0, rows) for p in wanted_positions]

    while wide := [s for s in searches if s.rows > task_rows and s.low < s.high]:
        ranges = distinct_ranges(wide)
        steps = [max(1, -(-(s.high - s.low + 1) // fanout)) for s in ranges]
        tag = tagged(ranges)
        slice_number = F.lit(None).cast("long")
        for number, (search, step) in enumerate(zip(ranges, steps, strict=True)):
            slice_number = F.when(
                F.col("_tag") == number, F.expr(f"(_micros - {search.low}L) div {step}L")
            ).otherwise(slice_number)
        counts = (
            keys.filter(any_of(ranges))
            .withColumn("_tag", tag)
            .groupBy("_tag", slice_number.alias("_slice"))
            .count()
            .collect()
        )
        narrowed = {}
        for search in wide:
            number = next(i for i, r in enumerate(ranges) if (r.low, r.high) == (search.low, search.high))
            before = search.before
            for part, size in sorted((c["_slice"], c["count"]) for c in counts if c["_tag"] == number):
                if before + size >= search.position:
                    start = search.low + part * steps[number]
                    end = min(search.high, start + steps[number] - 1)
                    narrowed[search] = replace(search, low=start, high=end, before=before, rows=size)
                    break
                before += size
        searches = [narrowed.get(s, s) for s in searches]

    found: dict[int, tuple[int, object]] = {}
    small = [s for s in searches if s.rows <= task_rows]
    if small:
        ranges = distinct_ranges(small)
        numbers = {(r.low, r.high): i for i, r in enumerate(ranges)}
        wanted = [f"{numbers[s.low, s.high]}:{s.position - s.before}" for s in small]
        place = F.row_number().over(Window.partitionBy("_tag").orderBy(time, id))
        picked = (
            keys.filter(any_of(ranges))
            .withColumn("_tag", tagged(ranges))
            .withColumn("_place", F.concat_ws(":", "_tag", place))
            .filter(F.col("_place").isin(wanted))
            .select("_place", "_micros", F.col(id))
        )
        at = {row[0]: (row[1], row[2]) for row in picked.collect()}
        found |= {s.position: at[w] for s, w in zip(small, wanted, strict=True)}
    for search in (s for s in searches if s.rows > task_rows):
        ranked = global_rank(keys.filter(F.col(time) == instant(df, time, search.low)).select(id), [id])
        row = ranked.filter(F.col("rank") == search.position - search.before).select(id).first()
        found[search.position] = (search.low, row[0])
    return [found[p] for p in wanted_positions]


def at_or_before(df: DataFrame, time: str, id: str, key: tuple[int, object]) -> Column:
    """Whether a row is not after ``key`` in the order (time, id); NULL without a time.

    Plain comparisons with literals, so that a filter on it reaches the file scan.
    """
    cut = instant(df, time, key[0])
    last = F.lit(key[1]).cast(df.schema[id].dataType)
    return (F.col(time) < cut) | ((F.col(time) == cut) & (F.col(id) <= last))


def after(df: DataFrame, time: str, id: str, key: tuple[int, object]) -> Column:
    """Whether a row is after ``key``; the counterpart of ``at_or_before``."""
    cut = instant(df, time, key[0])
    last = F.lit(key[1]).cast(df.schema[id].dataType)
    return (F.col(time) > cut) | ((F.col(time) == cut) & (F.col(id) > last))


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *, by: Sequence[str] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows ``(by..., feature, quantiles)``.

    Rows are reduced to counts per distinct value, which are summed along their
    order over the cluster; the result does not depend on the number of rows.
    """
    return quantiles_of_counts(value_counts(df, columns, by=by), probabilities, by=by)


def value_counts(df: DataFrame, columns: Sequence[str], *, by: Sequence[str] = ()) -> DataFrame:
    """Rows ``(by..., feature, value, n)``: how often each value of the columns is there; NULL is not counted."""
    by, columns = list(by), list(columns)
    return (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(by, columns, "feature", "value")
        .filter(F.col("value").isNotNull())
        .groupBy(*by, "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quantiles_of_counts(counts: DataFrame, probabilities: Sequence[float], *, by: Sequence[str] = ()) -> DataFrame:
    """``quantiles`` from the rows of ``value_counts``."""
    keys = [*by, "feature"]
    ordered = running_totals(counts, [F.col("value")], ["n"], by=keys)

    def holds(place: Column) -> Column:
        return (F.col("cum_n") - F.col("n") <= place) & (place < F.col("cum_n"))

    picks, results = [], []
    for number, probability in enumerate(probabilities):
        exact = F.lit(float(probability)) * (F.col("total_n") - 1)
        picks += [
            F.max(F.when(holds(F.floor(exact)), F.col("value"))).alias(f"_low{number}"),
            F.max(F.when(holds(F.ceil(exact)), F.col("value"))).alias(f"_high{number}"),
        ]
        low, high = F.col(f"_low{number}"), F.col(f"_high{number}")
        results.append(low + (high - low) * (exact - F.floor(exact)))
    return (
        ordered.groupBy(*keys)
        .agg(F.max("total_n").alias("total_n"), *picks)
        .select(*keys, F.array(*results).alias("quantiles"))
    )


def quantile_values(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]
) -> dict[str, list[float]]:
    """The quantiles of each column as plain numbers (columns x probabilities of them)."""
    rows = quantiles(df, columns, probabilities).collect()
    return {row["feature"]: row["quantiles"] for row in rows}
