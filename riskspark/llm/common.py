"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.sources.scratch import stored

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

# monotonically_increasing_id() keeps the partition above bit 33, the row below.
_ROW_BITS = 33
# Least and greatest size of the bit map in ``split_by_ids``: 8 KB to 4 MB are sent to the tasks.
_BITS = (1 << 16, 1 << 25)
_BATCH = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def row_in_partition() -> Column:
    """Place of a row in its partition, from 0, in the partition's order."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a NULL id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts, F.lit(0)).cast("int")


def hash_share(*keys: Column) -> Column:
    """A number in [0, 1) that depends on the keys alone."""
    return F.pmod(F.xxhash64(*keys), F.lit(1_000_003)) / F.lit(1_000_003.0)


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python at most 4 MB at a time; a setting of the session, which a smaller one stays.

    The default lets a batch have 10,000 texts, in the executor's memory and in
    the worker's.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name)) > _BATCH:
        spark.conf.set(name, str(_BATCH))


def give_back() -> None:
    """Return a worker's freed memory to the system; called at the end of a task, as the worker stays."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def split_by_ids(rows: DataFrame, key: str, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows whose key surely is not in ``ids``, the others), told apart without moving a row.

    ``ids`` has one column. A bit map of the hashed ids is sent to the tasks, with
    16 places or more an id: at most a sixteenth of the other rows are in the
    second part, which a join then decides. Beyond 2 million ids the map stays
    at 4 MB and that share grows. A NULL key is in no set of ids.
    """
    size = min(max(_BITS[0], 1 << (16 * ids.count()).bit_length()), _BITS[1])
    place = lambda column: F.pmod(F.xxhash64(column.cast("long")), F.lit(size)).cast("int")
    places = ids.select(place(F.col(ids.columns[0])).alias("place")).distinct().toArrow().column(0)
    bits = np.zeros(size, dtype=bool)
    bits[places.to_numpy()] = True
    held = rows.sparkSession.sparkContext.broadcast(np.packbits(bits))

    @F.arrow_udf("boolean")
    def listed(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bits = np.unpackbits(held.value).astype(bool)
        for part in parts:
            yield pa.array(bits[part.to_numpy(zero_copy_only=False)])

    maybe = F.col(key).isNotNull() & listed(place(F.col(key)))
    return rows.filter(~maybe), rows.filter(maybe)


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str, *, total: str | None = None) -> DataFrame:
    """Add the 0-based place of each row within its ``by`` group along ``order``, and the group's rows as ``total``.

    One range exchange on (by, order), so a group that holds a third of all rows
    spreads over many partitions. Only one row per group and partition is
    summed across partitions. NULL is a group like any other. ``order`` should
    leave ties only between rows that may change places.
    """
    keys = [F.col(c).asc_nulls_last() for c in by]
    at, chunk, first, before = (fresh(df, c) for c in ("_at", "_chunk", "_first", "_before"))
    ranged = (
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(at, F.monotonically_increasing_id())
    )
    # Written, so that the partition number below is the same for every reader.
    rows = stored(ranged, "ranked").withColumn(chunk, F.shiftright(at, _ROW_BITS))
    rows = rows.withColumn(at, F.col(at).bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    parts = rows.groupBy(*by, chunk).agg(F.min(at).alias(first), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(*by).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
        F.col(chunk).alias("_part"),
        first,
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias(before),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("_whole"),
    )
    same = F.col(chunk) == F.col("_part")
    for i, c in enumerate(by):
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{i}"))
    place = (F.col(before) + F.col(at) - F.col(first)).cast("long").alias(name)
    return rows.join(parts, same).select(*df.columns, place, *([F.col("_whole").alias(total)] if total else []))
