"""Histogram sort: shards of nearly equal bytes over a total order of the rows.

Rows are ordered by (hash of the text, id), so equal texts stand together.
Exact bytes and rows are counted below candidate boundaries, the boundaries
around each wanted splitter are refined from those counts, and the rows move
once, to the partition that the final boundaries give them. Everything is a
DataFrame expression; a few thousand counts per pass come to the driver.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import row_in_partition
from riskspark.sources.scratch import stored

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1
#: First probes: equal steps of the hash, told apart by its top bits.
_TOP_BITS = 10
#: Probes put into a bucket that is refined.
_FAN = 64


@dataclass
class Bucket:
    """Rows from ``low`` up to the next bucket's: how many, their bytes, the range of their keys."""

    low: tuple[int, int]
    rows: int = 0
    bytes: int = 0
    hashes: tuple[int, int] = (0, 0)
    ids: tuple[int, int] = (0, 0)
    counted: bool = False

    def cuts(self) -> list[tuple[int, int]]:
        """Evenly spaced boundaries inside; none if all rows have one key."""
        (first, last), inner = (self.hashes, lambda x: (x, _LOW)) if self.hashes[0] < self.hashes[1] else (self.ids, lambda x: (self.hashes[0], x))
        steps = min(_FAN, last - first)
        return sorted({inner(first + (last - first) * i // steps) for i in range(1, steps + 1)}) if steps > 0 else []


def _place(lows: list[tuple[int, int]]) -> Column:
    """Index of the bucket of a row: by the hash's top bits, then by the boundaries that share them."""
    tops = 1 << _TOP_BITS
    extra: list[list[dict]] = [[] for _ in range(tops)]
    base, seen = [], 0
    for low in lows:
        top = (low[0] - _LOW) >> (64 - _TOP_BITS)
        if low == (_LOW + (top << (64 - _TOP_BITS)), _LOW):
            base.append(seen)
        else:
            extra[top].append({"h": low[0], "d": low[1]})
        seen += 1
    literal = lambda value, kind: F.from_json(F.lit(json.dumps(value)), kind)
    top = (F.shiftrightunsigned(F.col("_h").bitwiseXOR(F.lit(_LOW)), 64 - _TOP_BITS) + 1).cast("int")
    key = F.struct(F.col("_h").alias("h"), F.col("_d").alias("d"))
    within = F.element_at(literal(extra, "array<array<struct<h:bigint,d:bigint>>>"), top)
    return (F.element_at(literal(base, "array<int>"), top) + F.size(F.filter(within, lambda x: x <= key))).cast("int")


def _count(keys: DataFrame, buckets: list[Bucket]) -> None:
    """Fill in the counts of the buckets that have none, in one pass."""
    place = keys.withColumn("_b", _place([b.low for b in buckets]))
    todo = [i for i, b in enumerate(buckets) if not b.counted]
    if len(todo) < len(buckets):
        flags = F.from_json(F.lit(json.dumps([not b.counted for b in buckets])), "array<boolean>")
        place = place.filter(F.element_at(flags, F.col("_b") + 1))
    found = place.groupBy("_b").agg(F.count(F.lit(1)), F.sum("_size"), F.min("_h"), F.max("_h"), F.min("_d"), F.max("_d"))
    for i in todo:
        buckets[i].counted = True
    for i, rows, size, h0, h1, d0, d1 in found.collect():
        b = buckets[i]
        b.rows, b.bytes, b.hashes, b.ids = rows, size, (h0, h1), (d0, d1)


def histogram(keys: DataFrame, shards: int, tolerance: float, partitions: int) -> tuple[list[Bucket], list[int]]:
    """Buckets in key order and, for each shard but the first, the bucket that it begins with.

    A bucket is refined while a wanted boundary lies inside it further than
    ``tolerance`` of a shard from both ends, or while it holds more rows than a
    partition should.
    """
    buckets = [Bucket((_LOW + (i << (64 - _TOP_BITS)), _LOW)) for i in range(1 << _TOP_BITS)]
    while True:
        _count(keys, buckets)
        total, rows = sum(b.bytes for b in buckets), sum(b.rows for b in buckets)
        slack = tolerance * total / shards
        starts, at = [], 0
        for b in buckets:
            starts.append(at)
            at += b.bytes
        coarse = {i for i, b in enumerate(buckets) if b.rows > max(64, 2 * rows // partitions)}
        for k in range(1, shards):
            want = total * k / shards
            i = bisect_right(starts, want) - 1
            if min(want - starts[i], starts[i] + buckets[i].bytes - want) > slack:
                coarse.add(i)
        refined, changed = [], False
        for i, b in enumerate(buckets):
            refined.append(b)
            cuts = b.cuts() if i in coarse and b.rows > 1 else []
            if cuts := [c for c in cuts if c > b.low]:
                changed, b.counted, b.rows, b.bytes = True, False, 0, 0
                refined += [Bucket(c) for c in cuts]
        if not changed:
            break
        buckets = refined
    splits = []
    for k in range(1, shards):
        want = total * k / shards
        # Between boundaries that are near enough, one between two texts comes first.
        splits.append(min(range(len(buckets)), key=lambda i: (abs(starts[i] - want) > slack, buckets[i].low[1] != _LOW and abs(starts[i] - want) <= slack, abs(starts[i] - want))))
    return buckets, splits


def shard(docs: DataFrame, shards: int = 16, *, id: str = "doc_id", text: str = "text", tolerance: float = 0.005) -> DataFrame:
    """All rows and columns with ``_size``, ``_shard`` (0 to ``shards`` - 1) and ``_slot`` (gapless from 0).

    Law ``bytes``: sizes (UTF-8 bytes of the text, plus 1) of the shards differ
    from the mean by ``tolerance`` of a shard, or by one row where rows are
    larger. Equal texts are neighbours and share a shard unless a boundary falls
    into a group larger than the tolerance; such a group is cut by id. A NULL
    text is a text of no bytes, a NULL id sorts first; rows with the same text
    and id stay together. An empty table gives an empty one. The id must be a
    whole number; columns of ``docs`` named like the three are replaced.
    """
    ours = ("_h", "_d", "_size", "_shard", "_slot", "_pid")
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")
    rows = docs.select(
        *[c for c in docs.columns if c not in ours],
        F.xxhash64(text).alias("_h"),
        F.coalesce(F.col(id).cast("long"), F.lit(_LOW)).alias("_d"),
        size.alias("_size"),
    )
    keys = stored(rows.select("_h", "_d", "_size"), "shard-keys")
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * shards)
    buckets, splits = histogram(keys, shards, tolerance, partitions)
    # Neighbouring buckets of a shard share a partition up to a fair number of rows.
    most = max(1, sum(b.rows for b in buckets) // partitions)
    pid, owner, before, held, inside = [], [], [], 0, 0
    for i, b in enumerate(buckets):
        own = bisect_right(splits, i)
        if not owner or own != owner[-1] or (held and held + b.rows > most):
            inside = inside + held if owner and own == owner[-1] else 0
            owner.append(own)
            before.append(inside)
            held = 0
        held += b.rows
        pid.append(len(owner) - 1)
    pick = lambda values, at: F.element_at(F.from_json(F.lit(json.dumps(values)), "array<bigint>"), at + 1)
    moved = (
        rows.withColumn("_pid", pick(pid, _place([b.low for b in buckets])).cast("int"))
        .repartitionById(len(owner), F.col("_pid"))
        .sortWithinPartitions("_h", "_d")
    )
    return moved.withColumns({"_shard": pick(owner, F.col("_pid")).cast("int"), "_slot": pick(before, F.col("_pid")) + row_in_partition()}).drop("_h", "_d", "_pid")
