"""Approximate nearest neighbours by cross-polytope hashing.

A table turns unit vectors by three rounds of random signs and a fast Hadamard
transform; a vector's bucket is the signed axis next to it, or the pair of axes
of two such turns. A query probes, in every table, the buckets of its next axes
in order of nearness. The candidates of all probed buckets are ranked by the
exact inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.vectors import matrix, top_rows, usable, widest
from riskspark.sources.scratch import stored


#: Vectors hashed at a time in a task.
_ROWS = 512


@dataclass(frozen=True)
class CrossPolytope:
    """``every``: rows whose id it divides are queries.

    ``tables`` hash tables of ``turns`` pseudo-rotations (1 or 2) each: of 64
    dimensions, 128 or 16,384 buckets. Two are for tables of many millions of
    rows, with more probes. ``probes`` buckets of each table are read, more
    while those hold fewer than ``least`` rows. ``rows`` and ``queries``: most candidates and
    queries that meet in a task at once; a larger bucket is split.
    """

    k: int = 20
    every: int = 20
    tables: int = 8
    turns: int = 1
    probes: int = 16
    least: int = 256
    rows: int = 4096
    queries: int = 1024
    seed: int = 11


def _signs(width: int, rule: CrossPolytope) -> np.ndarray:
    return np.random.default_rng(rule.seed).choice(np.array([-1.0, 1.0]), (rule.tables, rule.turns, 3, width))


def _turned(unit: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows after one table's pseudo-rotation."""
    for round_ in signs:
        unit = unit * round_
        step = 1
        while step < unit.shape[1]:
            pairs = unit.reshape(len(unit), -1, 2, step)
            unit = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(unit), -1)
            step *= 2
        unit = unit / np.sqrt(unit.shape[1])
    return unit


def _buckets(vectors: np.ndarray, signs: np.ndarray, table: int) -> np.ndarray:
    """Nearness of each row to each bucket of a table: a signed axis (j, then its opposite), or a pair of them."""
    width = signs.shape[3]
    padded = np.zeros((len(vectors), width))
    padded[:, : vectors.shape[1]] = vectors
    # Scaled by the largest component first, so that no square over- or underflows.
    padded /= np.abs(padded).max(axis=1, keepdims=True)
    padded /= np.linalg.norm(padded, axis=1, keepdims=True)
    axes = [np.concatenate([t, -t], axis=1) for t in (_turned(padded, s) for s in signs[table])]
    return axes[0] if len(axes) == 1 else (axes[0][:, :, None] + axes[1][:, None, :]).reshape(len(vectors), -1)


def search(rows: DataFrame, rule: CrossPolytope = CrossPolytope(), *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (double) of the ``k`` nearest found of each query.

    The score is the inner product of the original vectors in double precision.
    Every row is in every table; candidates are all rows but those with the
    query's id; ties go to the smaller id. Vectors NULL, zero or holding NULL,
    NaN or infinity take no part, nor do rows without an id. Vectors of unequal
    lengths are filled with zeros. Probing goes on until a table's buckets hold
    ``least`` rows, or all: a small table is searched whole. An empty table
    gives an empty one. Rows that repeat a candidate id are candidates of their
    own, rows that repeat a query id are one query, the smallest vector of them.
    Other columns are ignored.
    """
    # Written with a number each, by which a row found in several tables counts once.
    good = stored(usable(rows, id, vector, nonzero=True).withColumn("row", F.monotonically_increasing_id()), "vectors")
    dimensions = widest(good)
    width = 1 << max(0, (dimensions - 1).bit_length())
    signs = _signs(width, rule)
    if not dimensions:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = matrix(batch.column(1), dimensions)
            for t in range(rule.tables):
                at = range(0, len(vectors), _ROWS)
                nearest = np.concatenate([np.zeros(0, np.int64), *[_buckets(vectors[i : i + _ROWS], signs, t).argmax(axis=1) for i in at]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nearest), t, np.int32)), pa.array(nearest), *batch.columns], ["table", "bucket", "vec_id", "v", "row"])

    index = good.mapInArrow(place, "table int, bucket int, vec_id long, v array<double>, row long")
    # A bucket's size: one number for each bucket of a table comes to the driver.
    counts = index.groupBy("table", "bucket").count().collect()
    sizes = np.zeros((rule.tables, (2 * width) ** rule.turns), dtype=np.int64)
    for t, b, n in counts:
        sizes[t, b] = n
    splits = np.maximum(1, -(-sizes // rule.rows))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (batch.slice(i, _ROWS) for batch in batches for i in range(0, batch.num_rows, _ROWS))
        for batch in parts:
            vectors = matrix(batch.column(1), dimensions)
            for t in range(rule.tables):
                order = np.argsort(-_buckets(vectors, signs, t), axis=1, kind="stable")
                held = np.cumsum(sizes[t][order], axis=1)
                wanted = np.maximum(rule.probes, (held < min(rule.least, held[0, -1])).sum(axis=1) + 1)
                wanted = np.minimum(wanted, order.shape[1])
                at = np.repeat(np.arange(len(order)), wanted)
                rank = np.arange(len(at)) - np.repeat(np.cumsum(wanted) - wanted, wanted)
                bucket = order[at, rank].astype(np.int32)
                some = sizes[t][bucket] > 0
                at, bucket = at[some], bucket[some]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), t, np.int32)), pa.array(bucket), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], ["table", "bucket", "vec_id", "v"]
                )

    asking = good.filter(F.col("vec_id") % rule.every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    probes = asking.mapInArrow(probe, "table int, bucket int, vec_id long, v array<double>")
    probes = stored(probes, "probes")
    asked = np.zeros_like(sizes)
    for t, b, n in probes.groupBy("table", "bucket").count().collect():
        asked[t, b] = n
    askers = np.maximum(1, -(-asked // rule.queries))
    # Unit (i, j) of a bucket: its i-th part of the candidates meets its j-th part of the queries.
    parts = lambda counts: F.element_at(F.from_json(F.lit(str(counts.ravel().tolist())), "array<int>"), F.col("table") * sizes.shape[1] + F.col("bucket") + 1)
    own = lambda n, key: F.pmod(F.xxhash64(key), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    as_rows = index.select("table", "bucket", own(parts(splits), "row").alias("i"), every(parts(askers)).alias("j"), "vec_id", "v", "row")
    as_queries = probes.select("table", "bucket", every(parts(splits)).alias("i"), own(parts(askers), "vec_id").alias("j"), "vec_id", "v")
    keys = ["table", "bucket", "i", "j"]

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, query_ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        if not len(ids) or not len(query_ids):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "row": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        a = matrix(left.column("v").combine_chunks(), dimensions)
        b = matrix(right.column("v").combine_chunks(), dimensions)
        scores = np.zeros((len(b), len(a)))
        for d in range(dimensions):  # one order of summation, so that a pair scores the same in every task
            scores += b[:, d : d + 1] * a[None, :, d]
        scores[query_ids[:, None] == ids[None, :]] = -np.inf
        order = np.argsort(ids, kind="stable")
        scores, ids, numbers = scores[:, order], ids[order], left.column("row").to_numpy()[order]
        best = np.argsort(-scores, axis=1, kind="stable")[:, : rule.k]
        got = np.take_along_axis(scores, best, axis=1)
        some = got > -np.inf
        return pa.table({"query_id": np.repeat(query_ids, some.sum(axis=1)), "vec_id": ids[best][some], "row": numbers[best][some], "score": got[some]})

    met = as_rows.groupBy(*keys).cogroup(as_queries.groupBy(*keys)).applyInArrow(rank, "query_id long, vec_id long, row long, score double")
    return top_rows(met.groupBy("query_id", "vec_id", "row").agg(F.max("score").alias("score")), rule.k)
