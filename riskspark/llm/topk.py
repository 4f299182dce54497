"""Exact top-k by inner product: columnar branch and bound.

Vectors become whole numbers and are kept vertically, one row per dimension.
For a query, scores of all candidates of a task are accumulated a block of
dimensions at a time; after each block, candidates whose score cannot reach the
k-th best any more are dropped and the survivors compacted. What the remaining
dimensions can add is bounded by the product of the remaining norms. Queries
meet all candidates in blocks of a bounded number of queries.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.vectors import matrix, top_rows, usable, widest
from riskspark.sources.scratch import stored


@dataclass(frozen=True)
class TopK:
    """``every``: rows whose id it divides are queries. ``block``: dimensions at a time.

    ``queries``: most queries sent to the executors at once. ``rows``: most
    candidates searched together in a task. ``scale`` turns a component into a
    whole number, floor(scale * x).
    """

    k: int = 5
    every: int = 50
    scale: int = 256
    block: int = 16
    queries: int = 4096
    rows: int = 65_536


#: Scores below this are summed in 64-bit integers, larger ones in integers of any length.
_LONG = float(1 << 62)


def _scaled(column: pa.Array, width: int, scale: int) -> np.ndarray:
    """Whole numbers as doubles. A power of two as ``scale`` keeps every digit; past the largest double it stays there."""
    most = np.finfo(np.float64).max
    return np.floor(np.clip(matrix(column, width), -most / scale, most / scale) * scale)


def _longs(whole: np.ndarray) -> np.ndarray:
    """The same in 64 bits; what does not fit makes a norm that keeps the row out of the 64-bit sums."""
    return np.clip(whole, -_LONG, _LONG).astype(np.int64)


def _suffix_norms(vertical: np.ndarray, block: int) -> np.ndarray:
    """Norm of what is left from each block on, rounded up; one row per block and one of zeros."""
    squares = vertical.astype(np.float64) ** 2
    starts = range(0, len(vertical), block)
    left = [np.sqrt(squares[at:].sum(axis=0)) * (1 + 1e-9) for at in starts]
    return np.array([*left, np.zeros(vertical.shape[1])])


def _search(ids: np.ndarray, columns: np.ndarray, norms: np.ndarray, query_id: int, query: np.ndarray, rule: TopK, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Best k candidates of a task for one query, of ``some`` if given: ids and scores."""
    keep = np.flatnonzero(ids != query_id if some is None else some & (ids != query_id))
    partial = np.zeros(len(keep), dtype=np.int64)
    rest = _suffix_norms(query[:, None], rule.block)[:, 0]
    for n, at in enumerate(range(0, len(query), rule.block)):
        part = columns[at : at + rule.block]
        part = part if len(keep) == len(ids) else part[:, keep]
        partial = partial + query[at : at + rule.block] @ part
        if len(keep) > rule.k:
            slack = rest[n + 1] * norms[n + 1][keep]
            # Large sums lose digits as doubles.
            slack = slack + (np.abs(partial) + slack) * 1e-14
            # At least k candidates reach the k-th best of the lower bounds.
            floor = np.partition(partial - slack, len(keep) - rule.k)[len(keep) - rule.k]
            alive = partial + slack >= floor - 1
            if alive.mean() < 0.75:
                keep, partial = keep[alive], partial[alive]
    best = np.lexsort((ids[keep], -partial))[: rule.k]
    return ids[keep[best]], partial[best]


def _search_long(ids: np.ndarray, whole: np.ndarray, some: np.ndarray, query_id: int, query: np.ndarray, rule: TopK) -> tuple[np.ndarray, np.ndarray]:
    """The same for candidates ``some`` whose sums may leave 64 bits, in Python's integers."""
    wanted = [int(x) for x in query]
    scored = ((sum(a * int(b) for a, b in zip(wanted, whole[i])), int(ids[i])) for i in np.flatnonzero(some & (ids != query_id)))
    best = heapq.nsmallest(rule.k, ((-score, id) for score, id in scored))
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    return np.array([id for _, id in best], dtype=np.int64), np.array([min(max(-score, least), most) for score, _ in best], dtype=np.int64)


def _answers(ids: np.ndarray, whole: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, rule: TopK) -> list[tuple[np.ndarray, np.ndarray]]:
    """Best candidates of a task for every query."""
    columns = np.ascontiguousarray(_longs(whole).T)
    norms = _suffix_norms(columns, rule.block)
    longs = _longs(queries)
    reach = _suffix_norms(longs.T, rule.block)[0]
    found = []
    for query_id, query, long, norm in zip(query_ids, queries, longs, reach):
        large = norms[0] * norm >= _LONG
        if not large.any():
            found.append(_search(ids, columns, norms, int(query_id), long, rule))
            continue
        parts = [_search(ids, columns, norms, int(query_id), long, rule, ~large), _search_long(ids, whole, large, int(query_id), query, rule)]
        found.append(tuple(np.concatenate(part) for part in zip(*parts)))
    return found


def search(rows: DataFrame, rule: TopK = TopK(), *, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` (long) of the ``k`` highest scores of each query.

    Candidates are all rows but those with the query's id; ties go to the
    smaller id. Vectors NULL or holding NULL, NaN or infinity take no part, nor
    do rows without an id. Vectors of unequal lengths meet on the components
    they share. Sums that may leave 64 bits are taken in integers of any length;
    a score that does leave them is given, and ranked, as the nearest long. A
    query with fewer candidates gets all of them. An empty table gives an empty one.
    Rows that repeat a candidate id are candidates of their own, rows that
    repeat a query id are one query, the smallest vector of them. Other columns
    are ignored.
    """
    good = stored(usable(rows, id, vector, nonzero=False), "vectors")
    width = widest(good)
    asked = good.filter(F.col("vec_id") % rule.every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    spark = rows.sparkSession
    blocks = max(1, -(-asked.count() // rule.queries))
    asked = stored(asked.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(2 * blocks)).cast("int")), "queries")
    found = []
    for b in range(2 * blocks if blocks > 1 else 1):
        # A block holds about half of ``queries``: the bound of what is sent at once.
        mine = asked if blocks == 1 else asked.filter(F.col("_block") == b)
        sent = mine.select("vec_id", "v").toArrow()
        if not sent.num_rows:
            continue
        held = spark.sparkContext.broadcast((np.asarray(sent.column(0)), _scaled(sent.column(1).combine_chunks(), width, rule.scale)))

        def each(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            query_ids, queries = held.value

            def answer(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
                ids = np.concatenate([np.asarray(p.column(0)) for p in parts])
                whole = np.concatenate([_scaled(p.column(1), width, rule.scale) for p in parts])
                got = _answers(ids, whole, query_ids, queries, rule)
                asked_by = np.repeat(query_ids, [len(g[0]) for g in got])
                return pa.RecordBatch.from_arrays(
                    [pa.array(asked_by), pa.array(np.concatenate([g[0] for g in got])), pa.array(np.concatenate([g[1] for g in got]))],
                    ["query_id", "vec_id", "score"],
                )

            waiting, held_rows = [], 0
            for batch in batches:
                waiting.append(batch)
                held_rows += batch.num_rows
                if held_rows >= rule.rows:
                    yield answer(waiting)
                    waiting, held_rows = [], 0
            if held_rows:
                yield answer(waiting)

        found.append(good.mapInArrow(each, "query_id long, vec_id long, score long"))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return top_rows(reduce(DataFrame.unionAll, found), rule.k)
