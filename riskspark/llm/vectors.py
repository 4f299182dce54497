"""Rows of vectors for the two searches: which take part, and as arrays inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usable(rows: DataFrame, id: str, vector: str, *, nonzero: bool) -> DataFrame:
    """``vec_id`` and ``v`` (doubles) of the rows whose vector is not NULL and all finite."""
    v = F.col(vector).cast("array<double>")
    good = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    if nonzero:
        good = good & F.exists("v", lambda x: x != 0)
    return rows.select(F.col(id).cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull()).filter(F.coalesce(good, F.lit(False)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows as a float64 matrix; a shorter vector is filled with zeros."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    ends = np.cumsum(lengths)
    for i, (n, end) in enumerate(zip(lengths.tolist(), ends.tolist())):
        out[i, :n] = flat[end - n : end]
    return out


def widest(rows: DataFrame) -> int:
    return int(rows.agg(F.max(F.size("v"))).first()[0] or 0)


def top_rows(found: DataFrame, k: int) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the k best of each query, ties to the smaller id.

    ``found`` has a bounded number of rows for each query and task.
    """
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
