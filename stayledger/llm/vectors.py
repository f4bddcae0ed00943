"""What the two vector searches share: usable vectors, and top ranks of scored pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): one vector of doubles per id, the least of those that share it. Rows without
    an id, null or empty vectors and those with null or non-finite components are left out."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.select(F.col(id).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.coalesce((F.size("v") > 0) & fine, F.lit(False))).groupBy(
        "vec_id").agg(F.min("v").alias("v"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int, kind) -> np.ndarray:
    """Rows of lists as a matrix; lists shorter than ``width`` are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    if (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width), kind)
    out[np.arange(width) < size[:, None]] = flat
    return out


def best(pairs: DataFrame, k: int, *columns: str | Column) -> DataFrame:
    """The ``k`` best of (query_id, vec_id, score) for each query, with ``rank`` from 1; equal
    scores go by the smaller id. Spark keeps k rows a task and query before the shuffle."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score", *columns)
