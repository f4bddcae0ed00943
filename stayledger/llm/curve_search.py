"""Approximate nearest neighbours along shifted space-filling curves.

Directions of vectors are projected, for each curve by a rotation and a shift of its own, to a
grid of ``DIMENSIONS`` axes and ordered along the grid's Hilbert curve. Each ordering is cut into
up to ``RANGES`` key ranges of about equal size. A query meets the vectors of its own range and of the
``NEIGHBOURS`` on each side, on every curve; what the curves have found is merged, scored exactly
and ranked. Equal vectors are searched once. Every vector is placed on every curve.

Rotations and shifts come from a fixed seed; range bounds are quantiles over all vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import store
from stayledger.llm.vectors import best, matrix, usable

TOP = 20
CURVES, DIMENSIONS, BITS, SEED = 14, 6, 5, 20
#: Key ranges of a curve at most, and those on each side of a query's own that it looks at.
RANGES, NEIGHBOURS = 24, 1
#: Vectors and queries that are compared with each other in one task.
CHUNK, QUERIES = 8192, 2048


def hilbert(grid: np.ndarray, bits: int) -> np.ndarray:
    """Place of each grid cell along the Hilbert curve (Skilling, 2004)."""
    x = grid.astype(np.int64)
    axes = x.shape[1]
    bit = 1 << bits - 1
    while bit > 1:
        low = bit - 1
        for i in range(axes):
            on = (x[:, i] & bit) != 0
            swap = np.where(on, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(on, low, swap)
            x[:, i] ^= swap
        bit >>= 1
    for i in range(1, axes):
        x[:, i] ^= x[:, i - 1]
    flip = np.zeros(len(x), np.int64)
    for b in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] >> b & 1, (1 << b) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | x[:, i] >> b & 1
    return key


def keys(vectors: np.ndarray) -> np.ndarray:
    """A row of curve keys for each vector."""
    width = vectors.shape[1]
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    rng, out = np.random.default_rng(SEED), []
    for _ in range(CURVES):
        axes = min(DIMENSIONS, width)
        rotation = np.linalg.qr(rng.standard_normal((width, axes)))[0]
        shift = rng.random(axes)
        # projections of directions have a deviation of 1 / sqrt(width)
        place = ((unit @ rotation) * np.sqrt(width) / 8 + 0.5) * 0.9 + shift * 0.1
        out.append(hilbert(np.clip(place * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64), BITS))
    return np.stack(out, axis=1)


def neighbours(vectors: DataFrame, every: int = 20, k: int = TOP, id: str = "vec_id",
               vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the
    ``k`` nearest others that were found, by inner product; ties go to the smaller id.

    Null, empty and zero vectors, those with null or non-finite components and rows without an
    id take no part; of rows that share an id the least vector counts; components that a shorter
    vector lacks are zero; other columns play no part; no queries or candidates give no rows.
    """
    rows = store(usable(vectors, id, vector).where(F.exists("v", lambda x: x != 0)).withColumn(
        "class", F.xxhash64("v")), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 1
    # of equal vectors the k + 1 smallest ids can be wanted; tasks keep no more before the shuffle
    order = Window.partitionBy("class").orderBy("vec_id")
    members = store(rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1), "members")
    asked = rows.where(F.col("vec_id") % every == 0).select("vec_id", "class")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            placed = keys(matrix(batch["v"], width, np.float64))
            yield pa.record_batch({"class": batch["class"], "first": batch["first"], "v": batch["v"], **{
                f"k{c}": pa.array(placed[:, c]) for c in range(CURVES)}})

    names = [f"k{c}" for c in range(CURVES)]
    placed = store(members.where("nth = 1").select("class", F.col("vec_id").alias("first"), "v").mapInArrow(
        place, "class long, first long, v array<double>, " + ", ".join(f"{c} long" for c in names)), "curves")
    n = placed.count()
    cut = max(1, min(RANGES, n // (4 * k + 4)))  # ranges hold a few times as many as are wanted
    bounds = placed.approxQuantile(names, [r / cut for r in range(1, cut)], 0.1 / cut) if cut > 1 else []
    cuts = np.array(bounds or np.zeros((CURVES, 0)))

    def ranges(*columns: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack([np.searchsorted(cuts[c], x, "right") for c, x in enumerate(columns)], axis=1)))

    dealt = placed.select("class", "first", "v", F.posexplode(
        F.pandas_udf(ranges, "array<int>")(*names)).alias("curve", "range"))
    queries = dealt.join(asked.select("class").distinct(), "class", "left_semi")
    row_chunks, query_chunks = (max(1, -(-n // size)) for size in (
        cut * CHUNK, cut * QUERIES * every // (2 * NEIGHBOURS + 1)))
    spread = F.xxhash64("class", F.lit(1))
    grid = dealt.select(
        "curve", "range", F.pmod(spread, F.lit(row_chunks)).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.lit(query_chunks - 1))).alias("j"), F.lit(False).alias("asks"), "class", "first", "v",
    ).unionByName(queries.select(
        "curve", F.explode(F.sequence(F.col("range") - NEIGHBOURS, F.col("range") + NEIGHBOURS)).alias("range"),
        F.pmod(spread, F.lit(query_chunks)).cast("int").alias("j"), "class", "first", "v").select(
        "curve", "range", F.explode(F.sequence(F.lit(0), F.lit(row_chunks - 1))).alias("i"), "j",
        F.lit(True).alias("asks"), "class", "first", "v"))

    def compare(group: pa.Table) -> pa.Table:
        asks = group["asks"].combine_chunks().to_numpy(zero_copy_only=False)
        name, first = (group[c].combine_chunks().to_numpy(zero_copy_only=False) for c in ("class", "first"))
        x = matrix(group["v"], width, np.float64)
        rows, row_names, firsts, queries_, query_names, found = x[~asks], name[~asks], first[~asks], x[asks], name[asks], []
        keep = min(k + 1, len(rows))
        for at in range(0, len(queries_) if keep else 0, 256):
            q = queries_[at:at + 256]
            near = q @ rows.T
            least = np.partition(-near, keep - 1, axis=1)[:, keep - 1:keep]
            # all that reach the last wanted score, or miss it by rounding only
            i, j = np.nonzero(-near <= least + 1e-9 * (1 + np.abs(least)))
            score = np.einsum("nd,nd->n", rows[j], q[i])
            order = np.lexsort((firsts[j], -score, i))
            i, j, score = i[order], j[order], score[order]
            place = np.arange(len(i)) - np.searchsorted(i, i)
            own = place < keep
            found.append((query_names[at + i[own]], row_names[j[own]], firsts[j[own]], score[own]))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 3 + [np.zeros(0)]
        kinds = (*[pa.int64()] * 3, pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], ["asker", "class", "first", "score"])

    pairs = grid.groupBy("curve", "range", "i", "j").applyInArrow(compare, "asker long, class long, first long, score double")
    # on each curve the best k + 1 classes, ties by their smallest id, then of all curves, then their
    # members: no member of another class can be among the k best
    merged = pairs.groupBy("asker", "class").agg(F.max("score").alias("score"), F.min("first").alias("first"))
    order = Window.partitionBy("asker").orderBy(F.desc("score"), "first")
    top = merged.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1).drop("nth", "first")
    hits = asked.withColumnRenamed("vec_id", "query_id").join(
        top.withColumnRenamed("class", "found"), F.col("class") == F.col("asker")).join(
        members.select(F.col("class").alias("found"), "vec_id"), "found").where("vec_id <> query_id")
    return best(hits.select("query_id", "vec_id", "score"), k)
