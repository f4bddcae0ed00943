"""Exact top-k search by branch and bound over columns.

Vectors lie in chunks, one column of values per dimension. A query's inner products with a chunk
grow by a block of dimensions at a time. What the other dimensions can still add or take is at
most the product of the norms of the rests (Cauchy-Schwarz); candidates that cannot reach the
k-th best lower bound any more are dropped and the survivors' columns compacted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import store
from stayledger.llm.vectors import best, matrix, usable

TOP, SCALE = 10, 1024
#: Dimensions of a block, vectors of a chunk, queries of a block.
BLOCK, CHUNK, QUERIES = 8, 2048, 512


def _rests(rows: np.ndarray) -> np.ndarray:
    """Norms of what is left from each block of dimensions on; ``rows`` has one per dimension."""
    mass = [(rows[a:a + BLOCK].astype(np.float64) ** 2).sum(axis=0) for a in range(0, len(rows), BLOCK)]
    return np.sqrt(np.cumsum(mass[::-1], axis=0)[::-1])


def bounded_search(columns: np.ndarray, rest: np.ndarray, query: np.ndarray, k: int,
                   own: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Positions and exact scores of the vectors of a chunk that can be among the ``k`` best of
    ``query``. ``columns`` has a row per dimension, ``rest`` its norms, ``own`` is left out."""
    n, left = columns.shape[1], _rests(query)
    alive = np.arange(n) if own is None else np.delete(np.arange(n), own)
    score = np.zeros(len(alive), np.int64)
    for b, at in enumerate(range(0, len(columns), BLOCK)):
        block = columns[at:at + BLOCK]
        score = score + query[at:at + BLOCK] @ (block if len(alive) == n else block[:, alive])
        if b + 1 < len(rest) and len(alive) > k:
            # rounding of the norms is covered by the added one
            bound = rest[b + 1][alive] * left[b + 1] * (1 + 1e-9) + 1
            least = np.partition(score - bound, len(alive) - k)[len(alive) - k]
            keep = score + bound >= least
            alive, score = alive[keep], score[keep]
    return alive, score


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors in vertical layout: a row for each chunk."""
    for whole in batches:
        for at in range(0, whole.num_rows, CHUNK):
            batch = whole.slice(at, CHUNK)
            width = int(np.max(batch["v"].value_lengths().to_numpy(zero_copy_only=False)))
            columns = matrix(batch["v"], width, np.int64).T
            yield pa.record_batch({
                "ids": pa.array([batch["vec_id"].to_numpy(zero_copy_only=False).astype("<i8").tobytes()], pa.binary()),
                "width": pa.array([width], pa.int32()),
                "columns": pa.array([np.ascontiguousarray(columns, "<i8").tobytes()], pa.binary())})


def exact_top_k(vectors: DataFrame, every: int = 100, k: int = TOP, id: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` the
    ``k`` others of the highest integer inner products of components floor(1024 x), all if there
    are fewer; ties go to the smaller id.

    Null or empty vectors, those with null or non-finite components and rows without an id take
    no part; of rows that share an id the least vector counts; components that a shorter vector
    lacks are zero; other columns play no part; without queries or candidates there are no rows.
    Scores must fit a long.
    """
    quantised = store(usable(vectors, id, vector).select(
        "vec_id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v")), "quantised")
    queries = quantised.where(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERIES))
    grouped = queries.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("vec_id", "v")).alias("queries"))
    chunks = store(quantised.mapInArrow(_chunks, "ids binary, width int, columns binary"), "chunks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in (whole.slice(i, 1).to_pylist()[0] for i in range(whole.num_rows)):
                ids, width = np.frombuffer(row["ids"], "<i8"), row["width"]
                columns = np.frombuffer(row["columns"], "<i8").reshape(width, -1)
                rest, place = _rests(columns), {x: i for i, x in enumerate(ids.tolist())}
                found = []
                for q in row["queries"]:
                    query = np.zeros(width, np.int64)
                    query[:len(q["v"])] = q["v"][:width]
                    alive, score = bounded_search(columns, rest, query, k, place.get(q["vec_id"]))
                    order = np.lexsort((ids[alive], -score))[:k]
                    found.append((np.full(len(order), q["vec_id"]), ids[alive[order]], score[order]))
                yield pa.record_batch(dict(zip(("query_id", "vec_id", "score"), (
                    pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found)))))

    # every chunk meets every block of queries; Spark broadcasts the blocks while they are small
    pairs = chunks.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(
        grouped, "block").select("ids", "width", "columns", "queries").mapInArrow(
        run, "query_id long, vec_id long, score long")
    return best(pairs, k)
