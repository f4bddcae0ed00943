"""Packing of token sequences: shortest pack first over the histogram of lengths.

Documents are tokenised and cut into pieces of at most ``size`` ids. Only the histogram of piece
lengths, at most ``size`` rows, comes to the driver. There lengths are placed longest first, all
pieces of a length at once: as many as possible go to the packs with most room, which splits
packing patterns with their counts. Pieces find their place by their rank within their length.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import pieces, store, texts

SIZE, END = 4096, 2

_CUT = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary, "
        "part int, nth long")


def cut(docs: DataFrame, size: int = SIZE, end: int = END, tokenizer: str = "word_bpe_49k.json",
        folder: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of the tokenised documents; ``ids`` are little-endian unsigned 16-bit integers.
    ``nth`` counts pieces of one length within the task ``part`` that has cut them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from stayledger.llm.tokens import encoder

        encode, part = encoder(tokenizer, folder).encode, TaskContext.get().partitionId()
        counts, stop = defaultdict(int), np.array([end], "<u2").tobytes()
        for whole in batches:
            for batch in pieces(whole):
                rows = []
                coded = encode([x.decode() for x in batch["text"].to_pylist()])
                for doc, ids in zip(batch["doc_id"].to_pylist(), coded):
                    ids += stop
                    n = len(ids) // 2
                    for at in range(0, n, size):
                        piece = ids[2 * at:2 * (at + size)]
                        length = len(piece) // 2
                        crc = zlib.crc32(np.frombuffer(piece, "<u2").astype("<u4"))
                        rows.append((doc, at, length, crc, n, piece, part, counts[length]))
                        counts[length] += 1
                if rows:
                    kinds = (*[pa.int64()] * 5, pa.binary(), pa.int32(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                        ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "part", "nth"])

    return texts(docs, id, text, without_id=True).mapInArrow(run, _CUT)


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, tuple[int, ...]]]:
    """(count, lengths) of the packs that hold ``histogram[length]`` pieces of each length."""
    packs: dict[int, list[tuple[int, tuple[int, ...]]]] = defaultdict(list)
    rooms: list[int] = []  # heap of -room, may name emptied ones

    def put(room: int, count: int, lengths: tuple[int, ...]) -> None:
        if not packs[room]:
            heapq.heappush(rooms, -room)
        packs[room].append((count, lengths))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and not packs[-rooms[0]]:
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room < length:
                fit = size // length
                if left >= fit:
                    put(size - fit * length, left // fit, (length,) * fit)
                if left % fit:
                    put(size - left % fit * length, 1, (length,) * (left % fit))
                break
            count, lengths = packs[room].pop()
            used = min(count, left)
            if used < count:
                packs[room].append((count - used, lengths))
            put(room - length, used, (*lengths, length))
            left -= used
    return [x for room in sorted(packs) for x in packs[room]]


def slots(packs: list[tuple[int, tuple[int, ...]]]) -> tuple[np.ndarray, ...]:
    """For ranks from ``rank`` on of each ``length``: first sequence and offset in it.
    Sorted by length and rank; one row for each slot of a pattern."""
    rows, at, sequence = [], defaultdict(int), 0
    for count, lengths in packs:
        offset = 0
        for length in lengths:
            rows.append((length, at[length], sequence, offset))
            at[length] += count
            offset += length
        sequence += count
    table = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return tuple(table.T)


def pack(docs: DataFrame, size: int = SIZE, end: int = END, tokenizer: str = "word_bpe_49k.json",
         folder: str | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces with their places: (doc_id, start, length, ids_crc32, doc_tokens, ids, sequence_id,
    offset). ``start`` counts the document's ids before the piece, ``offset`` the sequence's.

    Null and empty texts are documents of the id ``end`` alone; a null id is an id like any other;
    repeated rows are packed as often; other columns play no part; no rows give no pieces.
    """
    if not 0 < size <= 1 << 20:
        raise ValueError("size: 1 to 1048576")
    spark = docs.sparkSession
    cuts = store(cut(docs, size, end, tokenizer, folder, id, text), "pieces")
    counts = store(cuts.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(patterns(histogram, size)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        lengths, firsts, sequences, offsets = table.value
        low, high = (np.searchsorted(lengths, length, side) for side in ("left", "right"))
        rank = rank.to_numpy()
        while (open_ := high - low > 1).any():  # last slot of the length from ``rank`` or before
            mid = (low + high) // 2
            right = open_ & (firsts[np.minimum(mid, len(firsts) - 1)] <= rank)
            low, high = np.where(right, mid, low), np.where(open_ & ~right, mid, high)
        return pd.DataFrame({"sequence_id": sequences[low] + rank - firsts[low], "offset": offsets[low]})

    placed = F.pandas_udf(place, "sequence_id long, offset long")("length", F.col("before") + F.col("nth"))
    return cuts.join(ranks, ["length", "part"]).withColumn("_place", placed).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids", "_place.sequence_id", "_place.offset")
