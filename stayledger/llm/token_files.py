"""Token ids in files: frequency-ranked ids in byte-aligned codes with separate control bytes.

Ids are replaced by their rank among all documents, the most frequent first, so most need one
byte. A code has as many bytes as its rank needs, 1 to 4, little-endian; a control byte has the
lengths of four codes, less one, in two bits each, the first code in the lowest. The codes of a
document begin with a control byte of their own.

A folder holds two Parquet tables. ``blocks`` has rows (part, block, before, size, doc_ids,
counts, control, data): documents in ascending order of id by (part, block), their numbers of ids, their
control bytes and codes one after the other, and the number of ids of the part before
the block and in it. ``ranks`` has (rank, token).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayledger.llm.common import pieces, shared_folder, store, texts

END = 2
#: Ids in a block at least, but for the last one of a part.
BLOCK = 1 << 16
#: Bytes of text that a task encodes at once, about.
AT_ONCE = 1 << 24
#: Documents in a part, about.
PART_DOCS = 8192

#: Code lengths of each control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def pack_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control bytes and codes of documents with ``counts`` ranks each."""
    size = np.ones(len(ranks), np.uint8)
    for most in (0xFF, 0xFFFF, 0xFFFFFF):
        size += ranks > most
    full = (counts + 3) // 4 * 4
    before = np.cumsum(full - counts) - (full - counts)
    twos = np.zeros(int(full.sum()), np.uint8)
    twos[np.arange(len(ranks)) + np.repeat(before, counts)] = size - 1
    twos = twos.reshape(-1, 4)
    control = (twos[:, 0] | twos[:, 1] << 2 | twos[:, 2] << 4 | twos[:, 3] << 6).tobytes()
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]].tobytes()
    heads = [0, *(np.cumsum(full) // 4).tolist()]
    ends = [0, *np.concatenate(([0], np.cumsum(size, dtype=np.int64)))[np.cumsum(counts)].tolist()]
    return ([control[a:z] for a, z in zip(heads, heads[1:])], [data[a:z] for a, z in zip(ends, ends[1:])])


def unpack_ranks(counts: np.ndarray, control: bytes, data: bytes) -> np.ndarray:
    """Ranks of all documents of a block, by table lookup of the control bytes."""
    real = (counts + 3) // 4 * 4  # codes with those that fill up the last control byte
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)
    ends = np.cumsum(real)
    keep = np.ones(len(size), bool)
    for k in range(1, 4):
        at = ends[real - counts >= k] - k
        keep[at] = False
    size = size[keep]
    starts = np.cumsum(size) - size
    padded = np.frombuffer(data + b"\0\0\0", np.uint8).astype(np.uint32)
    out = padded[starts]
    for k in range(1, int(size.max(initial=1))):
        out |= np.where(size > k, padded[starts + np.minimum(k, size)] << np.uint32(8 * k), np.uint32(0))
    return out


def tokenized(docs: DataFrame, end: int, tokenizer: str, folder: str | None, id: str, text: str) -> DataFrame:
    """(doc_id, ids) with ids as little-endian unsigned 16-bit integers, ``end`` the last one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from stayledger.llm.tokens import encoder

        encode, stop = encoder(tokenizer, folder).encode_array, np.array([end], "<u2").tobytes()

        def coded(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, at = encode(pa.concat_arrays([x["text"].cast(pa.large_string()) for x in held])), 0
            for x in held:
                yield pa.record_batch({"doc_id": x["doc_id"], "ids": pa.array(
                    [i + stop for i in ids[at:at + x.num_rows]], pa.binary())})
                at += x.num_rows

        held, size = [], 0
        for whole in batches:
            for batch in pieces(whole):
                held.append(batch)
                size += pc.sum(pc.binary_length(batch["text"])).as_py() or 0
                if size >= AT_ONCE:
                    yield from coded(held)
                    held, size = [], 0
        if held:
            yield from coded(held)

    return texts(docs, id, text).mapInArrow(run, "doc_id long, ids binary")


def ranked(tokens: DataFrame) -> DataFrame:
    """(rank, token) of all ids that occur, the most frequent first, then the smaller id.
    Each task sends one count for each id at most; the result is bounded by the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for part in pieces(batch):
                counts += np.bincount(np.frombuffer(b"".join(part["ids"].to_pylist()), "<u2"), minlength=1 << 16)
        at = np.nonzero(counts)[0]
        yield pa.record_batch({"token": pa.array(at.astype(np.int32)), "n": pa.array(counts[at])})

    counted = tokens.mapInArrow(run, "token int, n long").groupBy("token").agg(F.sum("n").alias("n"))
    order = Window.orderBy(F.desc("n"), "token")
    return counted.select((F.row_number().over(order) - 1).alias("rank"), "token")


def _parts(docs: DataFrame, id: str) -> list[int]:
    """Bounds of ranges of ids with about PART_DOCS documents each."""
    ids = docs.select(F.col(id).cast("long").alias("id"))
    parts = max(1, ids.count() // PART_DOCS)
    quantiles = [k / parts for k in range(1, parts)]
    if not quantiles:
        return []
    return sorted({int(x) for x in ids.approxQuantile("id", quantiles, min(0.01, 0.1 / parts))})


def write(docs: DataFrame, path: str, end: int = END, tokenizer: str = "byte_bpe_50k.json",
          folder: str | None = None, id: str = "doc_id", text: str = "text") -> None:
    """Tokenise whole texts and write them below ``path`` in ascending order of id.

    Null and empty texts are documents of the id ``end`` alone; rows without an id are left out;
    repeated rows and rows that share an id are written as often, one after the other; other
    columns play no part; no rows give files without blocks.
    """
    spark = docs.sparkSession
    bounds = _parts(docs, id)
    tokens = store(tokenized(docs, end, tokenizer, folder, id, text), "tokens")
    ranked(tokens).coalesce(1).write.parquet(f"{path}/ranks")
    ranks = np.zeros(1 << 16, np.uint32)
    for r in spark.read.parquet(f"{path}/ranks").toLocalIterator():  # at most the vocabulary
        ranks[r.token] = r.rank
    table, cuts = spark.sparkContext.broadcast(ranks), np.array(bounds, np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                coded = batch["ids"].to_pylist()
                counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 2
                control, data = pack_ranks(table.value[np.frombuffer(b"".join(coded), "<u2")], counts)
                docs_ = batch["doc_id"].to_numpy(zero_copy_only=False)
                yield pa.record_batch({
                    "part": pa.array(np.searchsorted(cuts, docs_, "right").astype(np.int32)),
                    "doc_id": batch["doc_id"],
                    "n": pa.array(counts), "control": pa.array(control, pa.binary()),
                    "data": pa.array(data, pa.binary())})

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before, held, size = None, 0, 0, [], 0

        def done() -> pa.RecordBatch:
            ids, counts, control, data = zip(*held)
            return pa.record_batch({
                "part": pa.array([part], pa.int32()), "block": pa.array([block], pa.int64()),
                "before": pa.array([before], pa.int64()), "size": pa.array([size], pa.int64()),
                "doc_ids": pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                "counts": pa.array([np.array(counts, "<i8").tobytes()], pa.binary()),
                "control": pa.array([b"".join(control)], pa.binary()),
                "data": pa.array([b"".join(data)], pa.binary())})

        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("part", "doc_id", "n", "control", "data"))):
                if held and (row[0] != part or size >= BLOCK):
                    yield done()
                    block, before, held, size = block + 1, before + size, [], 0
                if row[0] != part:
                    part, block, before = row[0], 0, 0
                held.append(row[1:])
                size += row[2]
        if held:
            yield done()

    coded = tokens.mapInArrow(encode, "part int, doc_id long, n long, control binary, data binary")
    coded.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "doc_id").mapInArrow(
        join, "part int, block long, before long, size long, doc_ids binary, counts binary, control binary, data binary",
    ).write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the documents written below ``path``; ``start`` counts
    the ids of all documents before, ``ids`` are little-endian unsigned 32-bit integers."""
    blocks = spark.read.parquet(f"{path}/blocks")
    ranks = np.zeros(1 << 16, "<u4")
    for r in spark.read.parquet(f"{path}/ranks").toLocalIterator():
        ranks[r.rank] = r.token
    table = spark.sparkContext.broadcast(ranks)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 1):
                part, before, ids, counts, control, data = (batch[c].to_pylist()[0] for c in (
                    "part", "before", "doc_ids", "counts", "control", "data"))
                counts = np.frombuffer(counts, "<i8")
                coded = table.value[unpack_ranks(counts, control, data)].tobytes()
                ends = np.cumsum(counts)
                yield pa.record_batch({
                    "part": pa.array(np.full(len(counts), part, np.int32)),
                    "doc_id": pa.array(np.frombuffer(ids, "<i8")), "inside": pa.array(before + ends - counts),
                    "n_tokens": pa.array(counts),
                    "ids": pa.array([coded[4 * (z - n):4 * z] for z, n in zip(ends.tolist(), counts.tolist())],
                                    pa.binary())})

    # one row for each PART_DOCS documents or so
    totals = blocks.groupBy("part").agg(F.sum("size").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    decoded = blocks.mapInArrow(decode, "part int, doc_id long, inside long, n_tokens long, ids binary")
    return decoded.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """``write`` to a new folder below the shared one, and what ``read`` makes of it."""
    path = f"{shared_folder(docs.sparkSession)}/token-files-{uuid.uuid4().hex}"
    write(docs, path, **options)
    return read(docs.sparkSession, path)
