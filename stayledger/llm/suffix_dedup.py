"""Repeated long strings by buckets of suffixes that are refined by later offsets.

A string of ``LENGTH`` bytes starts at every position. Positions that share their first bytes
form a bucket; a bucket of one is done, and a bucket is refined by what its members have at
later offsets until its strings are compared in full. Two savings keep that far below one row
for each byte:

* The initial buckets are those of the q-grams at *anchors*: in every window of ``LENGTH`` bytes
  the q-gram with the least hash. Equal strings have their anchors at equal offsets ``d``.
* An anchor stands for a range of offsets ``d``, so for the strings that start at ``p - d``.
  What all of them share (the *inner* string) must be repeated, else none of them is; if what
  they cover together (the *outer* string) is repeated, all of them are. Only where neither
  decides, the range is halved, its inner string grows to later offsets and the bucket is
  refined again, down to a single start.

Strings are compared by 64-bit hashes of their bytes. Texts are named by a hash of id and text,
so rows that share an id stay apart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.llm.common import fresh, pieces, small_batches, store

LENGTH, GRAM = 200, 64
#: Number of offsets that a start can have before its anchor.
SPAN = LENGTH - GRAM + 1
#: Bytes that are hashed at once; starts of a long text that are handled at once.
BLOB, SLICE = 1 << 17, 1 << 20

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xA0761D6478BD642F, 0xD6E8FEB86659FD93))


def _tables(data: np.ndarray) -> list[np.ndarray]:
    """Hashes of the strings of 1, 2, 4, ... 256 bytes at every position."""
    h = [(data.astype(np.uint64) + np.uint64(1)) * _C]
    while len(h) < 9 and len(data) >= 2 << len(h) - 1:
        step = 1 << len(h) - 1
        x = h[-1][:-step] * _B
        x += h[-1][step:]
        x ^= x >> np.uint64(32)
        x *= _A
        h.append(x)
    return h


def _hash(tables: list[np.ndarray], start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of the string of each start and length, from two overlapping powers of two."""
    out = np.zeros(len(start), np.uint64)
    level = np.minimum(np.log2(length).astype(np.int64), len(tables) - 1)
    for k in np.unique(level):
        at = level == k
        a, n = start[at], length[at]
        x = tables[k][a] * _B + tables[k][a + n - (1 << k)]
        x ^= x >> np.uint64(29)
        out[at] = (x + n.astype(np.uint64)) * _A
    return out


def _found(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchors of texts that stand one after the other, each ``LENGTH`` bytes at least: place,
    first and last offset that each stands for, hashes of inner and outer strings."""
    tables = _tables(data)
    value = tables[6]
    place, size = np.arange(len(value), dtype=np.int32), 1
    while size < SPAN:  # leftmost minimum of SPAN successive values
        step = min(size, SPAN - size)
        right = value[step:] < value[:-step]
        place = np.where(right, place[step:], place[:-step])
        value = np.where(right, value[step:], value[:-step])
        size += step
    inside = np.ones(len(data) + 1, bool)
    for k in range(1, LENGTH):
        inside[ends - LENGTH + k] = False
    starts = np.nonzero(inside[:len(place)])[0]
    place = place[starts].astype(np.int64)
    first = np.nonzero(np.concatenate(([True], place[1:] != place[:-1])))[0]
    last = np.concatenate((first[1:], [len(place)])) - 1
    p = place[first]
    near, far = p - starts[last], p - starts[first]
    outer = _hash(tables, p - far, far - near + LENGTH)
    # the same offsets are part of what must be equal
    outer = (outer + near.astype(np.uint64) * _B + far.astype(np.uint64) * _C) * _A
    return p, near, far, tables[6][p], outer


def _blobs(keys: list[int], texts: list[bytes]):
    """Texts in blobs of about BLOB bytes, as (keys, offsets, parts)."""
    held, size = [], 0
    for key, text in zip(keys, texts):
        for at in range(0, len(text) - LENGTH + 1, SLICE):
            part = text[at:at + SLICE + LENGTH - 1]
            held.append((key, at, part))
            if (size := size + len(part)) >= BLOB:
                yield zip(*held)
                held, size = [], 0
    if held:
        yield zip(*held)


def anchors(keyed: DataFrame) -> DataFrame:
    """Initial buckets of (key, text): (key, p, near, far, inner, outer) for each anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                for keys, offsets, parts in _blobs(batch["key"].to_pylist(), batch["text"].to_pylist()):
                    ends = np.cumsum([len(x) for x in parts])
                    with np.errstate(over="ignore"):
                        p, near, far, inner, outer = _found(np.frombuffer(b"".join(parts), np.uint8), ends)
                    of = np.searchsorted(ends, p, "right")
                    p = p - np.concatenate(([0], ends))[of] + np.array(offsets)[of]
                    yield pa.record_batch({
                        "key": pa.array(np.array(keys)[of]), "p": pa.array(p),
                        "near": pa.array(near.astype(np.int32)), "far": pa.array(far.astype(np.int32)),
                        "inner": pa.array(inner.view(np.int64)), "outer": pa.array(outer.view(np.int64))})

    return keyed.mapInArrow(run, "key long, p long, near int, far int, inner long, outer long")


def _marked(level: DataFrame, name: str) -> DataFrame:
    """The rows of shared buckets, with ``sure`` true where all their strings are repeated and
    ``lead`` true for one row of those that are equal in all their strings.
    Counts are combined before the shuffle; both joins have one row per key on the right."""
    row = F.xxhash64("key", "p", "near")
    shared = level.groupBy("inner").agg(F.count("*").alias("n")).where("n > 1").select("inner")
    alive = store(level.join(shared, "inner", "left_semi"), name)
    twice = alive.groupBy("outer").agg(F.count("*").alias("n"), F.min(row).alias("first")).where(
        "n > 1").select("outer", F.lit(True).alias("sure"), "first")
    return store(alive.join(twice, "outer", "left").withColumn("lead", row == F.col("first")).drop("first"), name)


def _open(level: DataFrame) -> DataFrame:
    """The rows to refine: those that are not sure, and as their partners one of each class of
    equal rows in the same buckets."""
    unsure = level.where("sure is null")
    partners = level.where("lead").join(unsure.select("inner").distinct(), "inner", "left_semi")
    return unsure.unionByName(partners)


def _contexts(open_: DataFrame, keyed: DataFrame) -> DataFrame:
    """Open anchors with the bytes that their strings cover, to refine them without the texts."""
    places = open_.groupBy("key").agg(F.collect_list(F.struct("p", "near", "far", "inner")).alias("places"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 200):
                rows = [(key, x["p"], x["near"], x["far"], x["inner"],
                         text[x["p"] - x["far"]:x["p"] - x["near"] + LENGTH])
                        for key, text, places in zip(*(batch[c].to_pylist() for c in ("key", "text", "places")))
                        for x in places]
                for at in range(0, len(rows), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, t) for x, t in zip(zip(*rows[at:at + 10_000]), (
                            pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()))],
                        ["key", "p", "near", "far", "bucket", "bytes"])

    return store(keyed.join(places, "key").mapInArrow(
        run, "key long, p long, near int, far int, bucket long, bytes binary"), "contexts").withColumns(
            {"low": F.lit(0), "high": F.lit(SPAN - 1)})


def _halved(open_: DataFrame) -> DataFrame:
    """Both halves of every open range. ``inner`` joins the bucket so far with what the strings
    of the half share. Ranges are cut at the same offsets for all anchors, so buckets agree;
    a range of which an anchor stands for a part only has the whole range's inner string."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_64_intdigest
        for whole in batches:
            for batch in pieces(whole, 5000):
                rows, hashes = [], []
                columns = (batch[c].to_pylist() for c in ("key", "p", "near", "far", "low", "high", "bucket", "bytes"))
                for key, p, near, far, low, high, bucket, data in zip(*columns):
                    mid = (low + high) // 2
                    for a, z in ((low, mid), (mid + 1, high)):
                        n, f = max(near, a), min(far, z)
                        if n <= f:  # ``data`` starts at p - far
                            cover = data[far - f:far - n + LENGTH]
                            rows.append((key, p, n, f, a, z, cover))
                            hashes.append((
                                digest(data[far - a:far - z + LENGTH], seed=bucket + a & (1 << 64) - 1),
                                digest(cover, seed=n << 8 | f)))
                if rows:
                    inner, outer = (np.array(x, np.uint64).view(np.int64) for x in zip(*hashes))
                    kinds = (pa.int64(), pa.int64(), *[pa.int32()] * 4, pa.binary(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip((*zip(*rows), inner, outer), kinds)],
                        ["key", "p", "near", "far", "low", "high", "bytes", "inner", "outer"])

    return open_.mapInArrow(run, "key long, p long, near int, far int, low int, high int, bytes binary, "
                                 "inner long, outer long")


def repeated(keyed: DataFrame) -> DataFrame:
    """(key, starts, stops): for each text of (key, text) with repeated strings the parts, in
    bytes, that such strings cover; parts may overlap."""
    level = _marked(anchors(keyed), "anchors")
    sure = [level.where("sure")]
    open_ = _contexts(_open(level), keyed)
    width = SPAN
    while width > 1:
        level = _marked(_halved(open_), "halves")
        sure.append(level.where("sure"))
        open_ = _open(level.where("low < high")).withColumnRenamed("inner", "bucket")
        width = (width + 1) // 2
    rows = sure[0].select("key", "p", "near", "far")
    for more in sure[1:]:
        rows = rows.unionByName(more.select("key", "p", "near", "far"))
    return rows.groupBy("key").agg(
        F.collect_list(F.expr("p - far")).alias("starts"),
        F.collect_list(F.expr(f"p - near + {LENGTH}")).alias("stops"))


def merged(starts, stops) -> list[tuple[int, int]]:
    """Union of intervals, as maximal runs in order."""
    order, runs = np.argsort(starts, kind="stable"), []
    for a, z in zip(np.asarray(starts)[order].tolist(), np.asarray(stops)[order].tolist()):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], z)
        else:
            runs.append([a, z])
    return [tuple(x) for x in runs]


_ADDED = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                     T.StructField("stop", T.LongType())]))),
    T.StructField("kept", T.BinaryType()), T.StructField("kept_text", T.StringType())])


def _whole(data: bytes, a: int, z: int) -> tuple[int, int]:
    """The run a..z, widened to whole UTF-8 characters."""
    while a and data[a] & 0xC0 == 0x80:
        a -= 1
    while z < len(data) and data[z] & 0xC0 == 0x80:
        z += 1
    return a, z


def _without(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    at = [0, *(x for run in runs for x in run), len(data)]
    return b"".join(data[a:z] for a, z in zip(at[::2], at[1::2]))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the columns ``n_bytes, n_removed, n_spans, spans, kept, kept_text`` (in
    place of any of those names): every byte covered by a string of 200 bytes that also starts
    anywhere else, in the same text or another, is taken out; ``kept`` has the remaining bytes,
    ``kept_text`` those of characters that remain whole.

    Null texts count as empty; texts under 200 bytes lose nothing to themselves or others; rows
    that share an id or repeat each other are texts of their own; a null id is an id like any
    other; other columns stay as they are; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    keyed = docs.select(F.xxhash64(F.col(id).cast("string"), data).alias("key"), data.alias("text"))
    long = keyed.where(F.length("text") >= LENGTH)
    own, bytes_, low, high = (fresh(c, docs) for c in ("_key", "_data", "_starts", "_stops"))
    parts = repeated(long).select(F.col("key").alias(own), F.col("starts").alias(low), F.col("stops").alias(high))
    joined = docs.drop(*_ADDED.names).withColumn(own, F.xxhash64(F.col(id).cast("string"), data)).withColumn(
        bytes_, data).join(parts, own, "left")
    names = [c for c in docs.columns if c not in _ADDED.names]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole, 200):
                out = []
                for text, a, z in zip(*(batch[c].to_pylist() for c in (bytes_, low, high))):
                    runs = merged(a, z) if a else []
                    out.append((len(text), sum(z - a for a, z in runs), len(runs),
                                [{"start": a, "stop": z} for a, z in runs], _without(text, runs),
                                _without(text, [_whole(text, *x) for x in runs]).decode()))
                kinds = (*[pa.int64()] * 3, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])),
                         pa.binary(), pa.string())
                added = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), *added], [*names, *_ADDED.names])

    return joined.mapInArrow(cut, T.StructType([*(docs.schema[c] for c in names), *_ADDED]))
