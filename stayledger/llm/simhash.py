"""SimHash near-duplicates by anchor points of a covering code.

A fingerprint of 64 bits is cut into three blocks. Two fingerprints that differ in at most
``threshold`` bits differ in at most ``threshold // 3`` bits of some block. Blocks live in a
space of 23 bits that the binary Golay code covers perfectly: each value has exactly one of the
4096 anchors within radius 3. A fingerprint is at home at that anchor and visits every anchor
within ``3 + threshold // 3``; so of each linked pair one meets the other at its home.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayledger.llm.common import fresh, pieces, small_batches, store, texts
from stayledger.llm.components import components

BITS, SHINGLE, SEED = 64, 4, 42
#: Generator polynomial of the binary Golay code of length 23.
GOLAY, LENGTH, RADIUS = 0b101011100011, 23, 3
#: First bit and width of each block.
BLOCKS = ((0, 21), (21, 21), (42, 22))
#: Rows of one anchor that are compared with each other in one task.
CHUNK = 4096


def fingerprint(text: bytes) -> int:
    """Majority of the bits of the XXH64 values of all word shingles, repeats included."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < SHINGLE:
        return hashed(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - SHINGLE + 1].tolist()
    stops = (ends[SHINGLE - 1:] - 1).tolist()
    h = np.array([hashed(joined[a:z], SEED) for a, z in zip(starts, stops)], "<u8")
    count = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at:at + (1 << 16)]
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(count * 2 > len(h), bitorder="little").tobytes(), "little")


def _printed(rows: DataFrame, schema: str) -> DataFrame:
    """Columns of ``rows`` with the fingerprint ``fp`` in place of ``text``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in pieces(whole):
                fps = np.array([fingerprint(x) for x in batch["text"].to_pylist()], np.uint64)
                yield pa.record_batch({**{c: batch[c] for c in batch.schema.names if c != "text"},
                                       "fp": pa.array(fps.view(np.int64))})

    return rows.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp) for each row; ``fp`` holds the bits of an unsigned number in a long."""
    return _printed(texts(docs, id, text, without_id=True), "doc_id long, fp long")


def _syndromes() -> np.ndarray:
    """Remainder of each 23-bit value modulo the generator."""
    values = np.arange(1 << LENGTH, dtype=np.uint32)
    for bit in range(LENGTH - 1, 10, -1):
        values = np.where(values >> bit & 1, values ^ np.uint32(GOLAY << bit - 11), values)
    return values.astype(np.uint16)


def anchor_tables(reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndrome of each 23-bit value; for each syndrome the pattern that leads to the home
    anchor, and all patterns of at most ``reach`` bits that lead to an anchor (padded by -1)."""
    from itertools import combinations

    of = _syndromes()
    by = [[] for _ in range(1 << 11)]
    for weight in range(reach + 1):
        for bits in combinations(range(LENGTH), weight):
            e = sum(1 << b for b in bits)
            by[of[e]].append(e)  # lightest first, so the home pattern leads
    visits = np.full((1 << 11, max(map(len, by))), -1, np.int64)
    for s, patterns in enumerate(by):
        visits[s, : len(patterns)] = patterns
    return of, visits[:, 0].copy(), visits


def _placed(nodes: DataFrame, threshold: int) -> DataFrame:
    """(anchor, home, fp, node): each distinct fingerprint at every anchor that it visits."""
    reach = RADIUS + threshold // len(BLOCKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, _, visits = anchor_tables(reach)
        for batch in batches:
            fp = batch["fp"].to_numpy(zero_copy_only=False).view(np.uint64)
            node = batch["node"].to_numpy(zero_copy_only=False)
            for k, (start, width) in enumerate(BLOCKS):
                value = (fp >> np.uint64(start) & np.uint64((1 << width) - 1)).astype(np.int64)
                pattern = visits[of[value]]
                row, slot = np.nonzero(pattern >= 0)
                anchor = value[row] ^ pattern[row, slot]
                yield pa.record_batch({
                    "anchor": pa.array(anchor | k << LENGTH), "home": pa.array(slot == 0),
                    "fp": pa.array(fp[row].view(np.int64)), "node": pa.array(node[row])})

    return nodes.mapInArrow(run, "anchor long, home boolean, fp long, node long")


def _forest(fp: np.ndarray, node: np.ndarray, home: np.ndarray, threshold: int) -> list[tuple[int, int]]:
    """Links between homes and visitors of one anchor, without those that join what earlier
    ones have joined: fewer links than rows, with the same components."""
    label, links = np.arange(len(fp)), []
    order = {}
    for i, x in enumerate(node.tolist()):  # a home row and a visiting row of a node are one
        label[i] = order.setdefault(x, i)
    for i in np.nonzero(home)[0]:
        near = np.nonzero(np.bitwise_count(fp ^ fp[i]) <= threshold)[0]
        for other in np.unique(label[near]):
            if other != label[i]:
                links.append((int(node[i]), int(node[near[label[near] == other][0]])))
                label[label == other] = label[i]
    return links


def links(nodes: DataFrame, threshold: int = 4) -> DataFrame:
    """(u, v): links that connect the distinct fingerprints ``nodes`` (fp, node) as all pairs of
    at most ``threshold`` differing bits do. Not all pairs are returned.

    An anchor with many rows is cut into chunks of homes and of visitors, each pair of which is
    a group of its own. There are 3 * 4096 anchors at most, whatever the input: their counts are
    the only broadcast.
    """
    placed = store(_placed(nodes, threshold), "placed")
    counts = placed.groupBy("anchor").agg(
        F.ceil(F.sum(F.col("home").cast("int")) / CHUNK).alias("homes"),
        F.ceil(F.count("*") / CHUNK).alias("visitors")).where("homes > 0")
    spread = F.xxhash64("node")
    dealt = placed.join(F.broadcast(counts), "anchor")
    grid = dealt.where("home").select(
        "anchor", F.pmod(spread, F.col("homes")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("visitors") - 1)).alias("j"),
        F.lit(True).alias("home"), "fp", "node").unionByName(dealt.select(
            "anchor", F.explode(F.sequence(F.lit(0).cast("long"), F.col("homes") - 1)).alias("i"),
            F.pmod(spread, F.col("visitors")).alias("j"), F.lit(False).alias("home"), "fp", "node"))

    def compare(group: pa.Table) -> pa.Table:
        fp, node, home = (group[c].combine_chunks().to_numpy(zero_copy_only=False)
                          for c in ("fp", "node", "home"))
        found = _forest(fp.view(np.uint64), node, home, threshold)
        return pa.table({"u": pa.array([a for a, _ in found], pa.int64()),
                         "v": pa.array([b for _, b in found], pa.int64())})

    return grid.groupBy("anchor", "i", "j").applyInArrow(compare, "u long, v long")


def near_duplicates(docs: DataFrame, threshold: int = 4, id: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs``: documents whose fingerprints differ
    in at most ``threshold`` bits are linked, ``component_id`` is the smallest id reachable.

    Null texts count as empty, whose fingerprint is zero; a null id is an id like any other, but
    names a component only if no row of it has one; texts that share an id are linked by their
    fingerprints alone; a repeated row is returned as often; other columns play no part; no rows
    give no rows.
    """
    if not 0 <= threshold // len(BLOCKS) <= 2:
        raise ValueError("threshold: 0 to 8 differing bits")
    prints = store(fingerprints(docs, id, text), "fingerprints")
    nodes = store(prints.groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("node", F.col("fp")), "nodes")
    joined = components(links(nodes.select("fp", "node"), threshold))
    named = store(nodes.join(joined, "node", "left").select(
        "fp", "first", F.coalesce("component", "node").alias("group")), "groups")
    least = store(named.groupBy("group").agg(F.min("first").alias("component_id")), "least")
    names = store(named.join(least, "group").select("fp", "component_id"), "names")
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, threshold: int = 4, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates, with all its columns: that of the smallest id, and
    of rows that share this id the one with the least hash of id and text.

    Rows are told apart by that hash, so different texts that share an id are documents of their
    own, and rows without an id take part, after all others of their group. Null texts count as
    empty; of rows that repeat id and text one stays; no rows give no rows.
    """
    small_batches(docs.sparkSession)
    number = F.col(id).cast("long")
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    key = F.xxhash64(number, data)
    prints = store(_printed(docs.select(number.alias("doc_id"), key.alias("key"), data.alias("text")),
                            "doc_id long, key long, fp long"), "fingerprints")
    nodes = store(prints.select("fp", F.col("fp").alias("node")).distinct(), "nodes")
    named = nodes.join(components(links(nodes, threshold)), "node", "left").select(
        "fp", F.coalesce("component", "node").alias("group"))
    kept = prints.join(named, "fp").groupBy("group").agg(F.min(F.struct(
        F.col("doc_id").isNull(), "doc_id", "key")).alias("first")).select(F.col("first.key").alias(own := fresh("_key", docs)))
    order, nth = Window.partitionBy(own).orderBy(F.xxhash64(*docs.columns)), fresh("_nth", docs)
    return docs.withColumn(own, key).join(kept, own).withColumn(nth, F.row_number().over(order)).where(
        F.col(nth) == 1).select(*docs.columns)
