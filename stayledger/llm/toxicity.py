"""Toxicity by FTRL-proximal logistic regression over hashed word features.

The features of a text are the distinct hashes of its words, of neighbouring words, of words
with one word between them (skip-grams), and of the first letters of its words. Every coordinate
has its own learning rate, and the L1 term keeps most weights at zero, so the model is a short
list of weights. It is learnt in one task from at most ``SAMPLE`` labelled texts, those with the
least hash of id; every text is scored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.llm.common import pieces, small_batches, texts

#: Labelled texts that the model is learnt from at most, and passes over them.
SAMPLE, PASSES = 12_000, 2
#: Bits of a feature's hash.
HASH_BITS = 20
#: Learning rate, its damping, L1 and L2 weight.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 4.0, 1.0
THRESHOLD = 0.3
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6)
#: Distinct words kept by a task.
KEPT = 200_000

_WORD = re.compile(r"[^\W\d_]+")


class Features:
    """Hashed features of texts; hashes of words are kept for the next text."""

    def __init__(self):
        self.known: dict[str, int] = {}
        self.table = np.zeros((1 << 12, 1 + len(BEGINNINGS)), np.uint32)

    def _add(self, word: str) -> int:
        from zlib import crc32

        at = self.known[word] = len(self.known)
        if at == len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
        self.table[at] = [crc32(word.encode()), *(crc32(word[:k].encode(), k) for k in BEGINNINGS)]
        return at

    def of(self, text: str) -> np.ndarray:
        if len(self.known) > KEPT:
            self.known.clear()
        words, get = _WORD.findall(text.lower()), self.known.get
        if not words:
            return np.zeros(0, np.int64)
        at = [get(w, -1) for w in words]
        if -1 in at:
            at = [self.known[w] if w in self.known else self._add(w) for w in words]
        at = np.array(at)
        alone = self.table[np.unique(at)]
        h = self.table[at, 0]
        with np.errstate(over="ignore"):
            pairs = h[:-1] * np.uint32(0x9E3779B1) + h[1:] * np.uint32(0x85EBCA77)
            skips = h[:-2] * np.uint32(0xC2B2AE3D) + h[2:] * np.uint32(0x27D4EB2F)
            salted = alone * np.arange(0x9E3779B1, 0x9E3779B1 + 2 * alone.shape[1], 2, np.uint32)
        return np.unique(np.concatenate((salted.ravel(), pairs, skips)) >> np.uint32(32 - HASH_BITS)).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, int]], passes: int = PASSES) -> tuple[np.ndarray, np.ndarray, float]:
    """Indexes and values of the weights that are not zero, and the bias."""
    z, n = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    zb = nb = 0.0

    def weights(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    for _ in range(passes):
        for at, label in rows:
            w, bias = weights(z[at], n[at], L1), float(weights(zb, nb, 0.0))
            g = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - label
            old = n[at]
            n[at] = old + g * g
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / ALPHA * w
            zb += g - (np.sqrt(nb + g * g) - np.sqrt(nb)) / ALPHA * bias
            nb += g * g
    w = weights(z, n, L1)
    at = np.nonzero(w)[0]
    return at, w[at], float(weights(zb, nb, 0.0))


def held_out(id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text",
          label: str = "toxic", sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray, float]:
    """Model of the labelled rows that are not held out. Null labels and ids do not count."""
    chosen = labels.select(F.col(id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        "doc_id is not null and label is not null").where(~held_out()).orderBy(
            F.xxhash64("doc_id"), "doc_id", "label").limit(sample)
    rows = texts(docs, id, text).join(F.broadcast(chosen), "doc_id")  # at most ``sample`` rows

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for whole in batches:
            for batch in pieces(whole):
                yield pa.record_batch({
                    "doc_id": batch["doc_id"], "label": batch["label"], "at": pa.array(
                        [features.of(x.decode()).astype("<u4").tobytes() for x in batch["text"].to_pylist()],
                        pa.binary())})

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(np.frombuffer(at, "<u4").astype(np.int64), y)
                for b in batches for at, y in zip(b["at"].to_pylist(), b["label"].to_pylist())]
        at, w, bias = ftrl(rows)
        yield pa.record_batch({"at": pa.array(np.append(at, -1)), "w": pa.array(np.append(w, bias))})

    fitted = rows.mapInArrow(hashed, "doc_id long, label int, at binary").repartition(1).sortWithinPartitions(
        F.xxhash64("doc_id"), "doc_id", "label", "at").mapInArrow(fit, "at long, w double")
    found = {r.at: r.w for r in fitted.collect()}  # at most one row for each hash
    bias = found.pop(-1, 0.0)  # no task fits where no row is labelled
    order = sorted(found)
    return np.array(order, np.int64), np.array([found[k] for k in order]), bias


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray, float], text: str = "text",
           out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``: the probability of each whole text under the model."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, bias = shared.value
        w, features = np.zeros(1 << HASH_BITS), Features()
        w[at] = values
        for batch in batches:
            total = [w[features.of(x or "")].sum() + bias for x in batch[text].to_pylist()]
            score = 1 / (1 + np.exp(-np.clip(np.array(total, float), -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(out, T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Null texts count as empty and get the score of a text without words; a null id is an id like
    any other, and not held out; repeated rows are returned as often; other columns, language and source among
    them, play no part; without labels the score is one half; no rows give no rows.
    """
    plain = docs.select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return scored(plain, learn(docs, labels, id, text)).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score stays under the threshold, with all their columns."""
    names = docs.columns
    plain = docs.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(names)))
    return scored(plain, learn(docs, labels, id, text), f"c{names.index(text)}").where(
        F.col("score") < THRESHOLD).select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(names)))
