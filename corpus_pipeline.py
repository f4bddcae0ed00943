"""From raw documents to packed training sequences, in stages.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before it kept; what it
returns is written as Parquet and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayledger.llm import packing, simhash, suffix_dedup, toxicity
from stayledger.llm.common import store, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays under the threshold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.first_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of 200 bytes that occur more than once."""
    cut = suffix_dedup.without_repeats(docs)
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text")}
    return cut.withColumns({c: x.cast(docs.schema[c].dataType) for c, x in new.items() if c in docs.columns}).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("simhash", drop_near_copies), ("suffix_dedup", cut_repeats),
          ("packing", pack_sequences)]

#: Hashing, learning and tokenising have no SQL; a brute-force version checks the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = store(docs, f"stage-{name}")
    return docs
