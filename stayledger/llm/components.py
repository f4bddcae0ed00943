"""Connected components of a link table, in rounds of joins and aggregates.

Large and small stars in turn (Kiveris et al., 2014): every node's larger neighbours are linked
to its smallest neighbour, then all its smaller ones. Minima are combined before the shuffle
and the joins have one row per key on one side, so a node with very many links is no hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayledger.llm.common import store


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame):
    return edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v), the smallest node naming each
    component. Links of a node to itself count for nothing; repeated links are one."""
    edges = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    now = store(edges.distinct(), "links")
    seen = _state(now)
    while seen[0]:
        now = store(_small(_large(now)), "links")
        if (state := _state(now)) == seen:
            break
        seen = state
    # every edge now leads from a node to the smallest one of its component
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
