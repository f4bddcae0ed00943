import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stayledger.llm.components import components
from stayledger.llm.simhash import (
    GOLAY, RADIUS, _syndromes, anchor_tables, fingerprint, first_of_each, links, near_duplicates)
from tests.llm.helpers import DOCS, docs, prose


def slow_fingerprint(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(ids, fps, threshold=4):
    label = {i: i for i in ids}
    for _ in ids:
        for i, x in zip(ids, fps):
            for j, y in zip(ids, fps):
                if (x ^ y).bit_count() <= threshold:
                    label[i] = label[j] = min(label[i], label[j])
    return label


@pytest.mark.parametrize("text", ["", "  \t\n", "One", "a b c", "a b c d", "A  b\x0bC\x0c d e e e e e e", prose(1, 300),
                                  "É ä b  c d e", "x " * 70000])
def test_fingerprint_equals_its_definition(text):
    assert fingerprint(text.encode()) == slow_fingerprint(text)


def test_every_value_has_one_home_and_all_visits():
    of, home, visits = anchor_tables(RADIUS + 1)
    assert of[GOLAY] == 0 and len(np.unique(of)) == 1 << 11
    anchors = np.nonzero(_syndromes() == 0)[0]
    assert len(anchors) == 1 << 12 and np.bitwise_count(home.astype(np.uint64)).max() <= RADIUS
    for value in np.random.default_rng(0).integers(0, 1 << 23, 50):
        near = {int(a) for a in anchors if int(a ^ value).bit_count() <= RADIUS + 1}
        assert {int(value ^ e) for e in visits[of[value]] if e >= 0} == near


def test_links_join_what_all_pairs_join(spark):
    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(40)]
    for base in list(fps[:25]):
        for _ in range(6):
            x = base
            for bit in rng.sample(range(64), rng.randrange(1, 7)):
                x ^= 1 << bit
            fps.append(x)
    fps = sorted(set(fps)) + [0, 1, 2**64 - 1]
    nodes = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x, i) for i, x in enumerate(fps)], "fp long, node long")
    joined = {r.node: r.component for r in components(links(nodes)).collect()}
    want = groups(range(len(fps)), fps)
    assert {i: joined.get(i, i) for i in range(len(fps))} == want


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(10, 60)] + [(100, x) for x in range(101, 130)] + [(5, 5), (200, 201), (201, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 10 for i in range(10, 61)}, **{i: 100 for i in range(100, 130)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_near_duplicates_of_documents(spark):
    base = prose(2, 400)
    texts = [base, base.upper(), base + " tail", None, "", "one two", "One TWO", prose(3, 100)]
    rows = docs(spark, *texts, first=10)
    rows = rows.unionByName(rows.limit(1)).unionByName(spark.createDataFrame([(None, base, "", "", 1)], DOCS))
    got = near_duplicates(rows.withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1)))
    assert got.count() == 10
    fps = [slow_fingerprint(t or "") for t in texts]
    want = groups(range(10, 18), fps)
    assert {r.doc_id: r.component_id for r in got.collect()} == want | {None: 10}
    assert want[11] == 10 and want[14] == 13 and want[16] == 15
    assert near_duplicates(docs(spark).limit(0)).collect() == []


def test_first_of_each_group_keeps_its_row(spark):
    rows = docs(spark, "a b c d", "x y z w q", "a b c d", first=1).withColumn("extra", F.col("doc_id") * 2)
    rows = rows.unionByName(rows.where("doc_id = 1"))
    got = first_of_each(rows)
    assert got.columns == rows.columns
    assert sorted((r.doc_id, r.text, r.extra) for r in got.collect()) == [(1, "a b c d", 2), (2, "x y z w q", 4)]


def test_texts_that_share_an_id_or_have_none_are_documents(spark):
    near, unique, other, lone = prose(1, 80), prose(2, 80), prose(3, 80), prose(4, 80)
    rows = spark.createDataFrame([(i, t, "", "", 1) for i, t in [
        (3, near), (7, near.upper()), (7, unique), (8, other), (8, lone), (None, prose(5, 80)), (None, prose(6, 80)),
        (None, unique), (None, None), (None, "")]], DOCS)
    got = first_of_each(rows.unionByName(rows)).collect()
    assert sorted((str(r.doc_id), r.text or "") for r in got) == sorted([
        ("3", near), ("7", unique), ("8", other), ("8", lone), ("None", prose(5, 80)), ("None", prose(6, 80)), ("None", "")])


def test_texts_that_share_an_id_are_linked_by_their_fingerprints_alone(spark):
    a, b = prose(1, 400), prose(2, 400)
    rows = spark.createDataFrame([(i, t, "", "", 1) for i, t in [
        (3, a), (7, a + " tail"), (7, b), (9, b + " tail"), (None, prose(3, 90))]], DOCS)
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in near_duplicates(rows).collect())
    assert got == [(0, 0), (3, 3), (7, 3), (7, 7), (9, 7)]
