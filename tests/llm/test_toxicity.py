import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import toxicity
from stayledger.llm.common import table
from tests.llm.helpers import DOCS, docs, prose

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_documents_are_told_apart(spark):
    documents, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    got = toxicity.toxicity(documents, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    test = got[got.held_out]
    assert len(test) > 500 and test.toxic.sum() > 50
    assert test.predicted[test.toxic == 1].mean() > 0.85
    assert test.predicted[test.toxic == 0].mean() < 0.01
    assert ((got.score >= 0.3) == got.predicted).all() and got.score.between(0, 1).all()


def labelled(spark, n=80):
    rows = [(i, prose(i, 30) + (" grunt swine " if i % 3 == 0 else " kind ") + prose(900 + i, 20)) for i in range(n)]
    return (spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], DOCS),
            spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))


def test_labels_of_held_out_rows_do_not_matter(spark):
    documents, labels = labelled(spark)
    other = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (toxicity.learn(documents, x) for x in (labels, other))
    assert all(np.array_equal(x, y) for x, y in zip(a, b)) and len(a[0]) > 0


def test_null_rows_and_empty_tables(spark):
    documents, labels = labelled(spark)
    labels = labels.unionByName(spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    odd = docs(spark, None, "", "grunt swine", "long " * 30000, first=1000).unionByName(
        spark.createDataFrame([(None, "x", "", "", 1)], DOCS))
    odd = odd.unionByName(odd.limit(1)).withColumnRenamed("lang", "score").withColumn("label", F.lit("x"))
    got = {}
    for r in toxicity.toxicity(odd, labels.join(documents.select("doc_id"), "doc_id")).collect():
        got.setdefault(r.doc_id, []).append(r.score)
    assert set(got) == {1000, 1001, 1002, 1003, None} and len(got[1000]) == 2
    assert got[1000][0] == got[1001][0]
    scored = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert {r.score for r in scored} == {0.5}
    assert toxicity.toxicity(docs(spark).limit(0), labels).collect() == []


def test_filter_keeps_all_columns(spark):
    documents, labels = labelled(spark)
    rows = documents.withColumn("score", F.lit("mine")).withColumn("c0", F.lit(1))
    kept = toxicity.without_toxic(rows, labels)
    assert kept.columns == rows.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i in range(80) if i % 3} <= ids and len(ids & {i for i in range(0, 80, 3)}) < 5


@pytest.mark.parametrize("sample", [5, 40])
def test_sample_bounds_the_fit(spark, sample):
    documents, labels = labelled(spark)
    assert toxicity.learn(documents, labels, sample=sample)[2] < 0.5
