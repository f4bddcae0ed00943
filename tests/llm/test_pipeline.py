"""The pipeline against its stages done by brute force, and the queries against their SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stayledger.llm import queries, simhash, toxicity
from stayledger.llm.common import table
from tests.llm.helpers import docs, prose
from tests.llm.test_simhash import groups, slow_fingerprint
from tests.llm.test_suffix_dedup import brute
from tests.llm.test_tokens import library, places
from verification.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


def through(spark, sf_dir, documents):
    frames = [documents]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], sf_dir))
    return frames


def test_stages_equal_brute_force(spark):
    first = table(spark, SF_DIR, "documents").where("doc_id < 120")
    frames = through(spark, SF_DIR, first)
    rows = [{r.doc_id: r for r in f.collect()} for f in frames[:-1]]
    assert all(f.columns == first.columns for f in frames[:-1])

    model = toxicity.learn(first, table(spark, SF_DIR, "labels"))
    features, w = toxicity.Features(), np.zeros(1 << toxicity.HASH_BITS)
    w[model[0]] = model[1]
    clean = {i: r for i, r in rows[0].items() if 1 / (1 + np.exp(-(w[features.of(r.text or "")].sum() + model[2]))) < 0.3}
    assert rows[1] == clean

    label = groups(list(clean), [slow_fingerprint(r.text or "") for r in clean.values()])
    kept = {i: r for i, r in clean.items() if label[i] == i}
    assert rows[2] == kept

    want = brute([r.text for r in kept.values()])
    for r, (removed, _, data) in zip(kept.values(), want):
        got = rows[3][r.doc_id]
        assert got.n_chars == len(got.text) and (got.lang, got.source) == (r.lang, r.source)
        assert len(got.text.encode()) <= len(data) and (removed or got.text == (r.text or ""))

    packed = frames[-1].collect()
    places(packed, 4096)
    ids = library("word_bpe_49k.json", [r.text for r in rows[3].values()])[0]
    for doc, want in zip(rows[3], ids):
        mine = sorted((r for r in packed if r.doc_id == doc), key=lambda r: r.start)
        assert [x for r in mine for x in np.frombuffer(r.ids, "<u2").tolist()] == want + [2]


def test_run_on_odd_documents(spark, tmp_path):
    text = prose(1, 80)
    docs(spark, text, text, None, "", "x", text[:300] + prose(2, 50)).withColumn("kept", F.lit("clash")).write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0), (9, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} <= {1, 3, 5, 6}
    docs(spark).limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/none/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_same_as_sql(spark, name):
    con = connect(SF_DIR)
    for t in ("conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    assert differences(spark, queries.queries()[name], queries.oracle_sql()[name], SF_DIR, con) == []


def test_all_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_stages_keep_rows_without_an_id_and_columns_of_any_name(spark):
    names = ["_key", "_nth", "_kept", "_data", "_starts", "_stops", "c0", "score"]
    rows = spark.createDataFrame([(1, prose(1, 80)), (None, prose(2, 80)), (None, prose(3, 80))], "doc_id bigint, text string")
    rows = rows.withColumns({c: F.lit(c) for c in names})
    kept = simhash.first_of_each(rows)
    assert kept.columns == rows.columns and kept.count() == 3
    cut = corpus_pipeline.cut_repeats(spark, kept, "")
    assert cut.columns == rows.columns and cut.count() == 3 and cut.where("_data = '_data' AND _key = '_key'").count() == 3
    packed = corpus_pipeline.pack_sequences(spark, cut, "")
    assert sorted((r.doc_id or 0) for r in packed.collect()) == [0, 0, 1]
