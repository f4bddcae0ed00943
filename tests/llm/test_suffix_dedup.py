import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm.suffix_dedup import LENGTH, without_repeats
from tests.llm.helpers import DOCS, docs, prose


def brute(texts):
    """(removed, spans, kept) of each text, from all strings of LENGTH bytes."""
    data, seen = [(t or "").encode() for t in texts], {}
    for k, b in enumerate(data):
        for i in range(len(b) - LENGTH + 1):
            seen.setdefault(b[i:i + LENGTH], []).append((k, i))
    masks = [np.zeros(len(b), bool) for b in data]
    for places in seen.values():
        if len(places) > 1:
            for k, i in places:
                masks[k][i:i + LENGTH] = True
    return [(int(m.sum()), int((np.diff(np.r_[0, m.astype(int)]) == 1).sum()),
             np.frombuffer(b, np.uint8)[~m].tobytes()) for b, m in zip(data, masks)]


def check(spark, texts):
    got = without_repeats(docs(spark, *texts)).orderBy("doc_id").collect()
    want = brute(texts)
    assert [(r.n_removed, r.n_spans, bytes(r.kept)) for r in got] == want
    for r, t in zip(got, texts):
        assert r.n_bytes == len((t or "").encode()) and len(r.spans) == r.n_spans
        assert sum(s.stop - s.start for s in r.spans) == r.n_removed
    return got


def test_equals_brute_force(spark):
    a, b, c = prose(1, 120), prose(2, 90), prose(3, 200)
    passage, umlauts = prose(4, 60), "äöü" * 90
    check(spark, [
        a, a, None, "", "short", b + " " + passage + c, passage, c[:150] + passage + b, "x" * 199, "y" * 200,
        "z" * 201, "ab " * 300, "The " * 90 + a[:300], umlauts + b[:205], "é" + umlauts, c[100:500] + a[:250] + c[300:700],
        passage[:199], passage[1:201], b[-200:], b[:200]])


def test_edges_of_texts_and_one_byte_shifts(spark):
    base = prose(5, 150)
    check(spark, [base[k:k + n] + sep for k, n, sep in (
        (0, 200, ""), (0, 201, ""), (1, 200, "q"), (50, 400, ""), (51, 398, "!"), (120, 260, ""), (0, len(base), ""))])


def test_kept_text_has_whole_characters(spark):
    shared = "ä" * 100
    got = check(spark, ["x" + shared + "é" + prose(6, 20), "yy" + shared + "ê" + prose(7, 20)])
    for r in got:
        r.kept_text.encode()
        assert "�" not in r.kept_text


def test_rows_and_columns_around_it(spark):
    text = prose(8, 60)
    rows = spark.createDataFrame([(1, text, "mine", "s", 5), (1, text, "mine", "s", 5), (1, "other", "b", "s", 5),
                                  (None, text, "c", "s", 5)], DOCS).withColumnRenamed("lang", "spans")
    got = without_repeats(rows.withColumn("key", F.lit(3)).withColumn("bytes", F.lit("z")))
    assert got.count() == 4
    assert sorted(r.n_removed for r in got.collect()) == [0, len(text), len(text), len(text)]
    assert without_repeats(docs(spark).limit(0)).collect() == []


@pytest.mark.parametrize("copies", [40])
def test_many_copies_of_one_passage(spark, copies):
    passage = prose(9, 50)
    check(spark, [prose(100 + i, 5 + i) + " " + passage + " " + prose(200 + i, 3) for i in range(copies)])


def test_digest_of_the_query(spark, tmp_path):
    from stayledger.llm.queries import op8_suffix_dedup

    texts = [prose(10, 80), prose(10, 80), "a"]
    docs(spark, *texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op8_suffix_dedup(spark, str(tmp_path)).collect()}
    assert got[3].kept_sha256 == hashlib.sha256(b"a").hexdigest()
    assert got[1].kept_sha256 == hashlib.sha256(b"").hexdigest()
