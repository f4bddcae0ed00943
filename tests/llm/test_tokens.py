"""Packing, token files and BPE against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stayledger.llm import bpe, packing, token_files, tokens
from stayledger.llm.tokens import Encoder
from tests.llm.helpers import DOCS, docs, prose

rng = random.Random(7)
TEXTS = ["", None, "  \n\n x  y", "a<|endoftext|>b <|startoftext|>", "It's we'll  they'd 'S ''s '.s\x1c\x1d x\x85y\xa0z ²³ 12½ é",
         "“hi” – 日本語 テキスト 😀", "İ Σς", "x" * 500, "ab" * 300 + "\n" * 7 + " ", prose(1, 900), prose(1, 900), "The " * 5000] + [
    "".join(rng.choice("aeinst 'lvdm\n\t.,!²é½\xa0\x85\x1c_0129<|>ß😀中’") for _ in range(200)) for _ in range(40)]


def library(name, texts=TEXTS):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [x.ids for x in t.encode_batch([x or "" for x in texts], add_special_tokens=False)], t


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_encoded_once_equal_whole_texts(name):
    mine = Encoder(name)
    for _ in range(2):  # from a new and from a filled table of words
        got = [np.frombuffer(x, "<u2").tolist() for x in mine.encode([x or "" for x in TEXTS])]
        assert got == library(name)[0]


def test_parts_between_spaces_equal_whole_texts(monkeypatch):
    mine = Encoder("byte_bpe_50k.json")
    met, new = [], mine._new_parts
    monkeypatch.setattr(mine, "_new_parts", lambda parts: met.append(parts) or new(parts))
    plain = ["", " ", "a", " a b  c\n d\t ", "a\x85 b\xa0 ", "one two. three", "two. three one"] + [
        "".join(rng.choice(["a", "Be", " ", "  ", "\n", "\xa0", "\x1c", "é", "1", "'s", ".", "’"]) for _ in range(30)) for _ in range(300)]
    for given in (TEXTS, plain):
        for keep in (tokens.KEPT_PARTS, 0, tokens.KEPT_PARTS):  # from no parts, those met, and those of the last batch
            monkeypatch.setattr(tokens, "KEPT_PARTS", keep)
            got = mine.encode_array(pa.array([x or "" for x in given]))
            assert [np.frombuffer(x, "<u2").tolist() for x in got] == library("byte_bpe_50k.json", given)[0]
            assert len(set(met[-1])) == len(met[-1])
        assert met[-1] == [] and len(mine.parts) == len(mine.codes)  # a part that was met is not encoded again


def test_bpe_equals_the_library(spark):
    ids, t = library("byte_bpe_50k.json")
    rows = docs(spark, *TEXTS).withColumn("ids", F.lit("clash"))
    got = bpe.decode(bpe.encode(rows)).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == ids
    assert [r.text for r in got] == [t.decode(x, skip_special_tokens=False) for x in ids]
    assert bpe.encode(docs(spark).limit(0)).collect() == []
    broken = spark.createDataFrame([(1, np.array(ids[5][:1], "<u4").tobytes()), (2, None)], "doc_id long, ids binary")
    assert [r.text for r in bpe.decode(broken).orderBy("doc_id").collect()] == [t.decode(ids[5][:1]), None]


def test_every_token_alone_and_every_pair_agree():
    vocab = bpe.Vocabulary()
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    words = [" ".join(prose(3, 40)).split(" ")[i] for i in range(20)] + [t.decode([i]) for i in range(300, 5000, 37)]
    for w in (a + b for a in words[20:60] for b in words[40:60]):
        for part in vocab.any_split(w):
            assert np.frombuffer(vocab.word(part), "<u4").tolist() == t.encode(part, add_special_tokens=False).ids


def test_code_of_ranks():
    r = np.random.default_rng(0)
    for n in range(9):
        for top in (200, 70_000, 1 << 30):
            parts = [r.integers(0, top, r.integers(0, 9)).astype(np.uint32) for _ in range(n)]
            counts, flat = np.array([len(x) for x in parts], np.int64), np.concatenate([*parts, np.zeros(0, np.uint32)])
            control, data = token_files.pack_ranks(flat, counts)
            assert token_files.unpack_ranks(counts, b"".join(control), b"".join(data)).tolist() == flat.tolist()


@pytest.mark.parametrize("block", [1, 500, 1 << 16])
def test_token_files_round_trip(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_files, "BLOCK", block)
    monkeypatch.setattr(token_files, "PART_DOCS", 10)
    rows = docs(spark, *TEXTS[::-1]).repartition(5, "text")
    rows = rows.unionByName(spark.createDataFrame([(None, "no id", "", "", 1)], DOCS))
    token_files.write(rows, str(tmp_path / "out"))
    got = token_files.read(spark, str(tmp_path / "out")).orderBy("doc_id").collect()
    ids = [x + [2] for x in library("byte_bpe_50k.json", TEXTS[::-1])[0]]
    assert [np.frombuffer(r.ids, "<u4").tolist() for r in got] == ids
    assert [r.start for r in got] == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    blocks = spark.read.parquet(str(tmp_path / "out" / "blocks"))
    assert blocks.agg(F.sum("size")).first()[0] == sum(map(len, ids))


def test_token_files_of_nothing_and_of_repeated_rows(spark):
    assert token_files.round_trip(docs(spark).limit(0)).collect() == []
    rows = docs(spark, "a b", "c")
    got = token_files.round_trip(rows.unionByName(rows.where("doc_id = 1"))).orderBy("start").collect()
    assert [r.doc_id for r in got] == [1, 1, 2] and got[0].ids == got[1].ids


def places(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for members in by.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= size
    return by


@pytest.mark.parametrize("size", [64, 4096])
def test_packing_keeps_every_id_once(spark, size):
    got = packing.pack(docs(spark, *TEXTS).repartition(4, "text").withColumn("length", F.lit("clash")), size=size).collect()
    ids = [x + [2] for x in library("word_bpe_49k.json")[0]]
    places(got, size)
    for doc, want in enumerate(ids, 1):
        mine = sorted((r for r in got if r.doc_id == doc), key=lambda r: r.start)
        assert [x for r in mine for x in np.frombuffer(r.ids, "<u2").tolist()] == want
        assert [r.start for r in mine] == np.cumsum([0, *(r.length for r in mine)])[:-1].tolist()
        assert {r.doc_tokens for r in mine} == {len(want)}
        assert all(r.ids_crc32 == zlib.crc32(np.frombuffer(r.ids, "<u2").astype("<u4").tobytes()) for r in mine)
    assert packing.pack(docs(spark).limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_patterns_hold_the_histogram(seed):
    r = random.Random(seed)
    histogram = {r.randint(1, 4096): r.randint(1, 3000) for _ in range(400)}
    packs = packing.patterns(histogram)
    held = {}
    for count, lengths in packs:
        assert sum(lengths) <= 4096 and count > 0
        for x in lengths:
            held[x] = held.get(x, 0) + count
    assert held == histogram
    filled = sum(k * n for k, n in histogram.items()) / (4096 * sum(c for c, _ in packs))
    assert filled > 0.9


def test_ids_digest_of_the_query(spark, tmp_path):
    from stayledger.llm.queries import op7_bpe

    docs(spark, *TEXTS[:8]).write.parquet(f"{tmp_path}/documents.parquet")
    ids = library("byte_bpe_50k.json", TEXTS[:8])[0]
    got = op7_bpe(spark, str(tmp_path)).orderBy("doc_id").collect()
    assert [r.ids_sha256 for r in got] == [hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest() for x in ids]
    assert [r.n_tokens for r in got] == [len(x) for x in ids]
