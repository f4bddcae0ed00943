import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import alignment
from stayledger.llm.alignment import align, cuts, fragment, groups, links, part, sides
from stayledger.llm.queries import op11_alignment
from tests.llm.helpers import DOCS, docs, prose

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(P.path(A))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=P.path(B))


def expected(rows, libraries) -> Counter:
    """Rows by brute force over whole texts."""
    a_lib, b_lib = libraries
    side = sides(A, B)
    docs_, pairs_of = [], []
    for doc, text in rows:
        text = text or ""
        a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
        whole = (" " + text).encode()
        if not text or b"".join(side.a_bytes[i] for i in a) != whole or b"".join(side.b_bytes[i] for i in b) != whole:
            a, b = [], []
        spans = []
        for ids, table in ((a, side.a_bytes), (b, side.b_bytes)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(table[i]), i))
                at += len(table[i])
            spans.append(own)
        found, j = [], 0
        for low, high, x in spans[0]:
            while spans[1][j][1] <= low:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < high:
                found.append((x, spans[1][k][2]))
                k += 1
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        written, low = [], 0
        for e in ends:
            written.append("|".join(",".join(str(i) for s, t, i in own if low <= s and t <= e) for own in spans)
                           if len(whole) < 3000 else None)
            low = e
        docs_.append((doc, len(a), len(b), len(ends), written))
        pairs_of.append(Counter(found))
    count = Counter(p for own in pairs_of for p in own)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return Counter(
        (doc, n_a, n_b, n, own.total(), sum(k for p, k in own.items() if count[p] == most[p[0]]),
         sum(k * count[p] for p, k in own.items()), hashlib.sha256(";".join(written).encode()).hexdigest() if written else "")
        for (doc, n_a, n_b, n, written), own in zip(docs_, pairs_of))


HARD = ["", None, " ", "a", "  a  b ", "a \n b", "x" * 900, "tab\there  \n\n  more", "日本語のテキスト 日本", "▁ sign", "<|endoftext|> it's <s> </s>",
        "naïve café ﬁ", "1 234,567 .89", "\r\n\x85 \xa0 x", "\x00 null", "emoji 👩‍👩‍👧 x", "a" + " " * 40 + "b", "end  ", "'s 't it 's", "<0x41> A"]


def rows_of(df) -> Counter:
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def test_pieces_have_the_ids_of_whole_texts(libraries):
    rng = random.Random(3)
    texts = [t for t in HARD if t] + ["".join(rng.choice(["a", "the", " ", "  ", "\n", "\t", ".", "é", "'s", "12", "日", "<s>", "\xa0", "▁"])
                                              for _ in range(60)) for _ in range(400)]
    a, b = sides(A, B).encode([" " + t for t in texts])
    for t, x, y in zip(texts, a, b):
        assert x.tolist() == libraries[0].encode(" " + t, add_special_tokens=False).ids
        if "▁" not in t:  # such texts have no tokens in the result
            assert y.tolist() == libraries[1].encode(t)


def test_equals_brute_force_for_any_ranges(spark, libraries):
    rows = list(enumerate(HARD + [prose(k, 40) for k in range(6)] + [prose(1, 40)] * 5 + ["word " * 200]))
    want = expected(rows, libraries)
    given = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    for chunk, fan in ((1 << 16, 16), (7, 2), (50, 3)):
        assert rows_of(align(given, chunk=chunk, fan=fan)) == want


def test_small_buckets_and_copies(spark, libraries, monkeypatch):
    rows = [(k, prose(k, 60)) for k in range(12)]
    for name, value in (("PAIRS", 64), ("LINKS", 100), ("BLOCK", 8), ("COUNTED", 200), ("AT_ONCE", 300)):
        monkeypatch.setattr(alignment, name, value)
    assert rows_of(align(docs(spark, *[t for _, t in rows], first=0), chunk=100, fan=2)) == expected(rows, libraries)


def test_composition_is_associative():
    side = sides(A, B)
    text = " " + prose(8, 50) + " 日本語 " + "x" * 90
    x, y = (ids[0] for ids in side.encode([text]))
    t = x, np.cumsum(side.a_size[x]), y, np.cumsum(side.b_size[y])
    want = b"".join(groups(t, cuts(t), side))[:-1]
    n = -(-len(text.encode()) // 5)
    pieces = [fragment(part(t, 5 * c, 5 * c + 5), c, side) for c in range(n)]
    rng = random.Random(4)
    for _ in range(5):
        own = list(pieces)
        while len(own) > 1:
            k = rng.randrange(len(own) - 1)
            own[k:k + 2] = [own[k].then(own[k + 1], side)]
        total = own[0].whole(side)
        assert b";".join(w for _, w in sorted(total.texts)) == want
        assert total.n_links == len(links(t, len(side.b_bytes))) == total.times.sum() and total.n_groups == len(cuts(t))


def test_null_ids_repeats_other_columns_and_no_rows(spark, libraries):
    rows = [(None, "one two"), (None, "one two"), (4, "one two"), (4, "two"), (5, None)]
    given = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)
    clash = given.withColumns({c: F.lit("x") for c in ("row", "kind", "pairs", "chunk", "bucket")})
    assert rows_of(align(clash)) == expected(rows, libraries)
    assert align(given.limit(0)).collect() == []


def test_query_on_the_given_documents(spark, libraries):
    d = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in op11_alignment(spark, d).collect()}
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert set(got) == {i for i, _ in given}
    for i, text in given:
        if text:
            ids = libraries[0].encode(" " + text, add_special_tokens=False).ids
            assert got[i].n_a == len(ids) and got[i].n_b == len(libraries[1].encode(text))
            assert got[i].n_links == got[i].n_a + got[i].n_b - got[i].n_groups


def test_tokens_are_held_against_the_bytes_of_the_text():
    own = alignment.sides("byte_bpe_50k.json", "piece_bpe_32k.model")
    for text in (" a b.c  d\n", " é日本 😀 x", " " + "word " * 300):
        (a,), (b,) = own.encode([text])
        data = text.encode()
        want = [b"".join(map(t.__getitem__, x.tolist())) == data for t, x in ((own.a_bytes, a), (own.b_bytes, b))]
        assert own.gives(a, b, data) == all(want)
        assert not own.gives(a, b, data[:-1] + b"!") and not own.gives(a[:-1], b, data) and not own.gives(a, b, data + b"x")
