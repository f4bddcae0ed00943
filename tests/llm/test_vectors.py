import numpy as np
import pytest
from pyspark.sql import functions as F

from stayledger.llm import curve_search, exact_topk
from stayledger.llm.common import table

VECTORS = "vec_id long, embedding array<float>, label int"


def ranked(ids, score, own, k):
    order = [j for j in np.lexsort((ids, -score)) if ids[j] != own][:k]
    return [(int(ids[j]), score[j]) for j in order]


def by_query(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def sample(spark, n=700, width=20, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width)).astype(np.float32)
    x[100:160] = x[100]  # copies, so ties
    x[200:230] = -x[100]
    return x, spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)


def test_exact_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(exact_topk, "CHUNK", 64)
    monkeypatch.setattr(exact_topk, "QUERIES", 5)
    x, df = sample(spark)
    z, ids = np.floor(1024 * x.astype(np.float64)).astype(np.int64), np.arange(len(x))
    got = by_query(exact_topk.exact_top_k(df.withColumn("v", F.lit("clash")), every=20).collect())
    assert got == {q: ranked(ids, z @ z[q], q, 10) for q in range(0, len(x), 20)}


def test_bounds_drop_candidates_but_no_results():
    rng = np.random.default_rng(1)
    columns = rng.integers(-1000, 1000, (64, 500))
    columns[:, :20] *= 5
    rest = exact_topk._rests(columns)
    for _ in range(20):
        query = rng.integers(-1000, 1000, 64)
        alive, score = exact_topk.bounded_search(columns, rest, query, 10)
        full = query @ columns
        assert set(np.argsort(-full, kind="stable")[:10]) <= set(alive.tolist())
        assert (score == full[alive]).all()


ODD = [(0, [1.0, 0.0]), (20, [0.5, None]), (40, [float("nan"), 1.0]), (60, [float("inf"), 1.0]), (80, None), (100, []),
       (None, [1.0, 1.0]), (1, [2.0, 0.0]), (2, [0.0, 0.0]), (3, [3.0]), (4, [-1.0, 5.0, 7.0]), (5, [2.0, 0.0]), (5, [2.0, 0.0]),
       (6, [9.0, 9.0]), (6, [1.0, 1.0])]


def test_unusable_vectors_take_no_part(spark):
    df = spark.createDataFrame([(i, v, 0) for i, v in ODD], VECTORS)
    got = by_query(exact_topk.exact_top_k(df, every=20).collect())
    assert got == {0: [(3, 3 * 2**20), (1, 2**21), (5, 2**21), (6, 2**20), (2, 0), (4, -(2**20))]}
    near = by_query(curve_search.neighbours(df, every=20).collect())
    assert near == {0: [(3, 3.0), (1, 2.0), (5, 2.0), (6, 1.0), (4, -1.0)]}
    for f in (exact_topk.exact_top_k, curve_search.neighbours):
        assert f(df.limit(0)).collect() == []
        assert f(df.where("vec_id = 0")).collect() == []
        assert f(df.where("vec_id in (1, 2, 3)")).collect() == []


def test_hilbert_curve_visits_every_cell_in_steps_of_one():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        key = curve_search.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("small_chunks", [False, True])
def test_recall_and_order_of_neighbours(spark, monkeypatch, small_chunks):
    if small_chunks:
        monkeypatch.setattr(curve_search, "CHUNK", 10)
        monkeypatch.setattr(curve_search, "QUERIES", 1)
    x, df = sample(spark)
    x, ids = x.astype(np.float64), np.arange(len(x))
    got = by_query(curve_search.neighbours(df).collect())
    assert set(got) == set(range(0, len(x), 20))
    hits = total = 0
    for q, found in got.items():
        score = x @ x[q]
        assert len(found) == 20 and all(score[v] == pytest.approx(s, abs=1e-12) for v, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits += len({v for v, _ in found} & {v for v, _ in ranked(ids, score, q, 20)})
        total += 20
    assert hits / total >= 0.9
    copies = set(range(100, 160))
    assert [v for v, _ in got[100]] == sorted(copies - {100})[:20]  # the smallest ids of equal vectors


def test_recall_on_the_given_table(spark):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = df.toPandas()
    x, ids = np.stack(rows.embedding.values).astype(np.float64), rows.vec_id.values
    got = by_query(curve_search.neighbours(df).collect())
    at = {v: i for i, v in enumerate(ids.tolist())}
    recall = [len({v for v, _ in found} & {v for v, _ in ranked(ids, x @ x[at[q]], q, 20)}) / 20 for q, found in got.items()]
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("kind", ["binary", "norms"])
def test_ties_and_unequal_norms(spark, kind):
    rng = np.random.default_rng(4)
    x = (rng.random((2500, 16)) < 0.5).astype(np.float32) if kind == "binary" else (
        rng.standard_normal((2500, 16)) * rng.lognormal(0, 0.7, (2500, 1))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS)
    got = by_query(curve_search.neighbours(df).collect())
    z, ids, hits = x.astype(np.float64), np.arange(len(x)), 0
    asked = [q for q in range(0, len(x), 20) if x[q].any()]
    for q in asked:
        usable = np.where(x.any(axis=1), z @ z[q], -np.inf)
        want = ranked(ids, usable, q, 20)
        hits += len({i for i, _ in want} & {i for i, _ in got[q]})
    assert hits / (20 * len(asked)) >= 0.9
