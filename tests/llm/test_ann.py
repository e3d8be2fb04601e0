import numpy as np
import pytest
from pyspark.sql import functions as F

from starfold.llm import ann

SCHEMA = "vec_id long, embedding array<double>, score double, rank int, v string, shard int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, None, None, None) for i, v in rows], SCHEMA)


def brute(rows, query_id, k):
    vectors = {i: np.array(v, float) for i, v in rows}
    q = vectors.pop(query_id)
    scored = sorted((-float((x * q).sum()), i) for i, x in vectors.items())
    return [(i, -s) for s, i in scored[:k]]


def by_query(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("norms", [False, True])
def test_recall_and_exact_scores(spark, norms):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 48))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= rng.lognormal(0, 0.4, (1500, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = by_query(ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 10, shard_rows=400, block_rows=30))
    assert set(found) == set(range(0, 1500, 20))
    hits = 0
    for query_id, got in found.items():
        best = brute(rows, query_id, 10)
        hits += len({i for i, _ in best} & {i for i, _ in got})
        exact = dict(brute(rows, query_id, 1500))
        assert all(exact[i] == s for i, s in got)
        assert got == sorted(got, key=lambda r: (-r[1], r[0]))
    assert hits / (10 * len(found)) >= 0.9


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    codes[1::2] = codes[::2] ^ np.packbits(rng.random((250, 128)) < 0.15, axis=1)
    index = ann.Index(codes)
    for radius in (0, 5, 17, 18, 33, 50):
        for code in codes[::25]:
            apart = np.bitwise_count(codes ^ code).sum(axis=1)
            rows, near = index.within(code, radius)
            assert rows.tolist() == np.flatnonzero(apart <= radius).tolist()
            assert near.tolist() == apart[rows].tolist()


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (5, [-1.0, 0.0]), (3, [0.0, 2.0]),
        (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (7, [None, 1.0]), (9, []),
        (100, [1.0, 1.0, 1.0]), (None, [1.0, 1.0]),
    ]
    found = by_query(ann.search(frame(spark, rows), F.col("vec_id") % 20 == 0, 20))
    assert found == {0: [(1, 1.0), (2, 1.0), (3, 0.0), (3, 0.0), (5, -1.0)]}
    assert ann.search(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(frame(spark, [(0, [1.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(frame(spark, [(1, [1.0]), (2, [1.0])]), F.lit(False)).count() == 0


def test_a_vector_that_a_third_of_the_rows_have(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [1.0, 0.5, 0.0, 0.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)]
    found = by_query(ann.search(frame(spark, rows), F.col("vec_id") == 0, 20, shard_rows=100))
    assert found[0] == brute(rows, 0, 20)


def test_large_finite_vectors_take_part(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(400)] + [(1000, [1e200] + [0.0] * 7), (1001, [1e-200] + [0.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(df, F.col("vec_id").isin(0, 20, 1001), k=5)
    first = {r.query_id: r.vec_id for r in found.where("rank = 1").collect()}
    for query in (0, 20, 1001):
        own = dict(rows)[query]
        assert (first[query] == 1000) == (own[0] > 0)
    again = ann.search(df.repartition(7), F.col("vec_id").isin(0, 20, 1001), k=5)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))
