import math
import random

import numpy as np
from pyspark.sql import functions as F

from cadenza.llm import topk as T

SCHEMA = "vec_id long, embedding array<float>, label int, block long, n int, ids string, score long"


def brute(vectors, wanted, k=5):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if wanted(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_equals_brute_force(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(16)]) for i in range(300)]
    vectors += [(400 + i, vectors[0][1]) for i in range(8)]  # ties
    vectors += [(500, None), (501, [0.1, None]), (502, [float("nan")] * 16), (503, [float("inf")] * 16), (None, [1.0] * 16), (504, []), (505, [0.5]), (506, [0.0] * 16), (507, [1e6] * 16)]
    df = spark.createDataFrame([(i, v, 0, 1, 2, "3", 4) for i, v in vectors], SCHEMA)
    got = sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") % 25 == 0).select("query_id", "rank", "vec_id", "score").collect())
    assert got == brute(vectors, lambda i: i % 25 == 0)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") == 0).collect()) == [(0, 1, 1, 256 * 128), (0, 2, 2, -256 * 256)]
    assert T.top_k(df.limit(0), F.col("vec_id") == 0).isEmpty()


def members_of(q, x, known=None):
    nobody = np.zeros((len(q), len(x)), bool)
    return T.search(q, x, T.segments(x), nobody, 5, np.full(len(q), -np.inf) if known is None else known)


def test_reading_stops_on_proof_only():
    rng = np.random.default_rng(1)
    x = rng.integers(-200, 200, (2000, 32))
    q = rng.integers(-200, 200, (5, 32))
    spiky = np.where(rng.random((2000, 32)) < 0.02, x * 50, x // 50)
    close = np.concatenate((x, np.repeat(q, 5, axis=0) + rng.integers(-3, 3, (25, 32))))  # each query has five that are far ahead
    for vectors, most in ((x, 4), (spiky, 4), (close, 3)):
        found, read = members_of(q, vectors)
        assert read <= most
        for i, (members, scores) in enumerate(found):
            true = vectors @ q[i]
            best = np.lexsort((np.arange(len(vectors)), -true))[:5]
            assert set(best) <= set(members) and (scores == true[members]).all() and len(members) < 2000


def test_a_known_score_spares_reading():
    rng = np.random.default_rng(2)
    x, q = rng.integers(-20, 20, (500, 32)), rng.integers(-200, 200, (5, 32))
    found, read = members_of(q, x, np.full(5, 1e9))
    assert read == 0 and not any(len(m) for m, _ in found)


def test_segments_hold_all_values_by_impact():
    x = np.random.default_rng(3).integers(-9, 9, (40, 6))
    postings, ends, unread = T.segments(x)
    assert sorted(postings.tolist()) == np.flatnonzero(x).tolist() and ends[-1] == len(postings)
    size, starts = np.abs(x).ravel(), [0, *ends[:-1]]
    assert all(size[postings[s:e]].min(initial=99) >= size[postings[e:]].max(initial=0) for s, e in zip(starts, ends))
    for i, s in enumerate([*starts, ends[-1]]):
        rest = np.zeros(x.size)
        rest[postings[s:]] = x.ravel()[postings[s:]]
        true = np.sqrt((rest.reshape(x.shape) ** 2).sum(axis=1))
        assert (unread[i] >= true).all() and np.allclose(unread[i], true, rtol=1e-4)
    assert T.segments(np.zeros((3, 4), np.int64))[0].size == 0


def test_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "ROWS", 16)
    monkeypatch.setattr(T, "QUERIES", 7)
    monkeypatch.setattr(T, "REMEMBERED", 2)
    rng = random.Random(4)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(rng.choice((3, 8)))]) for i in range(200)] + [(300 + i, [0.25] * 8) for i in range(20)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in T.top_k(df, F.col("vec_id") % 5 == 0).select("query_id", "rank", "vec_id", "score").collect())
    pad = [(i, v + [0.0] * (8 - len(v))) for i, v in vectors]
    assert got == brute(pad, lambda i: i % 5 == 0)


def test_components_and_scores_beyond_a_long_count_as_the_largest(spark):
    rows = [(5, [1e30, 1.0]), (10, [1e30, 2.0]), (1, [-1e30, 0.0]), (2, [1e-3, 1.0]), (3, [1e300, -1e300]), (4, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    top = (1 << 63) - 1
    whole = {i: [max(-top, min(top, math.floor(256 * c))) for c in v] for i, v in rows if i != 4}
    want = []
    for q in (5, 10):
        scores = {i: max(-top, min(top, sum(a * b for a, b in zip(whole[q], v)))) for i, v in whole.items() if i != q}
        want += [(q, rank, i, scores[i]) for rank, i in enumerate(sorted(scores, key=lambda i: (-scores[i], i)), 1)]
    got = T.top_k(df, F.col("vec_id") % 5 == 0).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == want
