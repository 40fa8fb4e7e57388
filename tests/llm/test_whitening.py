import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n long, component int, i int, whitened string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3, 4, "w") for i, v in vectors], SCHEMA)


def brute(vectors, components=4):
    """(n, {vec_id: (deviation, whitened rows)}, explained), by exact covariances and a double-precision solve."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) and abs(c) < 2**32 for c in v)]
    width = max(len(v) for _, v in kept)
    xs = [(i, tuple([math.floor(256 * float(np.float32(c))) for c in v] + [0] * (width - len(v)))) for i, v in kept]
    fit = list({x for _, x in xs})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = [[n * c - s for c, s in zip(x, sums)] for x in fit]
    cov = np.array([[float(Fraction(sum(y[i] * y[j] for y in centred), n**3)) for j in range(width)] for i in range(width)])
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1][:components], vecs[:, ::-1][:, :components]
    out = []
    for i, x in xs:
        y = np.array([float(Fraction(n * c - s, n)) for c, s in zip(x, sums)])
        out.append((i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), y @ vecs / np.sqrt(values)))
    return n, out, values / np.trace(cov)


def check(spark, vectors):
    n, want, explained = brute(vectors)
    k = len(explained)
    got = W.whiten(frame(spark, vectors)).collect()
    assert len(got) == len(want) * k and {r.n for r in got} == {n}
    rows = {}
    for r in got:
        rows.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9) and r.identity_error < 1e-9
    sign = {}
    for i, deviation, y in want:
        for c in range(1, k + 1):
            for r in rows[i][c]:
                assert r.deviation == (deviation if deviation < 2**63 else None)
                if abs(y[c - 1]) > 1e-3:
                    sign.setdefault(c, np.sign(r.whitened * y[c - 1]))
                assert r.whitened == pytest.approx(sign.get(c, 1) * y[c - 1], rel=1e-6, abs=1e-7)


def test_rows_are_those_of_brute_force(spark):
    rng = np.random.default_rng(1)
    data = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 0.2 + 3).astype(np.float32)
    vectors = [(i, v.tolist()) for i, v in enumerate(data)]
    vectors += [(1000 + i, data[7].tolist()) for i in range(150)]  # a third are copies
    vectors += [(5, data[5].tolist()), (None, data[6].tolist())]
    bad = [None, [None] * 12, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1e30] + [0.0] * 11]
    vectors += [(2000 + i, v) for i, v in enumerate(bad)]
    vectors += [(3000, data[8].tolist()[:5]), (3001, [])]
    check(spark, vectors)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(2)
    check(spark, [(i, v.tolist()) for i, v in enumerate((rng.normal(size=(40, 3)) * [1e6, 1e3, 1] + [3e6, 0, 5]).astype(np.float32))])


def test_degenerate_tables(spark):
    def rows(vectors):
        return W.whiten(frame(spark, vectors)).orderBy("vec_id", "component").collect()

    assert rows([]) == [] and rows([(1, None), (2, [])]) == []
    one = rows([(1, [0.5, 1.5]), (2, [0.5, 1.5])])
    assert [(r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(i, c, 1, 0, None, None, None) for i in (1, 2) for c in (1, 2)]
    line = rows([(i, [float(i), 2.0, 0.0]) for i in range(5)])
    assert [r.component for r in line[:3]] == [1, 2, 3] and all((r.whitened is None) == (r.component > 1) for r in line)
    assert [abs(round(r.whitened, 6)) for r in line if r.component == 1] == [1.414214, 0.707107, 0, 0.707107, 1.414214]
    assert {r.identity_error < 1e-12 for r in line} == {True}


def residuals(a, values, x):
    return float(np.abs(a @ x - x * values).max() / np.abs(a).max()), float(np.abs(x.T @ x - np.eye(len(a))).max())


@pytest.mark.parametrize("gap", [1e-3, 1e-6, 1e-9, 1e-12, 0.0])
def test_clusters_are_parted(gap):
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(24, 24)))[0].astype(W.PRECISE)
    for _ in range(3):  # orthogonal in extended precision
        q = q @ (1.5 * np.eye(24, dtype=W.PRECISE) - 0.5 * (q.T @ q))
    want = np.array([5, 5 - gap, 5 - 2 * gap, 2] + [1 / (i + 1) for i in range(20)], W.PRECISE)
    a = (q * want) @ q.T
    a = (a + a.T) / 2
    values, x = W.eigen(a)
    assert np.abs(values - np.sort(want)[::-1]).max() < 1e-17
    assert max(residuals(a, values, x)) < 1e-16
    if gap:  # the true vectors, which neither a single- nor a double-precision solve can tell apart at the smaller gaps
        assert np.abs(np.abs(np.sum(x[:, :3] * q[:, :3], axis=0)) - 1).max() < 1e-6


def test_every_step_is_needed(monkeypatch):
    rng = np.random.default_rng(4)
    m = rng.normal(size=(200, 16))
    a = (m.T @ m).astype(W.PRECISE)
    single = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1].astype(W.PRECISE)
    assert residuals(a, np.sum(single * (a @ single), axis=0), single)[0] > 1e-9
    assert max(residuals(a, *W.eigen(a))) < 1e-16
    q = np.linalg.qr(rng.normal(size=(8, 8)))[0]
    near = ((q * [1, 1 - 1e-10, 1 - 2e-10, 0.5, 0.4, 0.3, 0.2, 0.1]) @ q.T).astype(W.PRECISE)
    near = (near + near.T) / 2
    assert residuals(near, *W.eigen(near, 4))[0] < 1e-17
    monkeypatch.setattr(W, "parted", lambda a, x, group: x[:, group])
    assert residuals(near, *W.eigen(near, 4))[0] > 1e-13


def test_products_are_exact():
    rng = np.random.default_rng(5)
    y = np.concatenate((rng.integers(-(2**41), 2**41, (30, 4)), rng.integers(-5, 5, (30, 4)), [[2**41] * 4, [-(2**41)] * 4]))
    assert W.exact_products(y) == [[sum(int(r[i]) * int(r[j]) for r in y) for j in range(4)] for i in range(4)]
    assert W.matrix(pa.array([[9], [1, 2], [], [3]]).slice(1), 3).tolist() == [[1, 2, 0], [0, 0, 0], [3, 0, 0]]


def test_the_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    n, want, explained = brute([(r.vec_id, r.embedding) for r in rows])
    got = {(r.vec_id, r.component): r for r in W.op12_whitening(spark, folder).collect()}
    assert len(got) == 4 * len(want)
    signs = {c: np.sign(sum(got[i, c].whitened * y[c - 1] for i, _, y in want)) for c in range(1, 5)}
    for i, deviation, y in want:
        for c in range(1, 5):
            r = got[i, c]
            assert (r.n, r.deviation) == (n, deviation) and abs(r.whitened - signs[c] * y[c - 1]) < 1e-9
            assert abs(r.explained - explained[c - 1]) < 1e-12 and r.identity_error < 1e-12
    assert W.whiten(spark.read.parquet(f"{folder}/embeddings.parquet").where(F.lit(False))).isEmpty()
