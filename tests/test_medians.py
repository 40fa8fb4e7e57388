"""Running medians in pieces equal brute force, whatever the length of a key and the ties in it."""

import math
import random
import statistics

import numpy as np
import pytest

from cadenza.operators import medians as M


def brute(rows):
    """{id: (prior, median)} of (key, id, value)."""
    want, held = {}, {}
    for k, i, v in sorted(rows, key=lambda r: r[1]):
        before = held.setdefault(k, [])
        want[i] = (len(before), statistics.median(before) if before else None)
        if v is not None:
            before.append(math.inf if v != v else v)
    return want


def test_kth_equals_sorting():
    rng = np.random.default_rng(1)
    for size in (1, 2, 7, 64):
        own, base = rng.integers(0, size, 50), rng.integers(0, 3, size)
        base[0] += 1
        before = rng.integers(0, 51, 200)
        k = np.array([rng.integers(0, base.sum() + b) for b in before])
        every = np.repeat(np.arange(size), base)
        assert M.kth(own, base, before, k).tolist() == [int(np.sort(np.concatenate((every, own[:b])))[x]) for b, x in zip(before, k)]


@pytest.mark.parametrize("kind", ["many", "ties", "rising", "falling", "nulls", "same"])
def test_medians_of_long_keys_equal_brute_force(spark, kind):
    rng = random.Random(kind)
    value = {
        "many": lambda i: rng.gauss(0, 100),
        "ties": lambda i: float(rng.choice([1, 2, 3, 5, 60])),
        "rising": lambda i: float(i),
        "falling": lambda i: float(-i),
        "nulls": lambda i: None if i % 300 < 200 else rng.choice([math.nan, None, rng.random()]),
        "same": lambda i: 7.0,
    }[kind]
    keys = ["hot"] * 700 + ["warm"] * 150 + [None] * 90 + [f"k{i % 20}" for i in range(60)]
    rng.shuffle(keys)
    rows = [(k, i, value(i)) for i, k in enumerate(keys)]
    want = brute(rows)
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(5)
    for longest in (10, 64, 10_000):
        got = M.running_median(df, ["k"], ["i"], "v", longest)
        assert got.columns == ["k", "i", "v", "prior", "prior_median"]
        got = got.collect()
        assert len(got) == len(rows)
        assert {r.i: (r.prior, r.prior_median) for r in got} == want


def test_empty_tables_and_other_columns(spark):
    df = spark.createDataFrame([(1, 2, 1, 3), (1, 2, 2, 5), (1, None, 3, 4)], "a int, b int, at int, v int")
    assert M.running_median(df.limit(0), ["a"], ["at"], "v").isEmpty()
    for longest in (1, 100):
        got = {r.at: (r.prior, r.prior_median) for r in M.running_median(df, ["a", "b"], ["at"], "v", longest).collect()}
        assert got == {1: (0, None), 2: (1, 3.0), 3: (0, None)}


def test_a_chunk_gets_a_band_and_not_the_history(spark):
    """Values without and with ties: what comes to a chunk follows its own length, not the key's."""
    rng = random.Random(5)
    for draw in (rng.random, lambda: float(rng.randrange(300))):
        df = spark.createDataFrame([("k", i, i // 50, draw()) for i in range(3000)], "_key string, _rank long, _chunk long, _v double")
        sizes = {r._chunk: r["count"] for r in M._bands(df, 50).groupBy("_chunk").count().collect()}
        assert set(sizes) == set(range(1, 60)) and max(sizes.values()) <= 4 * 50 + 3
