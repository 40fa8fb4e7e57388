"""Histories in chunks give the rows of histories in one piece; normalised power and as-of joins against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators import chunks as C
from cadenza.operators.windows import best_efforts, normalised_power
from cadenza.plans import gold


def samples(spark, seed=1, hot=400):
    rng = random.Random(seed)
    rows = [(a, i, rng.choice([None, float("nan"), *map(float, range(5)), *map(float, range(5))])) for a, n in (("hot", hot), ("x", 30), ("y", 3), (None, 25)) for i in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "a string, i int, v double")


def test_ranks_follow_the_order(spark):
    df = samples(spark)
    got = C.ranked(df, [F.col("a"), F.col("i")]).orderBy("_rank").collect()
    assert [r._rank for r in got] == list(range(df.count()))
    assert [(r.a, r.i) for r in got] == sorted(((r.a, r.i) for r in got), key=lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert C.ranked(df.limit(0), [F.col("a")]).isEmpty()
    with pytest.raises(ValueError, match="too small"):
        C.with_halo(df, 5, 5)


def test_best_efforts_of_a_long_key_equal_those_in_one_piece(spark):
    df = samples(spark)
    one = {tuple(r) for r in best_efforts(df, "a", ["i"], {"v": "v"}, [1, 2, 7, 20], ["v"]).collect()}
    for longest in (10, 26, 100):
        parts = best_efforts(df, "a", ["i"], {"v": "v"}, [1, 2, 7, 20], ["v"], longest)
        assert {str(tuple(r)) for r in parts.groupBy(*parts.columns).count().drop("count").collect()} == {str(x) for x in one}


def test_normalised_power_equals_brute_force(spark):
    df = samples(spark, 2)
    want = {}
    for a in ("hot", "x", "y", None):
        v = [r.v for r in sorted((r for r in df.collect() if r.a == a), key=lambda r: r.i)]
        v = [None if x != x else x for x in (float("nan") if x is None else x for x in v)]
        rolls = [sum(v[i : i + 3]) / 3 for i in range(len(v) - 2) if None not in v[i : i + 3]]
        good = [x for x in v if x is not None]
        np = (sum(x**4 for x in rolls) / len(rolls)) ** 0.25 if rolls else None
        want[a] = (len(v), len(good), sum(good) / len(good) if good else None, np)
    for longest in (10**6, 27, 3):
        got = normalised_power(df, "a", ["i"], "v", 3, longest).collect()
        assert len(got) == 4
        for r in got:
            n, k, average, np = want[r.a]
            assert (r.samples, r.valid_samples) == (n, k) and r.average == pytest.approx(average) and r.normalised == pytest.approx(np)
            assert r.variability_index == (None if not average or np is None else pytest.approx(np / average))


def test_as_of_joins_equal_brute_force(spark):
    rng = random.Random(3)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60))
    left = [(k, i, day()) for i, k in enumerate(rng.choices(["a", "a", "a", "b", None, "c"], k=200))] + [("a", 900, None), ("a", 901, dt.date(2023, 1, 1))]
    right = [(k, day(), rng.randint(1, 9)) for k in rng.choices(["a", "b", None], k=40)] + [("a", None, 5)]
    lf, rf = spark.createDataFrame(left, "k string, i int, at date"), spark.createDataFrame(right, "k string, since date, w int")
    want = {}
    for k, i, at in left:
        near = [(s, w) for kk, s, w in right if kk == k and s and at and s <= at]
        want[i] = max(near, default=(None, None))
    for longest in (10**6, 20, 1):
        got = C.asof_join(lf, rf, ["k"], "at", "since", ["since", "w"], longest).collect()
        assert len(got) == len(left) and {r.i: (r.since, r.w) for r in got} == want
    assert C.asof_join(lf, rf.limit(0), ["k"], "at", "since", ["w"]).where("w is not null").isEmpty()


def test_power_metrics_and_training_load(spark):
    acts = spark.createDataFrame([(1, dt.date(2024, 1, 5), 3600, 210.0, None), (2, dt.date(2024, 3, 1), 1800, None, 190.0), (3, dt.date(2023, 1, 1), 60, None, None)], "activity_id long, start_date_local date, moving_time_seconds int, average_power_watts double, weighted_average_power_watts double")
    streams = spark.createDataFrame([(1, i, 200) for i in range(40)] + [(2, i, 100 if i % 2 else 300) for i in range(60)] + [(3, i, 100) for i in range(10)], "activity_id long, sample_index int, watts int")
    metrics = gold.activity_power_metrics(acts, streams)
    m = {r.activity_id: r for r in metrics.collect()}
    assert (m[1].normalized_power_watts, m[1].average_power_watts, m[1].work_kilojoules) == (pytest.approx(200), 210, pytest.approx(756))
    assert (m[2].normalized_power_watts, m[2].average_power_watts, m[2].variability_index) == (pytest.approx(200), 200, pytest.approx(1))
    assert m[3].normalized_power_watts is None and m[3].average_power_watts == 100
    ftp = spark.createDataFrame([(dt.date(2024, 1, 1), 200.0), (dt.date(2024, 2, 1), 250.0), (dt.date(2024, 6, 1), 300.0)], "valid_from date, ftp_watts double")
    load = {r.activity_id: r for r in gold.activity_training_load(metrics, ftp).collect()}
    assert (load[1].ftp_watts_used, load[1].intensity_factor, load[1].training_stress_score) == (200, pytest.approx(1), pytest.approx(100))
    assert (load[2].ftp_watts_used, load[2].intensity_factor, load[2].training_stress_score) == (250, pytest.approx(0.8), pytest.approx(32))
    assert load[3].ftp_watts_used is None and load[3].training_stress_score is None
