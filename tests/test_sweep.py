"""The sweep over samples and intervals returns the rows of a plain join, whatever the sizes of its parts."""

import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators.chunks import ranked, running_count
from cadenza.operators.joins import interval_join
from cadenza.operators.sweep import sweep_join

SAMPLES, INTERVALS = "k string, t long, v int", "k string, a long, b long, name string"


def sides(spark, seed=3):
    rng = random.Random(seed)
    keys = ["hot"] * 6 + ["x", "y", None]
    samples = [(rng.choice(keys), rng.choice([None, *range(60)]), i % 50) for i in range(400)]
    spans = [(rng.choice([*keys, "absent"]), a := rng.choice([None, *range(-5, 65)]), rng.choice([None, (a or 0) - 3, *((a or 0) + n for n in (0, 1, 1, 2, 5, 80))]), f"i{i % 40}") for i in range(150)]
    return spark.createDataFrame(samples + samples[:20], SAMPLES), spark.createDataFrame(spans + spans[:10], INTERVALS)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("piece, longest, crowd", [(1, 7, 2), (4, 50, 3), (64, 10_000, 1_000_000)])
def test_sweep_equals_the_plain_join(spark, piece, longest, crowd):
    samples, intervals = sides(spark)
    got = sweep_join(samples, intervals, "k", "t", "a", "b", piece, longest, crowd)
    plain = interval_join(samples, intervals, "k", "t", "a", "b")
    assert got.columns == plain.columns
    assert rows(got) == rows(plain) and got.count() > 500


def test_sweep_of_other_types_and_empty_sides(spark):
    samples, intervals = sides(spark, 4)
    halves = intervals.select("k", (F.col("a") + 0.5).alias("a"), (F.col("b") + 0.5).alias("b"), "name")
    assert rows(sweep_join(samples, halves, "k", "t", "a", "b", 4)) == rows(interval_join(samples, halves, "k", "t", "a", "b"))
    assert sweep_join(samples.limit(0), intervals, "k", "t", "a", "b").isEmpty()
    assert sweep_join(samples, intervals.limit(0), "k", "t", "a", "b").isEmpty()
    with pytest.raises(ValueError, match="both sides"):
        sweep_join(samples, intervals.withColumn("v", F.lit(1)), "k", "t", "a", "b")


def test_a_long_interval_is_repeated_by_what_it_holds_not_by_its_length(spark):
    samples = spark.createDataFrame([("x", t, 0) for t in (0, 10**12, 2 * 10**12)], SAMPLES)
    intervals = spark.createDataFrame([("x", 0, 10**15, "long"), ("x", 1, 10**12, "none"), ("x", 10**12, 10**12 + 1, "one")], INTERVALS)
    assert [(r.t, r.name) for r in sweep_join(samples, intervals, "k", "t", "a", "b", 1).orderBy("name", "t").collect()] == [(0, "long"), (10**12, "long"), (2 * 10**12, "long"), (10**12, "one")]


def test_running_count_over_chunks(spark):
    df = ranked(spark.range(50), [F.col("id")])
    got = running_count(df, F.col("id") % 3 == 0, "n", 7).orderBy("id").collect()
    assert [r.n for r in got] == [i // 3 + 1 for i in range(50)]
