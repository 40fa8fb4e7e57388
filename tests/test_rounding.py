"""Rounded columns of the queries against DuckDB's round."""

import math
import random

import duckdb

import __spark_entry__ as entry
from cadenza.queries import rounded

VALUES = [80.83, 18.11, 17.78, 102.75, 63.96, 11.05, 9.91, 29.92, 32.45, 113.24]


def test_a_rate_a_hair_below_a_half_is_rounded_as_its_sql_does(spark, tmp_path):
    """The values add up to 480.00000000000006, the last rate is 112233.81874999999; its product with 10,000 is a half. That of 0.00015 is not."""
    ids = [*range(5387000, 5387009), 53872233 - sum(range(5387000, 5387009))]
    rows = [(1, i, v) for i, v in zip(ids, VALUES)] + [(2, 3, 20000.0)]
    spark.createDataFrame(rows, "user_id long, event_id long, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    want = con.sql(entry.oracle_sql()["rolling_throughput"]).fetchall()
    got = [tuple(x) for x in entry.queries()["rolling_throughput"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)
    assert {(1, ids[-1], 112233.8188), (2, 3, 0.0001)} <= set(got)


def test_rounded_is_duckdbs_round(spark):
    rng = random.Random(3)
    halves = [s * (rng.randrange(10 ** rng.randint(1, 12)) + 0.5) / 10**d for d in (2, 4, 6) for s in (1, -1) for _ in range(300)]
    near = [math.nextafter(x, to) for x in halves for to in (-math.inf, math.inf)]
    odd = [0.0, -0.0, 0.00001, -0.00001, 0.49999999999999994, 2.0**52 + 1, 1e15 + 0.3, 1e300, -1.7e308, 5e-324, math.inf, -math.inf, math.nan, None]
    values = halves + near + odd + [rng.uniform(-1e7, 1e7) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, x double")
    shown = {r.i: r[1:] for r in df.select("i", *(rounded("x", d).cast("string").alias(f"r{d}") for d in (2, 4, 6))).collect()}
    con = duckdb.connect()
    for i, x in enumerate(values):
        want = con.execute("SELECT round(x, 2), round(x, 4), round(x, 6) FROM (SELECT CAST(? AS DOUBLE) AS x)", [x]).fetchone()
        got = tuple(None if t is None else float(t.replace("Infinity", "inf")) for t in shown[i])
        assert [str(v) for v in got] == [str(v) for v in want], x
