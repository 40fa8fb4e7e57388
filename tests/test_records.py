"""Records and their state against brute force and full evaluation."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cadenza.operators import incremental, records
from cadenza.plans import daily, gold

KEY, ORDER = ["k"], ["d", "i"]


def history(spark, seed, n=160, values=30, keys=("a", "b", None)):
    rng = random.Random(seed)
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 1200)), i, float(rng.randint(0, values))) for i, k in enumerate(rng.choices(keys, k=n))]
    return rows, spark.createDataFrame(rows, "k string, d date, i int, v double")


def wanted(rows):
    out = {}
    for k, d, i, v in rows:
        before = [r for r in rows if r[0] == k and r[1:3] < (d, i)]
        if all(r[3] < v for r in before if r[1].year == d.year):
            near = max(((r[1], r[2]) for r in before if r[3] >= v), default=None)
            out[i] = near and near[1]
    return out


def test_year_records_equal_brute_force(spark):
    for seed, values in ((1, 30), (2, 3), (3, 10**6)):
        rows, df = history(spark, seed, values=values)
        odd = spark.createDataFrame([("a", None, 900, 99.0), ("a", dt.date(2021, 1, 1), 901, None)], df.schema)
        got = records.year_records(df.unionByName(odd), KEY, ORDER, "v", "d").collect()
        assert len(got) == len({r.i for r in got}) and {r.i: r.prior and r.prior.i for r in got} == wanted(rows)
    rising = [("a", dt.date(2020, 1, 1) + dt.timedelta(days=i), i, float(i % 366)) for i in range(900)]
    got = records.year_records(spark.createDataFrame(rising, df.schema), KEY, ORDER, "v", "d").collect()
    assert {r.i: r.prior and r.prior.i for r in got} == wanted(rising)
    assert records.year_records(df.limit(0), KEY, ORDER, "v", "d").isEmpty()


def state_rows(state):
    return sorted(map(str, state.select("k", "d", "i", "v", "state_month").collect()))


def test_a_state_is_small_and_merges(spark):
    rows, df = history(spark, 4, n=400)
    whole = records.fold(df, KEY, ORDER, "v", "d")
    assert whole.count() < 250 and state_rows(records.fold(whole.select(*df.columns), KEY, ORDER, "v", "d")) == state_rows(whole)
    old, new = df.where("i % 3 <> 0"), df.where("i % 3 = 0")  # any split, not only by date
    assert state_rows(records.appended(records.fold(old, KEY, ORDER, "v", "d"), new, KEY, ORDER, "v", "d")) == state_rows(whole)
    start = dt.date(2021, 6, 17)
    changed = df.withColumn("v", F.when(F.col("d") >= F.lit(start), F.col("v") + F.col("i") % 7).otherwise(F.col("v")))
    assert state_rows(records.refolded(whole, changed, start, KEY, ORDER, "v", "d")) == state_rows(records.fold(changed, KEY, ORDER, "v", "d"))


SOURCE = "activity_id long, activity_date date, achievement_type string, metric_name string, duration_seconds int, value double"
FACT = ["previous_best_value", "previous_best_activity_id", "previous_best_date", "days_since_previous_best", "metric_value", "achievement_detail"]


def sources(spark, seed, n=220):
    rng = random.Random(seed)
    rows = [(i, dt.date(2022, 1, 1) + dt.timedelta(days=3 * i + rng.randint(0, 2)), "power_best_effort", "power_watts", rng.choice([5, 60]), float(rng.randint(1, 40))) for i in range(n)]
    return spark.createDataFrame(rows, SOURCE)


def equal(a, b):
    return incremental.compare_facts(a, b, ["activity_achievement_key"], FACT).where("difference <> 'equal'").isEmpty()


def test_an_append_from_the_state_equals_a_full_evaluation(spark, tmp_path):
    everything, none = sources(spark, 5), spark.createDataFrame([], "activity_id long")
    old, facts, state = everything.where("activity_id < 100"), None, None
    for at in (100, 140, 141, 220):
        part = everything.where(f"activity_id < {at}")
        if facts is None:
            facts, state = gold.achievements(part), daily.evaluation_state(part)
        else:
            new = part.join(old, "activity_id", "left_anti")
            ids, plan = new.select("activity_id"), incremental.Plan("latest_append")
            activities = part.select("activity_id", F.col("activity_date").alias("start_date_local"))
            facts = daily.saved(daily.update_achievements(facts, new.select(*part.columns), activities, plan, ids, state), str(tmp_path / f"facts{at}"))
            state = daily.saved(daily.update_state(state, new.select(*part.columns), plan, ids), str(tmp_path / f"state{at}"))
            assert equal(facts, gold.achievements(part))
            assert sorted(map(str, state.collect())) == sorted(map(str, daily.evaluation_state(part).select(*state.columns).collect()))
        old = part
    assert daily.update_state(state, everything, incremental.Plan("no_change"), none) is state


def test_a_closure_from_the_state_reads_from_the_start_s_month_on(spark, tmp_path):
    before = sources(spark, 6)
    start = dt.date(2022, 9, 14)
    after = before.withColumn("value", F.when(F.col("activity_date") >= F.lit(start), F.col("value") + F.col("activity_id") % 5).otherwise(F.col("value")))
    state = daily.saved(daily.evaluation_state(before), str(tmp_path / "state"))
    after.withColumn("month", F.trunc("activity_date", "month").cast("string")).write.partitionBy("month").parquet(str(tmp_path / "after"))
    recent = spark.read.parquet(*(str(p) for p in (tmp_path / "after").glob("month=*") if p.name >= "month=2022-09")).select(*after.columns)
    activities = after.select("activity_id", F.col("activity_date").alias("start_date_local"))
    plan, none = incremental.Plan("historical_closure", start, "BEST_EFFORT_CHANGE"), spark.createDataFrame([], "activity_id long")
    facts = daily.update_achievements(gold.achievements(before), recent, activities, plan, none, state)
    assert equal(facts, gold.achievements(after))
    got = daily.update_state(state, recent, plan, none)
    assert sorted(map(str, got.collect())) == sorted(map(str, daily.evaluation_state(after).select(*got.columns).collect()))
