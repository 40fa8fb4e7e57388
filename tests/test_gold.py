"""Golden cases of best efforts and records, and both against brute force."""

import datetime as dt
import random

from pyspark.sql import functions as F

from cadenza.operators import incremental
from cadenza.operators.windows import best_efforts, latest_prior_ge, running_records
from cadenza.plans import daily, gold

SAMPLE = "activity_id long, sample_index int, time_seconds int, distance_metres double, latitude double, longitude double, watts int, cadence_rpm int, heartrate_bpm int"


def samples(spark, watts, activity=1):
    return spark.createDataFrame([(activity, i, i - 1, 10.0 * (i - 1), 53.1, -2.8, w, None, None) for i, w in enumerate(watts, 1)], SAMPLE)


def test_best_effort_has_provenance(spark):
    row = best_efforts(samples(spark, [100, 200, 300, 400, 100, 100]), "activity_id", ["sample_index"], {"watts": "watts"}, [3], list(gold.PROVENANCE)).collect()
    assert len(row) == 1
    assert (row[0].peak_value, row[0].start_sample_index, row[0].end_sample_index, row[0].sample_count) == (300, 2, 4, 3)
    assert (row[0].start_time_seconds, row[0].end_distance_metres, row[0].start_latitude) == (1, 30.0, 53.1)


def test_a_window_with_a_null_does_not_count(spark):
    row = best_efforts(samples(spark, [100, None, 300, 400]), "activity_id", ["sample_index"], {"watts": "watts"}, [2]).first()
    assert (row.peak_value, row.start_sample_index) == (350, 3)
    assert best_efforts(samples(spark, [None, None]), "activity_id", ["sample_index"], {"watts": "watts"}, [2]).isEmpty()
    assert best_efforts(samples(spark, [1, 2]), "activity_id", ["sample_index"], {"watts": "watts"}, [3]).isEmpty()


def test_best_efforts_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(a, i, rng.choice([None, *range(0, 9)])) for a in range(6) for i in range(rng.randint(0, 40))]
    found = {(r.a, r.duration_seconds): (r.peak_value, r.start_i) for r in best_efforts(spark.createDataFrame(rows, "a int, i int, v int"), "a", ["i"], {"v": "v"}, [1, 2, 5, 9]).collect()}
    want = {}
    for a in range(6):
        v = [x for b, _, x in rows if b == a]
        for n in (1, 2, 5, 9):
            means = [(sum(v[s : s + n]) / n, -s) for s in range(len(v) - n + 1) if None not in v[s : s + n]]
            if means:
                want[a, n] = (max(means)[0], -max(means)[1])
    assert found.keys() == want.keys()
    assert all(abs(found[k][0] - want[k][0]) < 1e-9 and found[k][1] == want[k][1] for k in want)


def test_eligibility_comes_from_the_activity(spark):
    efforts = spark.createDataFrame([(1, "watts", 250.0), (1, "cadence_rpm", 90.0), (2, "watts", 280.0), (3, "watts", 1.0)], "activity_id long, metric_name string, peak_value double")
    parents = spark.createDataFrame([(1, False, "virtual", "t", "v"), (2, True, None, "measured", "v")], "activity_id long, is_power_record_eligible boolean, power_record_exclusion_reason string, power_source_type string, power_classification_version string")
    got = {(r.activity_id, r.metric_name): (r.is_record_eligible, r.record_exclusion_reason, r.source_classification) for r in gold.with_eligibility(efforts, parents).collect()}
    assert got == {(1, "watts"): (False, "virtual", "t"), (1, "cadence_rpm"): (True, None, None), (2, "watts"): (True, None, "measured"), (3, "watts"): (False, None, None)}


SOURCE = "activity_id long, activity_date date, achievement_type string, metric_name string, duration_seconds int, value double"


def power(spark, rows):
    return spark.createDataFrame([(i, dt.date.fromisoformat(d), "power_best_effort", "power_watts", 1200, float(v)) for i, d, v in rows], SOURCE)


def test_records_and_recency(spark):
    facts = gold.achievements(power(spark, [(1, "2025-12-31", 300), (2, "2026-01-10", 290), (3, "2026-01-20", 310), (4, "2026-01-25", 310)])).collect()
    by = {(r.activity_id, r.comparison_scope): r for r in facts}
    assert set(by) == {(1, "all_time"), (1, "calendar_year"), (2, "calendar_year"), (3, "all_time"), (3, "calendar_year")}
    year = by[2, "calendar_year"]
    assert (year.previous_best_value, str(year.previous_best_date), year.days_since_previous_best) == (300, "2025-12-31", 10)
    assert by[3, "all_time"].previous_best_value == 300 and by[3, "all_time"].days_since_previous_best is None
    assert by[3, "calendar_year"].previous_best_value is None
    assert year.achievement_title == "New this year 20-minute power best"
    assert year.achievement_detail == "New this year 20-minute power best: 290 W -- best for 10 days"
    assert len({r.activity_achievement_key for r in facts}) == len(facts)


def test_records_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 1500)), i, float(rng.randint(0, 30))) for i, k in enumerate(rng.choices("ab", k=120))]
    df = spark.createDataFrame(rows, "k string, d date, i int, v double")
    for year in (False, True):
        got = {(r.k, r.i): r.previous and (r.previous.value, r.previous.i) for r in running_records(df, ["k"], ["d", "i"], "v", "d", year).collect()}
        want = {}
        for k, d, i, v in rows:
            before = [(pv, pd, pi) for pk, pd, pi, pv in sorted(rows, key=lambda r: r[1:3]) if pk == k and (pd, pi) < (d, i) and (not year or pd.year == d.year)]
            best = max((b[0] for b in before), default=None)
            if best is None or v > best:
                want[k, i] = best if best is None else next((b[0], b[2]) for b in before if b[0] == best)
        assert got == want
    records = running_records(df, ["k"], ["d", "i"], "v", "d", True).drop("previous")
    got = {(r.k, r.i): r.prior and r.prior.i for r in latest_prior_ge(records, df, ["k"], ["d", "i"], "v").collect()}
    for r in records.collect():
        near = max(((pd, pi) for pk, pd, pi, pv in rows if pk == r.k and (pd, pi) < (r.d, r.i) and pv >= r.v), default=None)
        assert got[r.k, r.i] == (near and near[1])
    # any rows, null keys and dates too: nulls come first
    some = [*rows[:60], (None, None, 200, 5.0), (None, dt.date(2021, 1, 1), 201, 4.0), (None, dt.date(2021, 1, 2), 202, 4.0)]
    every = spark.createDataFrame(some, "k string, d date, i int, v double")
    got = {(r.k, r.i): r.prior and r.prior.i for r in latest_prior_ge(every, every, ["k"], ["d", "i"], "v").collect()}
    place = lambda d, i: (d or dt.date.min, i)
    for k, d, i, v in some:
        near = max((place(pd, pi) for pk, pd, pi, pv in some if pk == k and place(pd, pi) < place(d, i) and pv >= v), default=None)
        assert got[k, i] == (near and near[1])


def test_a_closure_equals_a_rebuild(spark):
    dates = ["2026-01-01", "2026-02-01", "2026-03-01"]
    for old, new in (((300, 310, 320), (315, 310, 320)), ((315, 310, 320), (300, 310, 320))):
        before = power(spark, list(zip((1, 2, 3), dates, old)))
        after = power(spark, list(zip((1, 2, 3), dates, new)))
        activities = after.select("activity_id", F.col("activity_date").alias("start_date_local"))
        plan = incremental.Plan("historical_closure", dt.date(2026, 1, 1), "BEST_EFFORT_CHANGE")
        facts = daily.update_achievements(gold.achievements(before), after, activities, plan, activities.limit(0))
        assert incremental.compare_facts(facts, gold.achievements(after), ["activity_achievement_key"], ["metric_value", "previous_best_value", "days_since_previous_best"]).where("difference <> 'equal'").isEmpty()
