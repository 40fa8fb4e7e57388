"""The duration coverage checks on streams with dropouts."""

from cadenza.operators.windows import best_efforts
from cadenza.plans import gold
from cadenza.quality.checks import platform_checks


def test_a_dropout_does_not_take_an_activity_out(spark):
    low, high = sorted(gold.DURATIONS)[:2]
    # one null, then a run that holds the least duration only; an activity of nulls
    watts = [(1, i, None if i == 3 else 100) for i in range(4 + (low + high) // 2)] + [(2, i, None) for i in range(low + 2)]
    streams = spark.createDataFrame([(a, i, w, w, w) for a, i, w in watts], "activity_id long, sample_index int, watts int, cadence_rpm int, heartrate_bpm int")
    efforts = best_efforts(streams, "activity_id", ["sample_index"], gold.METRICS, list(gold.DURATIONS)).select("activity_id", "metric_name", "duration_seconds")
    for check in platform_checks("2026-01-05", "b1"):
        if check.name.endswith("_duration_coverage"):
            find = lambda e, c=check: [(r.activity_id, r.duration_seconds) for r in c.find({"silver_activity_streams": streams, "gold_activity_best_efforts": e}).collect()]
            assert find(efforts) == [] and find(efforts.where("false")) == [(1, low)]
