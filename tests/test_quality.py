"""Every family on a passing and a failing table; outcome, gate, stages; the named checks on built tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cadenza.plans import daily, outbox
from cadenza.quality import families as V
from cadenza.quality.checks import platform_checks
from cadenza.quality.runner import Check, may_publish, measured, normalised, outcome, run_checks, slowest


def df(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


CASES = {
    "unique_key": ([(1, 1), (2, 1)], [(1, 1), (1, 2)], lambda t: V.unique_key(t, ["k"])),
    "required": ([(1, 1)], [(1, None), (1, -1)], lambda t: V.required(t, ["v"], F.col("v") > 0)),
    "ordered": ([(1, 1), (1, None)], [(2, 1)], lambda t: V.ordered(t, "k", "v")),
    "strict": ([(1, 2)], [(1, 1)], lambda t: V.ordered(t, "k", "v", strict=True)),
    "orphans": ([(1, 1), (2, None)], [(1, 7)], lambda t: V.orphans(t, t.select(F.col("k").alias("p")), ["v"], ["p"])),
    "missing_downstream": ([(1, 1)], [(1, 2)], lambda t: V.missing_downstream(t, t.select(F.col("v").alias("k")), ["k"])),
    "flag": ([(1, 1)], [(5, 1)], lambda t: V.flag_vs_exists(t.withColumn("f", F.col("k") == 1), "f", t.where("k = 1 or k = 5").select("k"), ["k"])),
    "parity": ([(1, 1)], [(1, 1), (2, 2)], lambda t: V.count_parity(t, t.where("k = 1"))),
    "expected": ([(1, 1)], [(1, 2)], lambda t: V.expected_count(t.select("k", F.col("v").cast("long").alias("expected_rows")), t.select("k"), ["k"])),
    "column": ([(1, 1), (None, None)], [(1, 2)], lambda t: V.column_matches(t, {"v": F.col("k")}, ["k"])),
    "accepted": ([(1, 1)], [(1, 9), (1, None)], lambda t: V.accepted_values(t, "v", [1, 2])),
    "version": ([(1, 1)], [(1, None)], lambda t: V.version_current(t, "v", 1)),
    "agrees": ([(1, 1)], [(1, 2)], lambda t: V.agrees(t, t.select("k", F.col("k").alias("w")), ["k"], {"v": "w"})),
    "implies": ([(1, 1), (2, None)], [(1, None)], lambda t: V.implies(t, F.col("k") == 1, F.col("v") == 1)),
    "multi": ([(1, 1), (1, 1)], [(1, 1), (1, 2)], lambda t: V.multi_source(t, ["k"], "v")),
    "continuity": ([(1, 1), (1, 2)], [(1, 1), (1, 3)], lambda t: V.index_continuity(t, "k", "v")),
    "unresolved": ([(1, 1), (2, None)], [(1, 3)], lambda t: V.unresolved_refs(t, "v", t, "k")),
    "coverage": ([(1, 5)], [(1, 25)], lambda t: V.coverage(t, "k", "v", t.select("k", F.lit(5).alias("duration_seconds")), [5, 20])),
    "summary": ([(1, 1)], [(1, 9)], lambda t: V.parent_summary(t, t, "k", {"s": (F.col("k"), "v")}, 1.0)),
    "adjacent": ([(1, 1), (1, 1)], [(1, 1), (1, 2)], lambda t: V.adjacent_boundaries(t.withColumn("e", F.col("v")), "k", "v", "v", "e")),
}


@pytest.mark.parametrize("name", CASES)
def test_families(spark, name):
    good, bad, find = CASES[name]
    assert measured(find(df(spark, good, "k int, v int")))[0] == 0
    issues, text = measured(find(df(spark, bad, "k int, v int")))
    assert issues > 0 and text


def test_log_families(spark):
    log = df(spark, [("a", "SUCCESS", dt.datetime(2026, 1, 2), 1), ("a", "FAILED", dt.datetime(2026, 1, 1), 2), ("b", "FAILED", dt.datetime(2026, 1, 2), 3)], "entity string, status string, started_at timestamp_ntz, ended_at int")
    assert V.log_state(log, "a").isEmpty() and not V.log_state(log, "b").isEmpty() and not V.log_state(log, "c").isEmpty()
    assert V.recent_success(log, "a", "2026-01-03", 7).isEmpty() and not V.recent_success(log, "a", "2026-02-03", 7).isEmpty()
    assert {r.entity for r in V.recent_failures(log, ["a", "b"], "2026-01-03", 7).collect()} == {"a", "b"}
    assert V.stale(log, "a", ["a"]).isEmpty() and not V.stale(log, "b", ["a"]).isEmpty()


def test_domains(spark):
    day = lambda *d: df(spark, [(dt.date(2026, 1, x),) for x in d], "day date")
    assert V.no_overlap({"a": day(1, 2), "b": day(2)}, "day").isEmpty() and not V.no_overlap({"a": day(1), "b": day(2)}, "day").isEmpty()
    assert V.partial_coverage({"a": day(1, 2), "b": day(2)}, "day").count() == 1


def test_status_against_data(spark):
    t = df(spark, [(1, "SUCCESS", None), (2, "NOT_FOUND", None), (3, "PENDING", dt.datetime(2026, 1, 1)), (4, "PENDING", dt.datetime(2026, 1, 30)), (5, "SUCCESS", None)], "k int, s string, at timestamp_ntz")
    got = {r.k: r.finding for r in V.status_vs_data(t, "s", df(spark, [(2,), (5,)], "k int"), "k", ("at", "2026-02-01", 7)).collect()}
    assert got == {1: "success_without_data", 2: "not_found_with_data", 3: "stale_pending"}


def test_schema_contract(spark):
    t = df(spark, [(1, None), (1, "x")], "k int, v string")
    contract = [{"name": "k", "type": "int", "nullable": False}, {"name": "v", "type": "string"}]
    assert V.schema_contract(t.limit(1), contract, ["k"], spark).isEmpty()
    bad = [{"name": "v", "type": "int", "nullable": False}, {"name": "k", "type": "int"}, {"name": "w", "type": "int"}]
    assert {(r.column_name, r.finding) for r in V.schema_contract(t, bad, ["k"], spark).collect()} == {("w", "missing"), ("v", "type is string, not int"), ("k", "out of order"), ("v", "out of order"), ("v", "1 nulls"), ("k", "1 repeated keys")}


def check(name, severity, n, stage="silver"):
    return Check(name, severity, lambda t: t["t"].limit(n), stage=stage)


def test_outcome_stages_and_gate(spark):
    t = {"t": df(spark, [(i,) for i in range(9)], "i int")}
    run = lambda *cs: run_checks(spark, list(cs), t)
    assert outcome(run(check("a", "CRITICAL", 0))).first().outcome == "PASSED"
    warned = run(check("a", "WARNING", 9), check("b", "CRITICAL", 0, "gold"))
    assert outcome(warned).first().outcome == "PASSED_WITH_WARNINGS" and may_publish(warned)
    assert warned.where("check_name = 'a'").first().details.count("|") == 4
    stopped = run(check("a", "CRITICAL", 2, "preflight"), check("b", "CRITICAL", 0))
    assert [r.check_name for r in stopped.collect()] == ["a"] and not may_publish(stopped)
    broken = run(Check("x", "ERROR", lambda t: t["none"]))
    assert not broken.first().passed and "KeyError" in broken.first().details
    assert slowest(warned, 1).count() == 1
    assert normalised(df(spark, [("a", 2)], "check_name string, issue_count int")).first().severity == "WARNING"


def raw_tables(spark):
    acts, streams, laps = [], [], []
    for i in range(1, 5):
        start = dt.datetime(2026, 1, i, 8)
        acts.append((i, 7, 1, f"Ride {i}", "Ride", start, start, 1000.0 * i, 60, 60, 10.0, 5.0, None, None, 200.0, None, 100.0, "b1", True, "SUCCESS", "SUCCESS", "SUCCESS", json.dumps({"manual": False})))
        arrays = {"time": list(range(30)), "watts": [100 + i * x % 7 for x in range(30)], "latlng": [[1.0, 2.0]] * 30, "cadence": [90] * 30, "heartrate": [120] * 30}
        streams += [(i, t, json.dumps(a), len(a), start) for t, a in arrays.items()]
        laps.append((i, 1, json.dumps({"id": 100 + i, "activity": {"id": i}, "lap_index": 1, "elapsed_time": 30, "distance": 1000.0 * i, "moving_time": 60, "start_date": start.strftime("%Y-%m-%dT%H:%M:%SZ"), "device_watts": True})))
    a = df(spark, acts, "activity_id long, athlete_id long, source_id int, activity_name string, sport_type string, start_datetime_utc timestamp_ntz, start_datetime_local timestamp_ntz, distance_metres double, moving_time_seconds int, elapsed_time_seconds int, elevation_gain_metres double, average_speed_metres_per_second double, average_cadence_rpm double, average_heartrate_bpm double, average_power_watts double, weighted_average_power_watts double, energy_kilojoules double, gear_id string, is_device_watts boolean, stream_status string, details_status string, laps_status string, raw_payload string")
    gear = df(spark, [(1, "b1", "h", "Bike", 1.0, 1, True, dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2))], "gear_observation_id long, gear_id string, payload_hash string, gear_name string, distance_metres double, run_id long, observed_in_current_collection boolean, first_observed_at timestamp, last_observed_at timestamp")
    return daily.Raw(a, df(spark, streams, "activity_id long, stream_type string, stream_payload string, original_size int, retrieved_at timestamp"), df(spark, laps, "activity_id long, lap_index int, lap_payload string"), df(spark, [(1,)], "activity_id long"), gear, df(spark, [(1, "SUCCESS")], "run_id long, status string"))


def test_the_daily_run_passes_its_checks_and_queues_messages(spark, tmp_path):
    raw = raw_tables(spark)
    overrides = df(spark, [], "activity_id long, is_active boolean, power_source_type string, power_source_status string, is_measured_power boolean, is_power_record_eligible boolean, power_record_exclusion_reason string, power_classification_rule string, power_classification_method string")
    tables = daily.build_silver(raw, df(spark, [], "manual_cutover_at timestamp_ntz, rule_version string"), overrides, "b1", str(tmp_path))
    tables |= daily.build_gold(tables, str(tmp_path), durations=(5, 10, 20))
    tables |= {"raw_activities": raw.activities, "raw_activity_streams": raw.streams, "raw_activity_laps": raw.laps, "raw_gear_observations": raw.gear}
    assert tables["silver_activities"].where("power_source_type = 'measured'").count() == 4
    assert tables["gold_activity_best_efforts"].count() == 4 * 3 * 3
    facts = tables["gold_activity_achievements"]
    assert facts.where("comparison_scope = 'all_time' and metric_name = 'distance_metres'").count() == 4
    wanted = [c for c in platform_checks("2026-01-05", "b1") if set(c.tables) <= set(tables) and c.stage != "preflight" and c.scope == "publication" and "state" not in c.name]
    results = run_checks(spark, wanted, tables, stop=False)
    bad = [(r.check_name, r.details) for r in results.collect() if not r.passed]
    assert len(wanted) > 35 and not bad, bad

    acts = tables["silver_activities"]
    new = outbox.messages(facts.withColumn("notification_eligible", F.lit(True)), acts, "push", "2026-01-05")
    box, counts = outbox.queue(new, new.limit(0))
    assert counts.first().asDict() == {"queued": 4, "skipped": 0, "already_sent": 0, "already_queued": 0}
    one = outbox.due(box, "2026-01-06", 2, 1)
    box = outbox.sending(box, one, "2026-01-06").cache()
    failed = outbox.apply_outcomes(box, one.select("notification_id", F.lit(False).alias("delivered"), F.lit("x" * 3000).alias("error")), 2, 15, "2026-01-06")
    r = failed.where("notification_status = 'RETRY'").first()
    assert (r.attempt_count, len(r.error_message), r.next_attempt_at) == (1, 2000, dt.datetime(2026, 1, 6, 0, 15))
    sent = outbox.apply_outcomes(box, one.select("notification_id", F.lit(True).alias("delivered"), F.lit(None).cast("string").alias("error")), 2, 15, "2026-01-06")
    _, counts = outbox.queue(new, sent)
    assert counts.first().asDict() == {"queued": 0, "skipped": 4, "already_sent": 1, "already_queued": 3}
    last = outbox.apply_outcomes(box, one.select("notification_id", F.lit(False).alias("delivered"), F.lit("e").alias("error")), 1, 15, "2026-01-06")
    assert last.where("notification_status = 'FAILED' and next_attempt_at is null").count() == 1


def test_gates_stand_before_publication(spark, tmp_path, monkeypatch):
    from cadenza.operators.tables import published
    from cadenza.quality.gate import Refused, gate

    raw, root = raw_tables(spark), str(tmp_path / "gold")
    overrides = df(spark, [], "activity_id long, is_active boolean, power_source_type string, power_source_status string, is_measured_power boolean, is_power_record_eligible boolean, power_record_exclusion_reason string, power_classification_rule string, power_classification_method string")
    tables = daily.build_silver(raw, df(spark, [], "manual_cutover_at timestamp_ntz, rule_version string"), overrides, "b1", str(tmp_path))
    checks = platform_checks("2026-01-05", "b1")
    out = daily.publish_gold(tables, root, "1", checks, durations=(5, 10, 20))
    efforts = out["gold_activity_best_efforts"].count()
    assert efforts == 36 and not out["gold_activity_achievements"].isEmpty()

    good = daily.gold.activity_best_efforts
    spoiled = {
        "gold_best_efforts_duplicate_primary_key": lambda e: e.unionByName(e),
        "gold_best_efforts_sample_count_valid": lambda e: e.withColumn("sample_count", F.lit(1).cast(e.schema["sample_count"].dataType)),
        "gold_activity_best_efforts_watts_eligibility_matches_silver": lambda e: e.withColumn("is_record_eligible", F.lit(False)).withColumn("record_exclusion_reason", F.lit("x")),
    }
    for n, (name, spoil) in enumerate(spoiled.items()):
        monkeypatch.setattr(daily.gold, "activity_best_efforts", lambda *a, s=spoil: s(good(*a)))
        with pytest.raises(Refused, match=name) as refused:
            daily.publish_gold(tables, root, f"bad{n}", checks, durations=(5, 10, 20))
        assert name in [r.check_name for r in refused.value.results if not r.passed]
    assert published(spark, f"{root}/gold_activity_best_efforts").count() == efforts
    with pytest.raises(ValueError, match="no such checks"):
        gate("t", checks, {}, ("none",))
    with pytest.raises(Refused, match="missing tables"):
        gate("gold_activity_achievements", checks, {}, ("gold_activity_achievements_power_eligible_only",))(out["gold_activity_achievements"])
