import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cadenza.plans import silver

T0 = dt.datetime(2026, 1, 1, 8)


def test_streams_are_widened(spark):
    arrays = {"time": ([0, 1, 2], 3), "distance": ([0, 10.5, 21.25], 3), "latlng": ([[53.196583, -2.880290], [53.2, -2.9], [53.3, -3.0]], 3), "watts": ([101, 202], 2), "moving": ([True, True, False], 3)}
    raw = spark.createDataFrame([(1, t, json.dumps(a), n, T0) for t, (a, n) in arrays.items()], "activity_id long, stream_type string, stream_payload string, original_size int, retrieved_at timestamp")
    rows = silver.widen_streams(raw).orderBy("sample_index").collect()
    assert [r.watts for r in rows] == [101, 202, None]
    assert [r.distance_metres for r in rows] == [0, 10.5, 21.25]
    assert [r.is_moving for r in rows] == [True, True, False]
    assert (rows[0].latitude, rows[0].longitude) == (53.196583, -2.880290)
    assert rows[0].heartrate_bpm is None and (rows[0].raw_stream_count, rows[0].raw_max_original_size) == (5, 3)


LAP = {"id": 987654321012345678, "activity": {"id": 123456789012345678}, "lap_index": 1, "name": " ", "start_date": "2026-01-01T08:00:00Z", "start_date_local": "2026-01-01T09:00:00Z", "elapsed_time": 120, "average_watts": 200.5, "device_watts": True}


def laps(spark, *payloads):
    raw = spark.createDataFrame([(123456789012345678, i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads, 1)], "activity_id long, lap_index int, lap_payload string")
    return silver.type_laps(raw, spark.createDataFrame([(123456789012345678, T0)], "activity_id long, start_datetime_utc timestamp_ntz"))


def test_a_lap_is_typed(spark):
    good, bad = laps(spark, LAP)
    r = good.first()
    assert bad.isEmpty()
    assert (r.lap_id, r.start_time_seconds, r.end_time_seconds, len(r.raw_payload_hash)) == (987654321012345678, 0, 120, 64)
    assert r.lap_name is None and r.is_device_watts and r.start_datetime_local == dt.datetime(2026, 1, 1, 9)


@pytest.mark.parametrize("wrong, reason", [({"average_watts": "much"}, "average_watts is not numeric"), ({"activity": {"id": 5}}, "activity mismatch"), ({"id": "x"}, "missing or invalid lap id"), ({"lap_index": -1}, "missing or invalid lap index"), ({"device_watts": "maybe"}, "device_watts is no boolean")])
def test_wrong_laps_are_rejected(spark, wrong, reason):
    good, bad = laps(spark, LAP | wrong)
    assert good.isEmpty() and bad.first().reject_reason == reason


def test_malformed_and_repeated_laps_are_rejected(spark):
    good, bad = laps(spark, "{", LAP, LAP)
    assert good.isEmpty() and sorted(r.reject_reason for r in bad.collect()) == ["malformed payload", "repeated lap id", "repeated lap id"]


def test_a_lap_payload_is_read_once(spark):
    good, bad = laps(spark, LAP, LAP | {"id": 5}, LAP | {"id": 5}, LAP | {"id": 10**30}, LAP | {"id": 10**30}, LAP | {"activity": json.dumps(LAP["activity"])})
    assert [r.lap_id for r in good.collect()] == [LAP["id"]]
    assert sorted(r.reject_reason for r in bad.collect()) == ["activity mismatch", *["missing or invalid lap id"] * 2, *["repeated lap id"] * 2]
    for df, passes in ((good, 1), (bad, 2)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("json_tuple") == passes and plan.count("get_json_object") <= 2 * passes


def test_lap_power_provenance(spark):
    rows = [(200.0, True, "measured", "s", True, True), (200.0, True, "virtual", "s", False, False), (200.0, False, "measured", "s", True, True), (200.0, True, None, "s", True, True), (None, True, "m", "s", True, True), (200.0, None, "m", "s", True, True)]
    df = spark.createDataFrame(rows, "p double, d boolean, a string, b string, c boolean, e boolean")
    kind = silver.lap_power_provenance(F.col("p"), F.col("d"), (F.col("a"), F.col("b"), F.col("c"), F.col("e")))
    assert [r[0] for r in df.select(kind).collect()] == ["expected_agreement", "governed_override", "potential_inconsistency", "missing_canonical_context", "no_lap_power", "source_assertion_missing"]


def activity(i, start, device=True, sport="Ride", name="Ride", trainer=None, watts=200.0):
    return i, name, sport, start, device, watts, None, json.dumps({"trainer": trainer} if trainer is not None else {}), "b1"


ACTIVITY = "activity_id long, activity_name string, sport_type string, start_datetime_utc timestamp_ntz, is_device_watts boolean, average_power_watts double, weighted_average_power_watts double, raw_payload string, gear_id string"


def classified(spark, rows, gps=(), cutover=None, override=()):
    a = spark.createDataFrame(rows, ACTIVITY)
    none = spark.createDataFrame([], "activity_id long")
    streams = spark.createDataFrame([(i, "latlng") for i in gps], "activity_id long, stream_type string")
    control = spark.createDataFrame([(cutover, "rules_v2")] if cutover else [], "effective_cutover_at timestamp_ntz, rule_version string")
    overrides = spark.createDataFrame(list(override), "activity_id long, is_active boolean, power_source_type string, power_source_status string, is_measured_power boolean, is_power_record_eligible boolean, power_record_exclusion_reason string, power_classification_rule string, power_classification_method string")
    return {r.activity_id: r for r in silver.classify_power(silver.power_evidence(a, streams, none, none), control, overrides).collect()}


def test_the_classification_ladder(spark):
    early, late = dt.datetime(2025, 1, 1), dt.datetime(2027, 1, 1)
    rows = [activity(1, early, name="TrainerRoad x"), activity(2, late, name="TrainerRoad x"), activity(3, early), activity(4, early), activity(5, late), activity(6, early, device=False), activity(7, early, device=False, watts=None), activity(8, early)]
    override = [(8, True, "measured", "governed", True, True, None, "manual", "override")]
    got = classified(spark, rows, gps=[3], cutover=T0, override=override)
    assert [got[i].power_source_type for i in range(1, 9)] == ["virtual", "measured", "measured", "unknown", "measured", "estimated", "none", "measured"]
    assert [got[i].is_power_record_eligible for i in range(1, 9)] == [False, True, True, False, True, False, False, True]
    assert got[2].power_classification_rule == "trainerroad_at_or_after_roller_bike_power_cutover"
    assert got[3].power_classification_rule == "outdoor_device_watts_before_cutover"
    assert got[4].power_record_exclusion_reason == "pre_cutover_device_watts_ambiguous"
    assert got[8].power_record_exclusion_reason is None and got[8].power_classification_method == "override"
    assert {r.power_classification_version for r in got.values()} == {"rules_v2"}


def test_without_a_cutover(spark):
    got = classified(spark, [activity(1, T0, name="trainerroad"), activity(2, T0), activity(3, T0)], gps=[3])
    assert [got[i].power_source_type for i in (1, 2, 3)] == ["unknown", "unknown", "measured"]
    assert got[1].power_classification_version == silver.DEFAULT_RULE_VERSION


def test_gear_is_current_only_in_the_latest_successful_run(spark):
    day = lambda n: dt.datetime(2026, 1, n)
    rows = [(1, "b1", "old name", 1, True, day(1), day(1)), (2, "b1", "new name", 2, True, day(2), day(2)), (3, "old", "old", 2, False, day(1), day(2))]
    obs = spark.createDataFrame(rows, "gear_observation_id long, gear_id string, gear_name string, run_id long, observed_in_current_collection boolean, first_observed_at timestamp, last_observed_at timestamp")
    got = {r.gear_id: r for r in silver.silver_gear(obs, spark.createDataFrame([(1, "SUCCESS"), (2, "SUCCESS"), (3, "FAILED")], "run_id long, status string")).collect()}
    assert (got["b1"].gear_name, got["b1"].is_current, got["old"].is_current) == ("new name", True, False)
    assert not any(r.is_current for r in silver.silver_gear(obs, spark.createDataFrame([], "run_id long, status string")).collect())
