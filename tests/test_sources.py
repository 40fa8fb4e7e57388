import datetime as dt
import json

from cadenza.plans import reports
from cadenza.sources import planned_events as P
from cadenza.sources import shape


def points(spark, *payloads):
    return spark.createDataFrame([(1, 2, "u", "u", p if isinstance(p, str) else json.dumps(p)) for p in payloads], "run_id long, source_id int, google_user_id string, google_health_user_id string, payload string")


def test_activities(spark):
    rows, rejects = shape.activities(points(spark, [{"id": 9007199254740993, "name": "A", "distance": 10.5, "moving_time": 7.9, "start_date": "2026-01-01T08:00:00Z", "device_watts": False, "athlete": {"id": 3}}, {"name": "no id"}]))
    r = rows.first()
    assert (r.activity_id, r.athlete_id, r.distance_metres, r.moving_time_seconds, r.is_device_watts, r.gear_id) == (9007199254740993, 3, 10.5, 7, False, None)
    assert r.start_datetime_utc == dt.datetime(2026, 1, 1, 8) and rejects.count() == 1


def test_streams_and_laps(spark):
    r = spark.createDataFrame([(5, json.dumps({"watts": {"data": [1, 2.50], "series_type": "time", "original_size": 2, "resolution": "high"}}))], "activity_id long, payload string")
    s = shape.streams(r).first()
    assert (s.stream_type, s.original_size, json.loads(s.stream_payload)) == ("watts", 2, [1, 2.5])
    rows, none = shape.laps(spark.createDataFrame([(5, '[{"id":1},{"id":2}]'), (6, "[]")], "activity_id long, payload string"))
    assert [(r.lap_index, r.lap_payload) for r in rows.orderBy("lap_index").collect()] == [(1, '{"id":1}'), (2, '{"id":2}')]
    assert [r.activity_id for r in none.collect()] == [6]


def test_gear(spark):
    from pyspark.sql import functions as F

    athlete = points(spark, {"bikes": [{"id": "b1", "name": "Bike"}], "shoes": [{"id": "g1", "name": ""}]})
    rows, rejects = shape.gear(shape.gear_collection(athlete), F.col("gear_type"), F.lit(True))
    assert [(r.gear_id, r.gear_type, len(r.payload_hash)) for r in rows.collect()] == [("b1", "bike", 64)] and rejects.count() == 1
    ids = shape.referenced_gear(shape.gear_collection(athlete), spark.createDataFrame([("b1",), ("b9",)], "gear_id string"))
    assert sorted(r.gear_id for r in ids.collect()) == ["b1", "b9", "g1"]


SLEEP = {"name": "log/1", "dataSource": {"name": "src"}, "sleep": {"interval": {"startTime": {"physicalTime": "2026-07-10T22:00:00.123456Z", "utcOffset": "3600s", "civilTime": {"date": {"year": 2026, "month": 7, "day": 10}}}, "endTime": "2026-07-11T06:00:00Z", "endUtcOffset": "0s"}, "type": "STAGES", "metadata": {"stagesStatus": "OK", "processed": True, "nap": "no"}, "stages": [{}, {}, {}]}}


def test_sleep_logs(spark):
    r = shape.sleep_logs(points(spark, SLEEP)).first()
    assert r.start_physical_time == dt.datetime(2026, 7, 10, 22, 0, 0, 123456) and r.end_physical_time == dt.datetime(2026, 7, 11, 6)
    assert (r.start_utc_offset, r.end_utc_offset, r.start_civil_date, r.end_civil_date) == ("3600s", "0s", dt.date(2026, 7, 10), None)
    assert (r.is_processed, r.is_nap, r.is_manually_edited, r.sleep_stage_count, r.has_sleep_stages, r.has_sleep_summary) == (True, False, None, 3, True, False)
    snake = {"name": "log/1", "sleep": {"interval": {"start_time": {"physical_time": "2026-07-10T22:00:00Z"}}}}
    assert shape.sleep_logs(points(spark, snake)).first().start_physical_time == dt.datetime(2026, 7, 10, 22)


def test_daily_resting_heart_rate(spark):
    fitbit = {"dataSource": {"platform": "FITBIT", "recordingMethod": "DERIVED", "device": {"manufacturer": "F"}}, "dailyRestingHeartRate": {"date": {"year": 2026, "month": 7, "day": 10}, "beatsPerMinute": "46"}}
    apple = {"name": "p/2", "data_source": {"device": {"manufacturer": "Apple Inc."}}, "daily_resting_heart_rate": {"date": "2026-07-11", "beats_per_minute": 50}}
    a, b = shape.daily(points(spark, fitbit, apple), "daily_resting_heart_rate").orderBy("activity_date").collect()
    assert (float(a.resting_heart_rate_bpm), a.activity_date, a.source_ecosystem, a.source_recording_method) == (46.0, dt.date(2026, 7, 10), "fitbit", "DERIVED")
    assert (float(b.resting_heart_rate_bpm), b.source_ecosystem, b.source_data_point_id) == (50.0, "apple_health", "p/2")
    assert a.daily_resting_heart_rate_key != b.daily_resting_heart_rate_key


def test_exercise(spark):
    good = {"name": "e/1", "exercise": {"exerciseType": "RUN", "interval": {"startTime": "2026-01-01T08:00:00Z"}}}
    rows, rejects = shape.exercise(points(spark, good, {"name": "e/2"}, {"exercise": {}}))
    assert [(r.source_data_point_id, r.exercise_type, r.source_ecosystem) for r in rows.collect()] == [("e/1", "RUN", "unknown")] and rejects.count() == 2
    revised, _ = shape.exercise(points(spark, good | {"x": 1}))
    assert revised.first().exercise_observation_key != rows.first().exercise_observation_key


def test_pages_are_put_together(spark):
    pages = points(spark, {"dataPoints": [{"a": 1}]}, {"data_points": [{"a": 2}, {"a": 3}]}, {})
    assert shape.data_points(pages).count() == 3
    hr = spark.createDataFrame([(1, "u", dt.date(2026, 1, 1), "1min", 2, "{}", 7, 1), (1, "u", dt.date(2026, 1, 1), "1min", 1, '{"x":1}', 7, 1)], "source_id int, fitbit_user_id string, activity_date date, detail_level string, page int, payload string, run_id long, retrieved_at int")
    assert shape.heart_rate_days(hr).first().heart_rate_payload == '{"pages":[{"x":1},{}]}'


def test_heart_rate_samples(spark):
    def point(name, time, rate, **more):
        return {"name": name, "dataSource": {"name": "watch"}, "heartRate": {"sampleTime": {"physicalTime": time, **more}, "beatsPerMinute": rate}}

    first = {"pages": [{"dataPoints": [point("a", "2026-01-01T23:30:00Z", "60", utcOffset="3600s"), point(None, "2026-01-01T10:00:00Z", 61)]}, {"data_points": [point("b", "no time", "62")]}]}
    again = {"pages": [{"dataPoints": [point("a", "2026-01-01T23:30:00Z", "60", utcOffset="3600s"), point("a", "2026-01-01T23:30:00Z", "60", utcOffset="-1800.5s")]},
                       {}, {"dataPoints": [point("c", "2026-01-02T00:00:00Z", "63", civilTime={"date": {"year": 2026, "month": 1, "day": 1}}), point("d", "2026-01-02T00:00:00Z", None)]}]}
    rows = [(1, "u", dt.date(2026, 1, d), "1sec", d, p) for d, p in ((1, json.dumps(first)), (2, json.dumps(again)), (3, "{"), (4, None), (5, "[]"))]
    responses = spark.createDataFrame(rows, "source_id int, google_health_user_id string, activity_date date, detail_level string, retrieved_at int, heart_rate_payload string")
    good, rejects = shape.heart_rate_samples(responses)
    got = {(r.source_data_point_id, r.heart_rate_bpm): r for r in good.collect()}
    assert set(got) == {("a", 60), (None, 61), ("c", 63)}
    a = got["a", 60]  # the latest response, its later point; half an hour back is the same day
    assert (a.raw_retrieved_at, a.raw_activity_date.day, a.sample_utc_offset, a.sample_date_local.day, a.sample_date_utc.day) == (2, 2, "-1800.5s", 1, 1)
    assert got[None, 61].sample_date_local is None and got["c", 63].sample_date_local.day == 1
    assert len({r.heart_rate_sample_key for r in got.values()}) == 3
    assert sorted((r.retrieved_at, r.reject_reason) for r in rejects.collect()) == [(1, "missing sample time or rate"), (2, "missing sample time or rate")]
    assert shape.heart_rate_samples(responses.limit(0))[0].isEmpty()


def test_planned_events(spark, tmp_path):
    good = {"event_key": "e1", "event_name": " Tour ", "status": "planned", "start_date": "2026-05-01", "stages": [{"stage_key": "s1", "stage_date": "2026-05-01", "distance_metres": "1000"}]}
    bad = {"event_key": "e2", "event_name": " ", "status": "maybe", "start_date": "2026-5-1", "end_date": "2026-01-01", "extra": 1, "stages": [{"stage_key": "s"}, {"stage_key": "s", "distance_metres": "1.5"}]}
    for i, e in enumerate((good, bad)):
        (tmp_path / f"{i}.json").write_text(json.dumps(e))
    checked = P.validated(P.read_events(spark, str(tmp_path)))
    errors = {r.event_key: r.errors for r in checked.collect()}
    assert errors["e1"] == [] and len(errors["e2"]) == 6
    events, stages = P.event_tables(checked)
    assert [(r.event_key, r.event_name) for r in events.collect()] == [("e1", "Tour")]
    assert [(r.stage_key, int(r.distance_metres)) for r in stages.collect()] == [("s1", 1000)]
    assert P.upcoming(events, "2026-05-01").count() == 1 and P.upcoming(events, "2026-05-02").isEmpty()


def test_payload_coverage(spark):
    df = spark.createDataFrame([(1, '{"a": 1, "b": {"c": null}, "d": [1, 2]}'), (2, '{"a": "x"}'), (3, "{"), (4, None)], "i int, p string")
    got = {r.path: (r.coverage_percent, r.types, r.null_frequency) for r in reports.payload_coverage(df, "p", "i").collect()}
    assert got == {"a": (100.0, "number,string", 0.0), "b": (50.0, "object", 0.0), "b.c": (50.0, "null", 1.0), "d": (50.0, "array", 0.0)}
