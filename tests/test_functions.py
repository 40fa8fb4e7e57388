import datetime as dt

from pyspark.sql import functions as F

from cadenza.functions import json as J
from cadenza.functions import keys, text


def values(spark, rows, schema, column):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_text(spark):
    assert values(spark, [(45,), (185,), (3723,), (None,)], "s int", text.duration(F.col("s"))) == ["45s", "3m 5s", "1h 2m 3s", "unknown"]
    assert values(spark, [(5,), (1200,), (3600,), (7200,), (90,), (0,), (None,)], "s int", text.duration_label(F.col("s"))) == ["5-second", "20-minute", "1-hour", "2-hour", "90-second", "", ""]
    rows = [("distance_metres", 20000.0), ("distance_metres", 20250.0), ("power_watts", 250.5), ("elevation_gain_metres", 99.4), ("moving_time_seconds", 61.0), ("power_watts", None)]
    assert values(spark, rows, "m string, v double", text.metric_value(F.col("m"), F.col("v"))) == ["20 km", "20.2 km", "250 W", "99 m", "1m 1s", "unknown"]
    assert values(spark, [(None, None), ("b1", "Bike"), ("b9", None)], "i string, n string", text.gear_name(F.col("i"), F.col("n"))) == ["Not recorded", "Bike", "Unknown gear (b9)"]


def test_json(spark):
    rows = [('{"manual": true}',), ('{"manual": "0"}',), ('[{"manual": 1}]',), ('{"manual": null}',), ("{}",)]
    assert values(spark, rows, "p string", J.tri_state(J.object_or_only("p", "manual"))) == [True, False, True, None, None]
    assert values(spark, [("2026-07-10",), ('{"year":2026,"month":7,"day":10}',), ("x",), ('{"year":2026}',)], "p string", J.civil_date(F.col("p"))) == [dt.date(2026, 7, 10)] * 2 + [None] * 2
    assert values(spark, [("2026-07-10T01:02:03.5Z",), ("2026-07-10 01:02:03",), ("later",)], "p string", J.instant(F.col("p"))) == [dt.datetime(2026, 7, 10, 1, 2, 3, 500000), dt.datetime(2026, 7, 10, 1, 2, 3), None]
    assert values(spark, [("{}",), ("{",), (" ",), (None,)], "p string", J.parse_state(F.col("p"))) == ["ok", "malformed", "missing", "missing"]
    assert [J.snake(x) for x in ("startUtcOffset", "name")] == ["start_utc_offset", "name"]


def test_keys(spark):
    import hashlib

    assert values(spark, [("a", None)], "a string, b string", keys.key(F.col("a"), F.col("b"))) == [hashlib.sha256(b"a|NA").hexdigest()]
    one, two = values(spark, [(["x", "y"],), (["y", "x"],)], "k array<string>", keys.message_key(F.col("k")))
    assert one == two
    a, b = values(spark, [(None,), ("",)], "v string", keys.row_signature(F.col("v")))
    assert a != b
