import datetime as dt

from cadenza.plans import runlog
from cadenza.quality import families as V


def test_the_latest_row_is_the_state(spark, tmp_path):
    path, start = str(tmp_path / "runs"), dt.datetime(2026, 1, 1, 8)
    runlog.append(spark, [{"run_id": 1, "entity": "a", "status": "RUNNING", "started_at": start}], runlog.RUN, path)
    runlog.append(spark, [{"run_id": 1, "entity": "a", "status": "SUCCESS", "started_at": start, "ended_at": start + dt.timedelta(seconds=90)}, {"run_id": 2, "entity": "a", "status": "RUNNING", "started_at": start}], runlog.RUN, path)
    got = {r.run_id: (r.status, r.duration_seconds) for r in runlog.states(spark.read.parquet(path), ["run_id"]).collect()}
    assert got == {1: ("SUCCESS", 90.0), 2: ("RUNNING", None)}


def test_payload_families(spark):
    good = spark.createDataFrame([(1, "{}", "44136fa355b3678a1146ad16f7e8649e94fb4fc21fe77e8310c060f61caaff8a", "53.196583")], "k int, p string, h string, c string")
    bad = spark.createDataFrame([(1, "{", "0", "53.1")], "k int, p string, h string, c string")
    for find in (lambda t: V.payload_presence(t, "p", ["k"]), lambda t: V.checksum_matches(t, "p", "h", ["k"]), lambda t: V.coordinate_precision(t, "c", 6, ["k"])):
        assert find(good).isEmpty() and find(bad).count() == 1
