"""Upserts, reconciliation, incremental planning, joins, aggregates."""

import datetime as dt
import random
import statistics

from pyspark.sql import functions as F

from cadenza.operators import aggregates as A
from cadenza.operators import incremental as I  # noqa: E741
from cadenza.operators import joins as J
from cadenza.operators import reconcile as R
from cadenza.operators import upsert as U
from cadenza.operators.windows import latest_per_key
from cadenza.functions import keys

D = dt.date


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_upsert_overwrites_with_nulls_and_is_idempotent(spark):
    rng = random.Random(1)
    t = spark.createDataFrame([(i, rng.randint(0, 3), "x") for i in range(30)], "k int, v int, w string")
    s = spark.createDataFrame([(i, rng.choice([None, 0, 1]), "x") for i in range(20, 45)], "k int, v int, w string")
    once, counts = U.upsert(t, s, ["k"])
    want = {r.k: (r.v, r.w) for r in t.collect()} | {r.k: (r.v, r.w) for r in s.collect()}
    assert {r.k: (r.v, r.w) for r in once.collect()} == want
    assert sum(r["rows"] for r in counts.collect()) == 45
    again, counts = U.upsert(once, s, ["k"])
    assert rows(again, "k") == rows(once, "k")
    assert {r.action: r["rows"] for r in counts.collect()} == {"kept": 20, "unchanged": 25}


def test_touch_only_and_insert_only(spark):
    t = spark.createDataFrame([(1, "a", 1)], "k int, v string, run int")
    s = spark.createDataFrame([(1, "a", 2), (2, "b", 2)], "k int, v string, run int")
    assert rows(U.merged(t, s, ["k"], touch_only=["run"]), "k") == [(1, "a", 2, "unchanged"), (2, "b", 2, "inserted")]
    assert rows(U.merged(t, s, ["k"], insert_only=True), "k") == [(1, "a", 1, "unchanged"), (2, "b", 2, "inserted")]
    insert, update = U.split_existing(s, t, ["k"])
    assert rows(insert, "k") == [(2, "b", 2)] and rows(update, "k") == [(1, "a", 2)]


def test_observations_advance_and_refine(spark):
    t = spark.createDataFrame([("g", "h", "unknown", "name", 1)], "id string, hash string, type string, name string, last int")
    s = spark.createDataFrame([("g", "h", "bike", "other", 2), ("g", "i", "bike", "new", 2)], "id string, hash string, type string, name string, last int")
    assert rows(U.observation_upsert(t, s, ["id", "hash"], {"type": "unknown"}, ["last"]), "hash") == [("g", "h", "bike", "name", 2), ("g", "i", "bike", "new", 2)]


def test_status_pending_and_replacement(spark):
    t = spark.createDataFrame([(1, "PENDING"), (2, "SUCCESS"), (3, "FAILED")], "k int, s string")
    assert rows(U.apply_status(t, spark.createDataFrame([(1, "NOT_FOUND")], "k int, s string"), "k", "s"), "k") == [(1, "NOT_FOUND"), (2, "SUCCESS"), (3, "FAILED")]
    assert [r.k for r in U.pending(t, "k", "s").collect()] == [1, 3]
    assert [r.k for r in U.failed_from(t, "k", 2).orderBy("k").collect()] == [2, 3]
    new = spark.createDataFrame([(2, "NEW"), (2, "NEWER")], "k int, s string")
    assert rows(U.replace_keys(t, new, ["k"], spark.createDataFrame([(2,), (3,)], "k int")), "k", "s") == [(1, "PENDING"), (2, "NEW"), (2, "NEWER")]


def test_publication(spark, tmp_path):
    import pytest

    from cadenza.operators import tables

    t = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "k int, i int")
    root = str(tmp_path / "table")
    for version in ("1", "2"):
        tables.publish(spark, t.withColumn("v", F.lit(version)), root, version)
        assert {r.v for r in tables.published(spark, root).collect()} == {version}
    good = spark.createDataFrame([(1, 2), (2, 1)], "k int, expected_rows long")
    assert U.publish_staged(spark, t, good, ["k"], str(tmp_path / "a")).count() == 3
    with pytest.raises(ValueError):
        U.publish_staged(spark, t, good.where("k = 1"), ["k"], str(tmp_path / "b"))
    U.append_only(spark, t, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 6
    with pytest.raises(ValueError):
        U.append_only(spark, t.withColumn("x", F.lit(1)), str(tmp_path / "a"))


def test_sources_are_classified(spark):
    incoming = spark.createDataFrame([(1, '{"id":1,"name":"Ride"}'), (2, '{"id":2,"name":"New"}'), (4, "{}")], "k int, p string")
    existing = spark.createDataFrame([(1, '{"name":"Ride","id":1}', "SUCCESS", "SUCCESS"), (2, '{"id":2,"name":"Old"}', "PENDING", "SUCCESS"), (3, "{}", "SUCCESS", "FAILED")], "k int, p string, details string, streams string")
    for schema in (None, "id int, name string"):
        got = {r.k: r for r in R.classify_sources(incoming, existing, "k", "p", ["details", "streams"], schema).collect()}
        assert [got[k].reconciliation_status for k in (1, 2, 3, 4)] == ["UNCHANGED", "CHANGED", "MISSING", "NEW"]
        assert [got[k].child_status for k in (1, 2, 3, 4)] == ["COMPLETE", "INCOMPLETE", "FAILED", "INCOMPLETE"]
        assert got[2].repair_details and not got[1].repair_details
    found = R.classify_sources(incoming, existing, "k", "p", ["details", "streams"])
    assert [r.k for r in R.affected(found, "k").orderBy("k").collect()] == [2, 3, 4]
    assert {r.reconciliation_status: r["rows"] for r in R.summary(found.where("k <> 4")).collect()} == {"NEW": 0, "CHANGED": 1, "UNCHANGED": 1, "MISSING": 1}
    assert [r.k for r in R.upsertable(incoming, found, "k").orderBy("k").collect()] == [2, 4]
    assert {r.k: r.streams for r in R.mark_children_pending(existing, found, "k", ["streams"]).collect()} == {1: "SUCCESS", 2: "PENDING", 3: "FAILED"}


def context(spark, entries):
    return spark.createDataFrame(entries, "k int, change_type string, activity_date_before date, activity_date_after date, silver_activities_changed boolean, silver_streams_changed boolean, power_classification_changed boolean, dependency_start_date date")


def test_affected_ids_and_context_faults(spark):
    day = D(2026, 1, 1)
    c = context(spark, [(1, "update", day, day, False, True, False, day), (2, "update", day, day, True, False, False, day), (3, "update", day, day, False, False, True, day)])
    assert [r.k for r in I.affected_ids(c, "k").orderBy("k").collect()] == [1, 3]
    assert I.context_status(c, "k") == "COMPLETE" and I.context_status(None, "k") == "UNAVAILABLE"
    bad = c.unionByName(context(spark, [(1, "other", day, None, None, True, False, None)]))
    assert {r.fault for r in I.context_faults(bad, "k").collect()} == {"repeated_id", "unknown_type", "missing_flag", "wrong_dependency_date"}


def test_the_planner(spark):
    efforts, boundary = spark.createDataFrame([(1,)], "k int"), (D(2026, 1, 10), 5)
    old, new = D(2026, 1, 1), D(2026, 1, 20)
    plan = lambda entries, b=boundary: I.plan_invalidation(context(spark, entries), "k", efforts, b)
    assert plan([]).mode == "no_change"
    assert plan([], None).mode == "fallback"
    assert plan([(9, "insert", None, new, True, True, False, new)]).mode == "latest_append"
    assert plan([(9, "insert", None, old, True, True, False, old)]) == I.Plan("historical_closure", old, "HISTORICAL_INSERT")
    assert plan([(2, "update", old, new, True, False, False, old), (9, "insert", None, old, True, True, False, old)]).reason == "DATE_CHANGE"
    assert plan([(1, "update", old, old, False, True, False, old)]).reason == "BEST_EFFORT_CHANGE"
    assert plan([(2, "update", old, old, True, False, False, old)]).reason == "HISTORICAL_ACTIVITY_CHANGE"


def test_signatures(spark):
    a = spark.createDataFrame([(1, 1, "x", 1), (1, 2, None, 1), (2, 1, "y", 1)], "k int, i int, v string, computed int")
    b = spark.createDataFrame([(1, 2, None, 9), (1, 1, "x", 9), (2, 1, "z", 9)], "k int, i int, v string, computed int")
    sig = lambda d: {r.k: r.sig for r in keys.group_signature(d, ["k"], ["i"], ["i", "v"]).collect()}
    assert sig(a)[1] == sig(b)[1] and sig(a)[2] != sig(b)[2]
    assert [r.k for r in I.changed_outputs(a, b, "k", ["i", "v"]).collect()] == [2]
    ids = spark.createDataFrame([(1,), (7,)], "k int")
    assert {r.k: r.sig == I.NO_ROW for r in I.snapshot(a.where("i = 1"), ids, "k", ["v"]).collect()} == {1: False, 7: True}
    assert I.control_changed(a, b) and not I.control_changed(a, a)


def test_state_and_debt(spark):
    base = spark.createDataFrame([(1, D(2026, 1, 1)), (2, D(2026, 1, 2)), (3, D(2026, 1, 3)), (4, D(2026, 1, 4))], "k int, d date")
    state = spark.createDataFrame([(1, D(2026, 1, 1), "CURRENT", "s", 1, None), (2, D(2026, 1, 2), "INVALIDATED", "s", 0, None), (3, D(2026, 1, 3), "CURRENT", " ", 0, None)], "k int, d date, evaluation_status string, input_signature string, achievement_count int, invalidation_reason string")
    facts = spark.createDataFrame([(1,), (1,), (9,)], "k int")
    assert {r.k: r.reason for r in I.evaluation_debt(base, state, facts, "k").collect()} == {1: "count_mismatch", 2: "invalidated", 3: "blank_signature", 4: "missing"}
    assert I.history_boundary(state, "d", "k") == (D(2026, 1, 3), 3)
    assert [r.k for r in I.closure(base, "d", "k", D(2026, 1, 3)).collect()] == [3, 4]
    assert {r.k: r.evaluation_status for r in I.invalidate(state, "d", D(2026, 1, 3), "X").collect()} == {1: "CURRENT", 2: "INVALIDATED", 3: "INVALIDATED"}
    assert I.state_summary(base, state, "k").first().asDict() == {"rows": 4, "current": 2, "invalidated": 1, "missing": 1}
    assert [r.k for r in I.orphan_facts(facts, base, "k").collect()] == [9]
    assert {r.k: r.achievement_count for r in I.state_rows(base.select("k"), facts, "k").collect()} == {1: 2, 2: 0, 3: 0, 4: 0}


def test_plans_and_skips(spark):
    expected = spark.createDataFrame([(1, 2), (2, 1), (3, 1)], "k int, expected_rows long")
    actual = spark.createDataFrame([(1, "v"), (2, "v0")], "k int, version string")
    assert rows(I.repair_plan(expected, actual, ["k"], ("version", "v")), "k") == [(1, 2, 1, "incomplete"), (2, 1, 1, "stale_version"), (3, 1, 0, "missing")]
    log = spark.createDataFrame([("gold", "SUCCESS", 5), ("silver", "SUCCESS", 4), ("silver", "FAILED", 9)], "entity string, status string, ended_at int")
    assert I.up_to_date(log, "gold", ["silver"]).first().is_current
    assert not I.up_to_date(log.where("entity <> 'gold'"), "gold", ["silver"]).first().is_current
    due = I.lookups_due(spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "g string"), spark.createDataFrame([("a",)], "g string"), spark.createDataFrame([("b", dt.datetime(2026, 1, 30))], "g string, attempted_at timestamp_ntz"), "g", "2026-02-01", 7)
    assert [r.g for r in due.collect()] == ["c"]


def test_joins(spark):
    s = spark.createDataFrame([(1, t) for t in range(0, 100, 10)] + [(2, 5)], "k int, t int")
    i = spark.createDataFrame([(1, "x", 0, 30), (1, "y", 30, 95), (1, "empty", 5, 5)], "k int, n string, a int, b int")
    for width in (None, 7, 1000):
        got = {(r.t, r.n) for r in J.interval_join(s, i, "k", "t", "a", "b", width).collect()}
        assert got == {(t, "x" if t < 30 else "y") for t in range(0, 91, 10)}
    assert J.with_control_row(s, spark.createDataFrame([], "c int")).where("c is null").count() == 11
    assert rows(J.range_expand(spark.createDataFrame([(1, 12)], "k int, n int"), "n", [5, 10, 20]), "duration_seconds") == [(1, 12, 5), (1, 12, 10)]
    assert rows(J.exists_flag(spark.createDataFrame([(1,), (None,)], "k int"), s, ["k"], "f"), "k") == [(None, False), (1, True)]


def test_aggregates(spark):
    df = spark.createDataFrame([(D(2026, 1, 1), 1.0), (D(2026, 1, 3), 2.0), (D(2026, 1, 3), 3.0)], "d date, v double")
    assert rows(A.densify_daily(df, "d", "v"), "day") == [(D(2026, 1, 1), 1.0), (D(2026, 1, 2), 0.0), (D(2026, 1, 3), 5.0)]
    assert A.densify_daily(df.limit(0), "d", "v").isEmpty()
    assert [tuple(r)[0] for r in A.date_windows(spark, "2026-02-27", "2026-03-01").orderBy("date").collect()] == [D(2026, 2, 27), D(2026, 2, 28), D(2026, 3, 1)]
    log = spark.createDataFrame([(1, i, 10.0, 100) for i in range(6)] + [(1, 6, 61.0, 100), (1, 7, 59.0, 100)], "run int, i int, s double, n int")
    assert [r.i for r in A.slow_batches(log, "run", "i", "s").where("is_slow").collect()] == [6]
    rng = random.Random(3)
    log = [(k, i, rng.choice([None, 1.0, 20.0, 61.0, 90.0, 200.0])) for k in (None, 1, 2) for i in range(60)]
    got = {(r.run, r.i): (r.prior, r.prior_median, r.is_slow) for r in A.slow_batches(spark.createDataFrame(log, "run int, i int, s double"), "run", "i", "s", factor=2).collect()}
    for k, i, s in log:
        before = [v for j, a, v in log if j == k and a < i and v is not None]
        m = statistics.median(before) if before else None
        assert got[k, i] == (len(before), m, s is not None and s > (max(60, 2 * m) if len(before) >= 5 else 60))
    trend = lambda early, late: A.throughput_trend(spark.createDataFrame([(1, i, 10.0, early if i < 5 else late) for i in range(10)], "run int, i int, s double, n int"), "run", "i", "n", "s").first().trend
    assert (trend(100, 100), trend(100, 120), trend(100, 80)) == ("stable", "improving", "degrading")
    short = [(1, i, 10.0, 100) for i in range(3)] + [(2, i, 10.0, n) for i, n in enumerate((100, 100, 300, 100, 100))] + [(3, i, 10.0, None if i else 1) for i in range(6)] + [(4, i, 0.0, 1) for i in range(6)]
    got = {r.run: r.trend for r in A.throughput_trend(spark.createDataFrame(short, "run int, i int, s double, n int"), "run", "i", "n", "s").collect()}
    assert got == {1: "calculating", 2: "improving", 3: "calculating", 4: "calculating"}
    assert rows(latest_per_key(spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, i int, v string"), ["k"], ["i"]), "k") == [(1, 2, "b")]
    profile = {r.column_name: r for r in A.population_profile(spark.createDataFrame([(1, None), (1, None)], "a int, b int"), counterpart={"b": F.col("a")}, values=3).collect()}
    assert (profile["a"].anomaly, profile["a"].value_list, profile["b"].anomaly) == ("constant", "1", "source_populated_but_empty")
    g = spark.createDataFrame([(1, None), (2, 3)], "a int, b int").select(A.greatest_or_null(F.col("a"), F.col("b")).alias("g"))
    assert [r.g for r in g.collect()] == [None, 3]


def test_batches_that_take_no_time_have_an_infinite_rate(spark):
    log = [(1, 1, 6, 0.0), (1, 2, 6, 3.0), (1, 3, None, None), (2, 1, 0, 0.0), (2, 2, 5, 0.0), (3, 1, None, 0.0), (4, 1, 0, 2.0)]
    df = spark.createDataFrame(log, "run int, n int, rows long, seconds double").withColumn("left", F.lit(8))
    got = {(r.run, r.n): (str(r.rows_per_second), r.eta_seconds) for r in A.rolling_throughput(df, "run", "n", "rows", "seconds", "left", 2).collect()}
    assert got == {(1, 1): ("inf", 0.0), (1, 2): ("4.0", 2.0), (1, 3): ("2.0", 4.0), (2, 1): ("nan", None), (2, 2): ("inf", 0.0), (3, 1): ("None", None), (4, 1): ("0.0", None)}


def test_candidates_and_their_audit_join_no_tables(spark, monkeypatch):
    monkeypatch.setattr(I, "PIECE", 2)
    ids = lambda *k: spark.createDataFrame([(x,) for x in k], "k int")
    at = lambda *r: spark.createDataFrame(list(r), "k int, computed_at int")
    found = I.candidates(ids(1, 1, 2, 3, 4, None), at((1, 5), (1, 3), (2, 5), (4, 5), (9, 1), (None, 9)), at((1, 5), (2, 6), (3, 1), (8, 8), (None, 1)), "k", "day", "conservative")
    audit = I.candidate_audit(ids(1, 1, 1, 1, 1, 2, 3, 3, None), ids(3, 4, 4, 5, None, None), "k")
    for df in (found, audit):
        assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.k for r in found.collect()), key=str) == [2, 3, None]
    want = [(1, "only_first")] * 5 + [(2, "only_first"), (4, "only_second"), (4, "only_second"), (5, "only_second"), (None, "only_first")] + [(None, "only_second")] * 2
    assert sorted(map(tuple, audit.collect()), key=str) == sorted(want, key=str)


def test_best_efforts_do_not_drift_and_take_nan_for_missing(spark):
    from cadenza.operators import windows as W

    v = [0.1, 0.2, 0.3] * 400
    rows = [("a", i, x) for i, x in enumerate(v)] + [("b", i, x) for i, x in enumerate([1.0, float("nan"), 2.0, 3.0, 4.0, float("inf")])]
    got = {(r.k, r.duration_seconds): (r.peak_value, r.start_i) for r in W.best_efforts(spark.createDataFrame(rows, "k string, i int, v double"), "k", ["i"], {"v": "v"}, [2, 3]).collect()}
    assert got == {("a", 2): (0.25, 1), ("a", 3): (0.6 / 3, 0), ("b", 2): (3.5, 3), ("b", 3): (3.0, 2)}


def test_a_publication_that_stops_half_way_leaves_the_table(spark, tmp_path):
    import pytest

    from cadenza.operators import tables as U

    root = str(tmp_path / "table")
    one, two = spark.range(3), spark.range(5)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        U.published(spark, root)
    U.publish(spark, one, root, "first")
    two.write.parquet(f"{root}/version=second")  # stopped before its pointer
    assert U.published(spark, root).count() == 3
    (tmp_path / "table" / "_pointers" / "000000000001").mkdir()  # stopped while its pointer was written
    assert U.published(spark, root).count() == 3
    U.publish(spark, two, root, "a-third")  # takes that number: an empty folder holds no pointer
    assert U.published(spark, root).count() == 5


def test_canonical_json_orders_keys(spark):
    from pyspark.sql import functions as F

    from cadenza.operators.reconcile import canonical_json

    rows = [('{"b": 1, "a": {"d": [1, 2], "c": null}}', '{ "a":{"c":null,"d":[1,2]},"b":1}'), ("no json", "no json"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string").select(canonical_json(F.col("x")).eqNullSafe(canonical_json(F.col("y"))).alias("same"))
    assert all(r.same for r in df.collect())
    assert spark.createDataFrame([('{"a": 1}', '{"a": 2}')], "x string, y string").select((canonical_json(F.col("x")) == canonical_json(F.col("y"))).alias("s")).first().s is False


def test_interval_join_names_shared_columns(spark):
    import pytest

    from cadenza.operators import joins as J

    s = spark.createDataFrame([(1, 5, "x")], "k int, at int, note string")
    with pytest.raises(ValueError, match="note"):
        J.interval_join(s, spark.createDataFrame([(1, 0, 9, "y")], "k int, a int, b int, note string"), "k", "at", "a", "b")
    assert J.interval_join(s, spark.createDataFrame([(1, 0, 9)], "k int, a int, b int"), "k", "at", "a", "b").count() == 1
