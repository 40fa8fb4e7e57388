"""Rules fused into one scan a table, and time limits of checks."""

import time

from pyspark.sql import functions as F

from cadenza.quality import families as V
from cadenza.quality import fused as Q
from cadenza.quality.runner import Check, may_publish, outcome, run_checks


def table(spark):
    rows = [(i, "ab c'd"[i % 6] if i % 7 else None, i % 5, i % 3, i % 50) for i in range(300)]
    return spark.createDataFrame(rows, "k int, s string, a int, b int, half int")


RULES = [
    Q.required("required", "t", ["s"], "a < 4", severity="CRITICAL", show=("k",)),
    Q.accepted("accepted", "t", "s", ["a", "b", "'"]),
    Q.in_order("ordered", "t", "a", "b"),
    Q.in_order("strictly", "t", "a", "b", strict=True),
    Q.implied("implied", "t", "a = 1", "b = 1"),
    Q.unique("unique_k", "t", ["k"]),
    Q.unique("unique_half", "t", ["half"], severity="WARNING"),
    Q.unique("unique_pair", "t", ["s", "b"]),
]


def wanted(t):
    return {
        "required": V.required(t, ["s"], F.expr("a < 4")).count(),
        "accepted": t.where("s is not null and s not in ('a', 'b', '\\'')").count(),
        "ordered": V.ordered(t, "a", "b").count(),
        "strictly": V.ordered(t, "a", "b", True).count(),
        "implied": V.implies(t, F.col("a") == 1, F.col("b") == 1).count(),
        "unique_k": 0,
        "unique_half": V.unique_key(t, ["half"]).count(),
        "unique_pair": V.unique_key(t, ["s", "b"]).count(),
    }


def test_fused_rules_find_what_single_checks_find(spark, tmp_path):
    t = table(spark)
    t.write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))
    found = Q.fused(spark, RULES, {"t": t, "other": t})
    got = {r.check_name: r for r in found.collect()}
    assert {n: r.issue_count for n, r in got.items()} == wanted(t)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1  # one scan for all rules
    assert got["unique_k"].details == "" and 1 <= got["required"].details.count("k=") <= Q.SAMPLES and got["unique_half"].details.startswith("half=")
    both = Q.fused(spark, [*RULES, Q.unique("again", "other", ["a"])], {"t": t, "other": t})
    assert both.count() == len(RULES) + 1
    assert {r.issue_count for r in Q.fused(spark, RULES, {"t": t.limit(0)}).collect()} == {0}


def test_keys_go_through_the_shuffle_as_values_and_a_count(spark):
    t = table(spark).withColumns({"at": F.timestamp_micros(F.col("k") + 1), "m": F.create_map("s", "b")}).where("s is not null")
    rules = [*RULES, Q.unique("micros", "t", ["at"]), Q.unique("maps", "t", ["m", "a"]), Q.unique("odd", "t", ["a"], show=("k",))]
    found = Q.fused(spark, rules, {"t": t})
    got = {r.check_name: r for r in found.collect()}
    assert {n: got[n].issue_count for n in ("micros", "unique_pair", "unique_k", "accepted")} == {n: c for n, c in (wanted(t) | {"micros": 0}).items() if n in ("micros", "unique_pair", "unique_k", "accepted")}
    assert got["maps"].issue_count == t.groupBy("s", "b", "a").count().where("count > 1").count() and got["odd"].issue_count == 5
    keys = Q._one_table(t, [r for r in rules if r.unique and r.name != "maps"])
    assert "to_json" not in keys._jdf.queryExecution().optimizedPlan().toString()  # milliseconds, and text for each row


def test_rules_that_cannot_be_asked_are_issues(spark):
    rules = [RULES[0], Q.required("no column", "t", ["none"]), Q.unique("no table", "x", ["k"]), Q.Rule("no sql", "t", bad="nothing(k)")]
    results = Q.fused_results(spark, rules, {"t": table(spark)})
    got = {r.check_name: r for r in results.collect()}
    assert "missing tables: x" == got["no table"].details and all(not got[n].passed for n in ("no column", "no table"))
    assert got["required"].severity == "CRITICAL" and not may_publish(results)


def slow(name, stage="silver"):
    """A check that would run for hours."""
    return Check(name, "ERROR", lambda t: t["t"].sparkSession.range(10**15).where("xxhash64(id) = 1"), stage=stage)


def test_a_slow_check_ends_at_its_limit_and_the_rest_run(spark):
    t, began = {"t": table(spark)}, time.monotonic()
    quick = Check("quick", "ERROR", lambda t: t["t"].limit(0))
    results = run_checks(spark, [slow("slow"), quick], t, per_check_seconds=9)
    got = {r.check_name: r for r in results.collect()}
    assert time.monotonic() - began < 50
    assert got["slow"].details.startswith("TIMED_OUT after 9") and not got["slow"].passed and got["quick"].passed
    assert outcome(results).first().outcome == "TIMED_OUT" and not may_publish(results)
    assert spark.range(3).count() == 3  # later jobs are not cancelled


def test_an_overall_limit_leaves_no_check_without_a_row(spark):
    results = run_checks(spark, [slow("slow"), Check("late", "WARNING", lambda t: t["t"])], {"t": table(spark)}, overall_seconds=3)
    got = {r.check_name: r.details for r in results.collect()}
    assert got["slow"].startswith("TIMED_OUT after") and got["late"] == "TIMED_OUT: the overall limit was reached before the check"
    failed = run_checks(spark, [Check("bad", "ERROR", lambda t: t["t"]), slow("slow")], {"t": table(spark)}, per_check_seconds=9)
    assert outcome(failed).first().outcome == "FAILED"
