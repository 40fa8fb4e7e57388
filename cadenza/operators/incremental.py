"""What changed, what depends on it, and what to compute again."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import row_signature

#: The signature of a key without a row.
NO_ROW = "<no row>"
# Reasons for an invalidation, the strongest first.
REASONS = ("DATE_CHANGE", "HISTORICAL_INSERT", "POWER_ELIGIBILITY_CHANGE", "BEST_EFFORT_CHANGE", "HISTORICAL_ACTIVITY_CHANGE")
#: Repeated ids of an audit come back in arrays of so many.
PIECE = 10_000
CHANGE_TYPES = ("insert", "update", "delete_or_exclude")


def snapshot(df: DataFrame, ids: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, sig) for each id; ids without a row have a signature of their own."""
    rows = df.select(key, row_signature(*(F.col(c) for c in columns)).alias("sig"))
    return ids.select(key).distinct().join(rows, key, "left").withColumn("sig", F.coalesce("sig", F.lit(NO_ROW)))


def signature_diff(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys whose sets of rows differ: rows found on one side only."""
    a, b = (d.select(key, row_signature(*(F.col(c) for c in columns)).alias("_s")).distinct() for d in (before, after))
    return a.join(b, [key, "_s"], "left_anti").unionByName(b.join(a, [key, "_s"], "left_anti")).select(key).distinct()


def publish_counts(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row: inserted, updated, unchanged."""
    sign = lambda d, n: d.select(key, row_signature(*(F.col(c) for c in columns)).alias(n))
    both = sign(after, "_new").join(sign(before, "_old"), key, "left")
    return both.agg(F.count_if(F.col("_old").isNull()).alias("inserted"), F.count_if(F.col("_old") != F.col("_new")).alias("updated"), F.count_if(F.col("_old") == F.col("_new")).alias("unchanged"))


def control_changed(before: DataFrame, after: DataFrame) -> bool:
    """Do two small control tables differ?"""
    return not (before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty())


def change_rows(ids: DataFrame, before: DataFrame, after: DataFrame, key: str, date: str, power: list[str], stream_changed: DataFrame) -> DataFrame:
    """The change context: one row for each id with a material change.

    ``before`` and ``after``: key, date, sig and the power columns. The dependency date is the earlier of
    the two dates. Rows without any change are left out.
    """
    side = lambda d, p: d.select(key, *(F.col(c).alias(f"_{p}_{c}") for c in (date, "sig", *power)), F.lit(True).alias(f"_{p}"))
    streams = stream_changed.select(key).distinct().withColumn("_stream", F.lit(True))
    both = ids.select(key).distinct().join(side(before, "b"), key, "left").join(side(after, "a"), key, "left").join(streams, key, "left")
    kind = F.when(F.col("_b").isNull() & F.col("_a").isNotNull(), "insert").when(F.col("_a").isNull(), "delete_or_exclude").otherwise("update")
    power_changed = reduce(lambda x, c: x | ~F.col(f"_b_{c}").eqNullSafe(F.col(f"_a_{c}")), power, F.lit(False))
    out = both.where("_b is not null or _a is not null").select(
        key,
        kind.alias("change_type"),
        F.col(f"_b_{date}").alias("activity_date_before"),
        F.col(f"_a_{date}").alias("activity_date_after"),
        (~F.col("_b_sig").eqNullSafe(F.col("_a_sig"))).alias("silver_activities_changed"),
        F.coalesce("_stream", F.lit(False)).alias("silver_streams_changed"),
        power_changed.alias("power_classification_changed"),
        F.least(F.col(f"_b_{date}"), F.col(f"_a_{date}")).alias("dependency_start_date"),
    )
    return out.where("silver_activities_changed or silver_streams_changed or power_classification_changed")


def context_faults(context: DataFrame, key: str) -> DataFrame:
    """(fault, rows) of a change context that breaks its rules; no rows if it is sound."""
    flags = ("silver_activities_changed", "silver_streams_changed", "power_classification_changed")
    no_flag = reduce(lambda a, c: a | F.col(c).isNull(), flags, F.lit(False))
    first = F.least("activity_date_before", "activity_date_after")
    checks = {
        "missing_id": F.col(key).isNull(),
        "missing_flag": no_flag,
        "unknown_type": ~F.coalesce(F.col("change_type").isin(*CHANGE_TYPES), F.lit(False)),
        "wrong_dependency_date": ~F.col("dependency_start_date").eqNullSafe(first),
    }
    one = context.agg(*(F.count_if(c).alias(n) for n, c in checks.items()), (F.count(key) - F.count_distinct(key)).alias("repeated_id"))
    names = [*checks, "repeated_id"]
    return one.select(F.explode(F.array(*(F.struct(F.lit(n).alias("fault"), F.col(n).alias("rows")) for n in names))).alias("f")).select("f.*").where("rows > 0")


def context_status(context: DataFrame | None, key: str) -> str:
    """COMPLETE, UNAVAILABLE (there is none) or UNTRUSTED (it breaks its rules)."""
    if context is None:
        return "UNAVAILABLE"
    return "COMPLETE" if context_faults(context, key).isEmpty() else "UNTRUSTED"


def affected_ids(context: DataFrame, key: str) -> DataFrame:
    """Ids whose best efforts depend on what changed: samples or power classification."""
    return context.where("silver_streams_changed or power_classification_changed").select(key).distinct()


def repair_plan(expected: DataFrame, actual: DataFrame, key: list[str], version: tuple[str, str] | None = None, freshness: tuple[str, str] | None = None) -> DataFrame:
    """(key, expected_rows, actual_rows, reason) of keys to compute again.

    Reasons: missing, incomplete, stale_version, updated_silver. ``expected``: key, expected_rows (and the freshness
    column); ``actual``: the rows in store. ``version``: (column, current value). ``freshness``: (column of
    expected, column of actual): the former is newer.
    """
    measures = [F.count("*").alias("actual_rows")]
    if version:
        measures.append(F.count_if(~F.col(version[0]).eqNullSafe(F.lit(version[1]))).alias("_stale"))
    if freshness:
        measures.append(F.min(freshness[1]).alias("_oldest"))
    both = expected.join(actual.groupBy(*key).agg(*measures), key, "left").withColumn("actual_rows", F.coalesce("actual_rows", F.lit(0)))
    reason = F.when((F.col("actual_rows") == 0) & (F.col("expected_rows") > 0), "missing").when(F.col("actual_rows") != F.col("expected_rows"), "incomplete")
    if version:
        reason = reason.when(F.col("_stale") > 0, "stale_version")
    if freshness:
        reason = reason.when(F.col(freshness[0]) > F.col("_oldest"), "updated_silver")
    return both.select(*key, "expected_rows", "actual_rows", reason.alias("reason")).where("reason is not null")


def affected_plan(ids: DataFrame, summary: DataFrame, key: str, expected: str = "expected_rows") -> DataFrame:
    """Explicit ids with their expected rows; 0 where the source has none."""
    return ids.select(key).distinct().join(summary, key, "left").withColumn(expected, F.coalesce(expected, F.lit(0)))


def stale_versions(df: DataFrame, column: str, current: str) -> DataFrame:
    return df.agg(F.count_if(~F.col(column).eqNullSafe(F.lit(current))).alias("stale_rows"))


def up_to_date(log: DataFrame, downstream: str, upstream: list[str]) -> DataFrame:
    """One row: did the latest success of ``downstream`` end no earlier than each upstream's latest success?"""
    ok = F.col("status") == "SUCCESS"
    last = log.agg(F.max(F.when(ok & (F.col("entity") == downstream), F.col("ended_at"))).alias("downstream"), F.max(F.when(ok & F.col("entity").isin(*upstream), F.col("ended_at"))).alias("upstream"))
    return last.withColumn("is_current", F.coalesce(F.col("downstream") >= F.col("upstream"), F.lit(False)))


def history_boundary(state: DataFrame, date: str, key: str) -> tuple | None:
    """(date, id) of the last CURRENT row."""
    row = state.where("evaluation_status = 'CURRENT'").agg(F.max(F.struct(date, key)).alias("last")).first()
    return tuple(row["last"]) if row["last"] else None


@dataclass(frozen=True)
class Plan:
    """mode: no_change, latest_append, historical_closure or fallback."""

    mode: str
    start_date: object = None
    reason: str | None = None


def plan_invalidation(context: DataFrame | None, key: str, effort_changed: DataFrame, boundary: tuple | None) -> Plan:
    """What a day's changes ask for; one aggregate row comes to the driver.

    Only inserts after the boundary are appended. Anything earlier opens the history from its dependency date.
    Without a sound context or a boundary everything is evaluated anew (fallback).
    """
    if boundary is None or context_status(context, key) != "COMPLETE":
        return Plan("fallback")
    efforts = effort_changed.select(key).distinct().withColumn("_effort", F.lit(True))
    c = context.join(efforts, key, "left")
    day, last = F.lit(boundary[0]), F.lit(boundary[1])
    later = (F.col("dependency_start_date") > day) | ((F.col("dependency_start_date") == day) & (F.col(key) > last))
    append = (F.col("change_type") == "insert") & F.coalesce(later, F.lit(False))
    past = ~append
    any_ = lambda x: F.coalesce(F.bool_or(past & F.coalesce(x, F.lit(False))), F.lit(False))
    row = c.agg(
        F.count("*").alias("n"),
        F.count_if(past).alias("past"),
        F.min(F.when(past, F.col("dependency_start_date"))).alias("start"),
        any_((F.col("change_type") == "update") & ~F.col("activity_date_before").eqNullSafe(F.col("activity_date_after"))).alias("DATE_CHANGE"),
        any_(F.col("change_type") == "insert").alias("HISTORICAL_INSERT"),
        any_(F.col("power_classification_changed")).alias("POWER_ELIGIBILITY_CHANGE"),
        any_(F.col("_effort")).alias("BEST_EFFORT_CHANGE"),
    ).first()
    if row["n"] == 0:
        return Plan("no_change")
    if row["past"] == 0:
        return Plan("latest_append")
    return Plan("historical_closure", row["start"], next((r for r in REASONS[:-1] if row[r]), REASONS[-1]))


def closure(base: DataFrame, date: str, key: str, start) -> DataFrame:
    """All ids from the start date on, in order."""
    return base.where(F.col(date) >= F.lit(start)).select(date, key).orderBy(date, key)


def invalidate(state: DataFrame, date: str, start, reason: str) -> DataFrame:
    hit = F.coalesce(F.col(date) >= F.lit(start), F.lit(False))
    return state.withColumns({"evaluation_status": F.when(hit, "INVALIDATED").otherwise(F.col("evaluation_status")), "invalidation_reason": F.when(hit, reason).otherwise(F.col("invalidation_reason"))})


def state_summary(base: DataFrame, state: DataFrame, key: str) -> DataFrame:
    """One row: base rows, and how many are current, invalidated or without state."""
    both = base.select(key).join(state.select(key, "evaluation_status"), key, "left")
    s = F.col("evaluation_status")
    return both.agg(F.count("*").alias("rows"), F.count_if(s == "CURRENT").alias("current"), F.count_if(s == "INVALIDATED").alias("invalidated"), F.count_if(s.isNull()).alias("missing"))


def evaluation_debt(base: DataFrame, state: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Ids whose evaluation is missing, invalidated, without a signature, or disagrees with its number of facts."""
    counts = facts.groupBy(key).agg(F.count("*").alias("_facts"))
    both = base.select(key).join(state, key, "left").join(counts, key, "left")
    reason = (
        F.when(F.col("evaluation_status").isNull(), "missing")
        .when(F.col("evaluation_status") == "INVALIDATED", "invalidated")
        .when(F.trim(F.coalesce("input_signature", F.lit(""))) == "", "blank_signature")
        .when(F.coalesce("_facts", F.lit(0)) != F.col("achievement_count"), "count_mismatch")
    )
    return both.select(key, reason.alias("reason")).where("reason is not null")


def signature_mismatch(signatures: DataFrame, state: DataFrame, key: str, version: tuple[str, str] | None = None) -> DataFrame:
    s = state.select(key, F.col("input_signature").alias("_have"), "evaluation_status", *([version[0]] if version else []))
    reason = F.when(F.col("evaluation_status").isNull(), "missing").when(F.col("_have") != F.col("sig"), "changed").when(F.col("evaluation_status") != "CURRENT", "not_current")
    if version:
        reason = reason.when(~F.col(version[0]).eqNullSafe(F.lit(version[1])), "stale_upstream")
    return signatures.join(s, key, "left").select(key, reason.alias("reason")).where("reason is not null")


def orphan_facts(facts: DataFrame, base: DataFrame, key: str) -> DataFrame:
    return facts.select(key).distinct().join(base.select(key).distinct(), key, "left_anti")


def state_rows(evaluated: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """The evaluated ids as CURRENT state rows with their number of facts, 0 if none; for an upsert."""
    counts = facts.groupBy(key).agg(F.count("*").cast("int").alias("achievement_count"))
    return evaluated.join(counts, key, "left").withColumns({"achievement_count": F.coalesce("achievement_count", F.lit(0)), "evaluation_status": F.lit("CURRENT")})


def candidates(base: DataFrame, facts: DataFrame, efforts: DataFrame, key: str, date: str, mode: str, as_of: str | None = None, days: int = 30) -> DataFrame:
    """Ids to evaluate. conservative: without facts or with newer efforts; recent: of the last days; backfill: all."""
    if mode == "backfill":
        return base.select(key).distinct()
    if mode == "recent":
        return base.where(F.col(date) >= F.date_sub(F.lit(as_of).cast("date"), days)).select(key).distinct()
    none = F.lit(None)
    known = facts.where(F.col(key).isNotNull()).select(key, none.cast("boolean").alias("_base"), F.col("computed_at").alias("_f"), none.alias("_e"))
    newer = efforts.where(F.col(key).isNotNull()).select(key, none.cast("boolean").alias("_base"), none.alias("_f"), F.col("computed_at").alias("_e"))
    # one aggregate over all three: no table is joined, so a task holds one hash table and no sorted or broadcast copies
    each = base.select(key, F.lit(True).alias("_base"), none.alias("_f"), none.alias("_e")).unionByName(known).unionByName(newer)
    both = each.groupBy(key).agg(F.max("_base").alias("_base"), F.max("_f").alias("_f"), F.max("_e").alias("_e"))
    return both.where("_base and (_f is null or _e > _f)").select(key)


def candidate_audit(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side) of ids that only one of two selections has, as often as it has them; a null id is in no other selection."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    each = a.select(key, one.alias("_a"), none.alias("_b")).unionByName(b.select(key, none.alias("_a"), one.alias("_b")))
    counts = each.groupBy(key).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b")).where(F.col(key).isNull() | (F.col("_a") == 0) | (F.col("_b") == 0))
    sides = F.array(F.struct(F.lit("only_first").alias("side"), F.col("_a").alias("_n")), F.struct(F.lit("only_second").alias("side"), F.col("_b").alias("_n")))
    rows = counts.select(key, F.inline(sides)).where("_n > 0")
    # a repeated id comes back in pieces, so that no array is longer than a piece
    rows = rows.select(key, "side", "_n", F.explode(F.sequence(one, F.col("_n"), F.lit(PIECE).cast("long"))).alias("_at"))
    return rows.select(key, "side", F.explode(F.sequence("_at", F.least(F.col("_n"), F.col("_at") + PIECE - 1)))).select(key, "side")


def compare_facts(before: DataFrame, after: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """(key, difference): only_before, only_after, mismatched or equal."""
    b = before.select(*key, F.struct(*columns).alias("_b"))
    a = after.select(*key, F.struct(*columns).alias("_a"))
    kind = F.when(F.col("_a").isNull(), "only_before").when(F.col("_b").isNull(), "only_after").when(F.col("_a").eqNullSafe(F.col("_b")), "equal").otherwise("mismatched")
    return b.join(a, key, "full_outer").select(*key, kind.alias("difference"))


def changed_outputs(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Ids whose output differs in any of ``columns``; leave times of computation out of them."""
    return signature_diff(before, after, key, columns)


def lookups_due(referenced: DataFrame, observed: DataFrame, attempts: DataFrame, key: str, as_of: str, days: int) -> DataFrame:
    """Referenced ids never observed, whose last attempt, if any, is older than ``days`` days."""
    last = attempts.groupBy(key).agg(F.max("attempted_at").alias("_last"))
    ids = referenced.where(F.col(key).isNotNull()).select(key).distinct().join(observed, key, "left_anti").join(last, key, "left")
    return ids.where(F.col("_last").isNull() | (F.col("_last") < F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))).select(key)


def backfill_actions(rows: DataFrame, derived: dict[str, Column], payload_state: Column, unknown: Column) -> DataFrame:
    """What filling ``derived`` columns from a stored payload would do to each row: ``action``.

    already_populated, unparseable, unknown_source or update; a second run finds nothing to update.
    """
    filled = reduce(lambda a, c: a & F.col(c).isNotNull(), derived, F.lit(True))
    action = F.when(filled, "already_populated").when(payload_state != "ok", "unparseable").when(unknown, "unknown_source").otherwise("update")
    out = rows.withColumn("action", action)
    return out.withColumns({c: F.when(F.col("action") == "update", F.coalesce(F.col(c), v)).otherwise(F.col(c)) for c, v in derived.items()})
