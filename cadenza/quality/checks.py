"""The named checks of the platform's tables, each one call of a family."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.json import object_or_only, tri_state
from ..operators.joins import interval_join
from ..operators.windows import latest_per_key
from ..plans import gold
from ..plans.silver import lap_power_provenance
from . import families as V
from .runner import Check

HEALTH = {
    "rhr": ("raw_daily_resting_heart_rate", "daily_resting_heart_rate_key", "resting_heart_rate_bpm"),
    "hrv": ("raw_daily_heart_rate_variability", "daily_heart_rate_variability_key", "average_hrv_milliseconds"),
    "respiratory_rate": ("raw_daily_respiratory_rate", "daily_respiratory_rate_key", "respiratory_rate_brpm"),
}
GRAIN = ["google_health_user_id", "source_data_point_id", "activity_date", "source_platform", "source_recording_method", "source_device_manufacturer", "source_device_model"]
LAP_MATCH = {"lap_name": "lap_name", "elapsed_time_seconds": "elapsed_time_seconds", "distance_metres": "distance_metres"}
TYPES = ["power_best_effort", *gold.RIDE_METRICS.values()]


def _check(name, severity, stage, tables, find, scope="publication"):
    return Check(name, severity, lambda t: find(*(t[n] for n in tables)), scope, stage, tuple(tables))


def _lap_power(laps, activities):
    parent = activities.select("activity_id", "power_source_type", "power_source_status", "is_measured_power", "is_power_record_eligible")
    kind = lap_power_provenance(F.col("average_power_watts"), F.col("is_device_watts"), tuple(F.col(c) for c in parent.columns[1:]))
    return laps.select("activity_id", "lap_id", "average_power_watts", "is_device_watts").join(parent, "activity_id", "left").select(kind.alias("category")).groupBy("category").agg(F.count("*").alias("issue_count")).where("category <> 'expected_agreement'")


def _telemetry(laps, streams):
    inside = interval_join(streams.select("activity_id", "time_seconds", "watts"), laps.select("activity_id", "lap_id", "start_time_seconds", "end_time_seconds", F.col("average_power_watts").alias("_lap")), "activity_id", "time_seconds", "start_time_seconds", "end_time_seconds")
    return inside.groupBy("lap_id").agg(F.avg("watts").alias("telemetry"), F.max("_lap").alias("lap")).withColumn("difference", F.abs(F.col("telemetry") - F.col("lap"))).where("difference > 5")


def _latest_gear(silver, raw):
    return V.agrees(silver, latest_per_key(raw, ["gear_id"], ["last_observed_at", "gear_observation_id"]), ["gear_id"], {"gear_name": "gear_name", "distance_metres": "distance_metres"})


def platform_checks(as_of: str, gear_id: str) -> list[Check]:
    """All checks that need data; ``gear_id``: the gear that may set the power cutover."""
    checks = []
    add = lambda *a, **k: checks.append(_check(*a, **k))
    for table in ("silver_activity_laps", "raw_exercise", "gold_activity_best_efforts", "gold_activity_achievements", "activity_achievement_evaluation_state"):
        checks.append(Check(f"{table}_table_exists", "CRITICAL", lambda t, n=table: V.expected_tables(t, {n: []}, next(iter(t.values())).sparkSession), stage="preflight"))
    checks.append(Check("silver_schema_has_no_persistent_working_tables", "CRITICAL", lambda t: V.forbidden_names(t, r"_(working|tmp|backup)$", next(iter(t.values())).sparkSession), stage="preflight"))

    laps, acts, streams, gear = "silver_activity_laps", "silver_activities", "silver_activity_streams", "silver_gear"
    raw, raw_laps, raw_streams, raw_gear = "raw_activities", "raw_activity_laps", "raw_activity_streams", "raw_gear_observations"
    success = lambda c: F.col(f"{c}_status") == "SUCCESS"
    add("silver_activity_laps_required_fields_valid", "CRITICAL", "silver", [laps], lambda l: V.required(l, ["lap_id", "activity_id", "lap_index"], (F.col("lap_index") >= 0) & F.coalesce(F.col("elapsed_time_seconds") >= 0, F.lit(True)), ["lap_id", "activity_id", "lap_index"]))
    add("silver_activity_laps_key_uniqueness", "CRITICAL", "silver", [laps], lambda l: V.unique_key(l, ["lap_id"]))
    add("silver_activity_laps_parent_activity_resolves", "CRITICAL", "silver", [laps, acts], lambda l, a: V.orphans(l, a, ["activity_id"]))
    add("silver_activity_laps_source_identifier_alignment", "CRITICAL", "silver", [raw_laps], lambda r: V.column_matches(r, {"activity_id": F.get_json_object("lap_payload", "$.activity.id").try_cast("long")}, ["activity_id", "lap_index"]))
    add("raw_success_laps_missing_from_silver", "CRITICAL", "silver", [raw_laps, laps], lambda r, l: V.missing_downstream(r, l, ["activity_id"]))
    add("silver_activity_manual_source_alignment", "CRITICAL", "silver", [raw, acts], lambda r, a: V.agrees(a, r.select("activity_id", tri_state(object_or_only("raw_payload", "manual")).alias("_m")), ["activity_id"], {"is_manual": "_m"}))
    add("raw_activities_missing_from_silver", "CRITICAL", "silver", [raw, acts], lambda r, a: V.missing_downstream(r, a, ["activity_id"]))
    add("silver_activities_has_streams_without_stream_rows", "CRITICAL", "silver", [acts, streams], lambda a, s: V.missing_downstream(a, s, ["activity_id"], F.col("has_streams")))
    add("silver_gear_required_fields_valid", "CRITICAL", "silver", [gear], lambda g: V.required(g, ["gear_id", "gear_name"], F.length("gear_id") > 0, ["gear_id"]))
    add("activity_gear_ids_unresolved", "WARNING", "silver", [acts, gear], lambda a, g: V.unresolved_refs(a, "gear_id", g, "gear_id"))
    add("silver_activity_laps_index_continuity", "INFO", "silver", [laps], lambda l: V.index_continuity(l, "activity_id", "lap_index"), scope="deep")
    add("silver_activity_laps_raw_reconciliation", "CRITICAL", "silver", [laps, raw_laps], lambda l, r: V.agrees(l.withColumn("response", F.col("raw_response_index")), r.select("activity_id", F.col("lap_index").alias("response"), F.sha2("lap_payload", 256).alias("_h")), ["activity_id", "response"], {"raw_payload_hash": "_h"}), scope="deep")
    add("silver_activities_has_laps_without_lap_rows", "WARNING", "silver", [acts, laps], lambda a, l: V.missing_downstream(a, l, ["activity_id"], F.col("has_laps")), scope="deep")
    add("raw_lap_response_payload_index_difference", "INFO", "silver", [raw_laps], lambda r: V.column_matches(r, {"lap_index": F.get_json_object("lap_payload", "$.lap_index").try_cast("int")}, ["activity_id", "lap_index"]), scope="deep")
    add("silver_activity_laps_index_start_distribution", "INFO", "silver", [laps], lambda l: V.first_index_distribution(l, "activity_id", "lap_index"), scope="deep")
    add("silver_activity_laps_adjacent_boundary_differences", "INFO", "silver", [laps], lambda l: V.adjacent_boundaries(l, "activity_id", "lap_index", "start_time_seconds", "end_time_seconds"), scope="deep")
    add("silver_activity_laps_time_boundaries_outside_stream_range", "INFO", "silver", [laps, streams], lambda l, s: V.outside_range(l, s, "activity_id", "time_seconds", "start_time_seconds", "end_time_seconds"), scope="deep")
    add("silver_activity_laps_parent_summary_reconciliation", "INFO", "silver", [laps, acts], lambda l, a: V.parent_summary(l, a, "activity_id", {"distance": (F.col("distance_metres"), "distance_metres"), "moving": (F.col("moving_time_seconds"), "moving_time_seconds")}, 1.0), scope="deep")
    add("silver_activity_laps_telemetry_boundary_reconciliation", "INFO", "silver", [laps, streams], _telemetry, scope="deep")
    add("silver_activity_laps_power_provenance_reconciliation", "INFO", "silver", [laps, acts], _lap_power, scope="deep")
    add("silver_activity_laps_coverage_and_reconciliation", "INFO", "silver", [acts, laps], lambda a, l: V.flag_vs_exists(a, "has_laps", l, ["activity_id"]), scope="deep")
    add("raw_gear_duplicate_business_key", "CRITICAL", "silver", [raw_gear], lambda g: V.unique_key(g, ["gear_id", "payload_hash"]))
    add("silver_gear_duplicate_key", "CRITICAL", "silver", [gear], lambda g: V.unique_key(g, ["gear_id"]))
    add("silver_gear_latest_raw_observation_mismatch", "CRITICAL", "silver", [gear, raw_gear], _latest_gear)
    add("silver_activity_has_streams_status_mismatch", "CRITICAL", "silver", [acts, raw_streams], lambda a, s: V.flag_vs_exists(a, "has_streams", s, ["activity_id"]))
    add("silver_streams_without_silver_activities", "CRITICAL", "silver", [streams, acts], lambda s, a: V.orphans(s.select("activity_id").distinct(), a, ["activity_id"]))
    add("silver_stream_duplicate_activity_sample", "CRITICAL", "silver", [streams], lambda s: V.unique_key(s, ["activity_id", "sample_index"]))
    add("raw_and_silver_activity_counts_match", "CRITICAL", "silver", [raw, acts], V.count_parity)
    add("raw_success_streams_missing_from_silver", "CRITICAL", "silver", [raw, streams], lambda r, s: V.missing_downstream(r, s, ["activity_id"], success("stream")))
    add("raw_success_stream_expected_count_mismatch", "CRITICAL", "silver", [raw_streams, streams], lambda r, s: V.expected_count(r.groupBy("activity_id").agg(F.max("original_size").cast("long").alias("expected_rows")), s, ["activity_id"]))

    add("raw_exercise_duplicate_keys", "CRITICAL", "silver", ["raw_exercise"], lambda e: V.unique_key(e, ["exercise_observation_key"]))
    add("raw_exercise_required_fields_valid", "CRITICAL", "silver", ["raw_exercise"], lambda e: V.required(e, ["exercise_observation_key", "source_data_point_id", "exercise_payload"], None, ["exercise_observation_key"]))
    add("raw_exercise_interval_valid", "CRITICAL", "silver", ["raw_exercise"], lambda e: V.ordered(e, "interval_start_time", "interval_end_time"))
    add("raw_exercise_recent_request_success", "WARNING", "silver", ["run_log"], lambda g: V.recent_success(g, "exercise", as_of, 7))
    for name, (table, key, measure) in HEALTH.items():
        add(f"raw_{name}_duplicate_keys", "CRITICAL", "silver", [table], lambda d, k=key: V.unique_key(d, [k]))
        add(f"raw_{name}_required_fields_valid", "CRITICAL", "silver", [table], lambda d, k=key, m=measure: V.required(d, [k, "activity_date"], F.coalesce(F.col(m) > 0, F.lit(True)), [k]))
        add(f"raw_{name}_duplicate_source_grain", "CRITICAL", "silver", [table], lambda d, t=table: V.unique_key(d.withColumn("_content", F.sha2(t.removeprefix("raw_") + "_payload", 256)), [*GRAIN, "_content"]))
        add(f"raw_{name}_source_provenance_missing", "WARNING", "silver", [table], lambda d, k=key: V.required(d, ["source_ecosystem"], F.col("source_ecosystem") != "unknown", [k, "source_ecosystem"]), scope="deep")
        add(f"raw_{name}_multiple_ecosystems_per_date", "INFO", "silver", [table], lambda d: V.multi_source(d, ["activity_date"], "source_ecosystem"), scope="deep")
    add("raw_respiratory_rate_recent_coverage", "WARNING", "silver", ["run_log"], lambda g: V.recent_success(g, "daily_respiratory_rate", as_of, 7), scope="deep")
    days = ["raw_daily_resting_heart_rate", "raw_daily_heart_rate_variability"]
    add("raw_rhr_hrv_sleep_date_overlap", "WARNING", "silver", [*days, "raw_sleep_logs"], lambda a, b, s: V.no_overlap({"rhr": a, "hrv": b, "sleep": s.withColumn("activity_date", F.col("end_civil_date"))}, "activity_date"), scope="deep")
    add("raw_recovery_partial_date_coverage", "INFO", "silver", days, lambda a, b: V.partial_coverage({"rhr": a, "hrv": b}, "activity_date"), scope="deep")
    add("raw_sleep_stage_metadata_valid", "WARNING", "silver", ["raw_sleep_logs"], lambda s: V.implies(s, F.lit(True), F.col("has_sleep_stages") == (F.col("sleep_stage_count") > 0)), scope="deep")
    add("raw_daily_entities_recent_failures", "WARNING", "silver", ["run_log"], lambda g: V.recent_failures(g, ["daily_resting_heart_rate", "daily_heart_rate_variability", "daily_respiratory_rate"], as_of, 7), scope="deep")

    eff, facts, state = "gold_activity_best_efforts", "gold_activity_achievements", "activity_achievement_evaluation_state"
    key = ["activity_id", "metric_name", "duration_seconds"]
    business = ["activity_id", "achievement_type", "metric_name", "duration_seconds", "comparison_scope", "comparison_period_start", "comparison_period_end"]
    power = F.col("metric_name") == "watts"
    for name, upstream in (("gold_activity_best_efforts", ["silver_activity_streams", "silver_activities"]), ("gold_activity_achievements", ["gold_activity_best_efforts"])):
        add(f"{name}_latest_transform_success", "CRITICAL", "gold", ["run_log"], lambda g, n=name: V.log_state(g, n))
        add(f"{name}_latest_transform_fresh", "CRITICAL", "gold", ["run_log"], lambda g, n=name, u=upstream: V.stale(g, n, u))
    add("gold_activity_best_efforts_latest_batches_success", "CRITICAL", "gold", ["batch_log"], lambda b: b.where("entity = 'gold_activity_best_efforts' and status <> 'SUCCESS'").groupBy("run_id").agg(F.count("*").alias("issue_count")).orderBy(F.col("run_id").desc()).limit(1))
    add("gold_best_efforts_duplicate_primary_key", "CRITICAL", "gold", [eff], lambda e: V.unique_key(e, key))
    add("gold_best_efforts_peak_value_valid", "CRITICAL", "gold", [eff], lambda e: V.required(e, ["peak_value"], F.col("peak_value") >= 0, key))
    add("gold_best_efforts_window_indexes_valid", "CRITICAL", "gold", [eff], lambda e: V.ordered(e, "start_sample_index", "end_sample_index"))
    add("gold_best_efforts_window_times_valid", "CRITICAL", "gold", [eff], lambda e: V.ordered(e, "start_time_seconds", "end_time_seconds"))
    add("gold_best_efforts_sample_count_valid", "CRITICAL", "gold", [eff], lambda e: V.required(e, ["sample_count"], F.col("sample_count") == F.col("duration_seconds"), key))
    add("gold_best_efforts_gps_provenance_present", "CRITICAL", "gold", [eff, acts], lambda e, a: e.join(a.where("has_latlng_stream").select("activity_id"), "activity_id", "left_semi").groupBy("activity_id").agg(F.count("start_latitude").alias("n")).where("n = 0"))
    add("gold_activity_best_efforts_orphaned_activity_ids", "CRITICAL", "gold", [eff, acts], lambda e, a: V.orphans(e.select("activity_id").distinct(), a, ["activity_id"]))
    add("gold_activity_best_efforts_metric_names_valid", "CRITICAL", "gold", [eff], lambda e: V.accepted_values(e, "metric_name", list(gold.METRICS)))
    add("gold_activity_best_efforts_durations_valid", "CRITICAL", "gold", [eff], lambda e: V.accepted_values(e, "duration_seconds", list(gold.DURATIONS)))
    add("gold_activity_best_efforts_calculation_version_current", "CRITICAL", "gold", [eff], lambda e: V.version_current(e, "calculation_version", gold.EFFORTS_VERSION))
    add("gold_activity_best_efforts_watts_eligibility_matches_silver", "CRITICAL", "gold", [eff, acts], lambda e, a: V.agrees(e.where(power), a.select("activity_id", "is_power_record_eligible"), ["activity_id"], {"is_record_eligible": "is_power_record_eligible"}))
    add("gold_activity_best_efforts_non_watts_not_excluded", "CRITICAL", "gold", [eff], lambda e: V.implies(e, ~power, F.col("is_record_eligible") & F.col("record_exclusion_reason").isNull()))
    add("gold_activity_best_efforts_exclusions_have_reason", "CRITICAL", "gold", [eff], lambda e: V.implies(e, ~F.col("is_record_eligible"), F.length("record_exclusion_reason") > 0))
    for metric in gold.METRICS:
        present = lambda s, m=metric: s.where(F.col(m).isNotNull()).groupBy("activity_id").agg(F.count("*").alias("samples"))
        add(f"gold_best_efforts_{metric}_presence", "CRITICAL", "gold", [streams, eff], lambda s, e, m=metric, p=present: V.missing_downstream(p(s).where(f"samples >= {min(gold.DURATIONS)}"), e.where(F.col("metric_name") == m), ["activity_id"]), scope="deep")
        # an effort of N rows needs N values in a row, so the longest run without a null says which durations must be there
        gap = lambda m: F.sum(F.col(m).isNull().cast("int")).over(Window.partitionBy("activity_id").orderBy("sample_index"))
        runs = lambda s, m=metric, g=gap: s.select("activity_id", m, g(m).alias("_gap")).groupBy("activity_id", "_gap").agg(F.count(m).alias("_n")).groupBy("activity_id").agg(F.max("_n").alias("samples"))
        add(f"gold_best_efforts_{metric}_duration_coverage", "CRITICAL", "gold", [streams, eff], lambda s, e, m=metric, r=runs: V.coverage(r(s), "activity_id", "samples", e.where(F.col("metric_name") == m), list(gold.DURATIONS)), scope="deep")
    control = "power_source_classification"
    support = lambda c, a: c.join(a, F.col("supporting_activity_id") == F.col("activity_id"))
    add("trainerroad_power_cutover_supporting_gear_valid", "CRITICAL", "gold", [control, acts], lambda c, a: support(c, a).where(~F.col("gear_id").eqNullSafe(F.lit(gear_id))).select("activity_id", "gear_id"))
    add("trainerroad_power_cutover_not_set_by_other_gear", "CRITICAL", "gold", [control, acts], lambda c, a: support(c, a).where((F.col("gear_id") != gear_id) & (F.col("derived_cutover_at") == F.col("start_datetime_utc"))).select("activity_id", "gear_id"))
    add("trainerroad_power_cutover_selected_earliest_roller_bike_candidate", "CRITICAL", "gold", [control, acts], lambda c, a: a.where((F.col("gear_id") == gear_id) & F.col("is_outdoor_power_candidate") & F.col("is_device_watts")).agg(F.min("start_datetime_utc").alias("_first")).crossJoin(F.broadcast(c.limit(1))).where(~F.col("_first").eqNullSafe(F.col("derived_cutover_at"))).select("_first", "derived_cutover_at"))
    add("trainerroad_power_cutover_candidate_not_indoor_or_virtual", "CRITICAL", "gold", [control, acts], lambda c, a: support(c, a).where(F.coalesce("is_trainer", F.lit(False)) | (F.col("sport_type") == "VirtualRide") | F.col("is_trainer_app")).select("activity_id"))
    virtual = "trainerroad_virtual_power_before_roller_bike_power_cutover"
    add("trainerroad_power_pre_cutover_exclusion_only_applies_to_trainerroad", "CRITICAL", "gold", [acts], lambda a: V.implies(a, F.col("power_record_exclusion_reason") == virtual, F.col("is_trainer_app")))
    add("trainerroad_power_pre_cutover_trainerroad_not_eligible", "CRITICAL", "gold", [acts], lambda a: V.implies(a, F.col("is_trainer_app") & (F.col("start_datetime_utc") < F.col("power_meter_cutover_at")) & ~F.col("power_classification_method").contains("override"), ~F.col("is_power_record_eligible")))
    add("power_source_pre_cutover_outdoor_device_watts_preserved", "CRITICAL", "gold", [acts], lambda a: V.implies(a, F.col("is_outdoor_power_candidate") & F.col("is_device_watts") & (F.col("start_datetime_utc") < F.col("power_meter_cutover_at")) & ~F.col("power_classification_method").contains("override"), F.col("is_measured_power")))

    add("gold_activity_achievements_duplicate_business_key", "CRITICAL", "gold", [facts], lambda f: V.unique_key(f, business))
    add("gold_activity_achievements_orphaned_activity_ids", "CRITICAL", "gold", [facts, acts], lambda f, a: V.orphans(f, a, ["activity_id"]))
    add("gold_activity_achievements_types_valid", "CRITICAL", "gold", [facts], lambda f: V.accepted_values(f, "achievement_type", TYPES))
    add("gold_activity_achievements_scopes_valid", "CRITICAL", "gold", [facts], lambda f: V.accepted_values(f, "comparison_scope", ["all_time", "calendar_year"]))
    add("gold_activity_achievements_power_durations_valid", "CRITICAL", "gold", [facts], lambda f: V.accepted_values(f.where("achievement_type = 'power_best_effort'"), "duration_seconds", list(gold.DURATIONS)))
    add("gold_activity_achievements_values_valid", "CRITICAL", "gold", [facts], lambda f: V.required(f, ["metric_value", "activity_date"], (F.col("metric_value") > 0) & F.coalesce(F.col("days_since_previous_best") >= 0, F.lit(True)), ["activity_achievement_key"]))
    add("gold_activity_achievements_calculation_version_current", "CRITICAL", "gold", [facts], lambda f: V.version_current(f, "calculation_version", gold.ACHIEVEMENTS_VERSION))
    add("gold_activity_achievements_power_eligible_only", "CRITICAL", "gold", [facts, eff], lambda f, e: f.where("achievement_type = 'power_best_effort'").select("activity_id", "duration_seconds").distinct().join(e.where(power & F.col("is_record_eligible")).select("activity_id", "duration_seconds"), ["activity_id", "duration_seconds"], "left_anti"))
    add("activity_achievement_evaluation_state_valid", "CRITICAL", "gold", [state], lambda s: V.implies(s, F.col("evaluation_status") == "CURRENT", F.length(F.trim("input_signature")) > 0))
    add("activity_achievement_evaluation_state_complete_when_initialized", "CRITICAL", "gold", [acts, state], lambda a, s: V.missing_downstream(a.where("start_date_local is not null").join(s.limit(1).select(F.lit(1).alias("_any")), F.lit(True), "left_semi"), s, ["activity_id"]))
    counts = lambda f: f.groupBy("activity_id").agg(F.count("*").cast("int").alias("_n"))
    add("activity_achievement_evaluation_fact_count_reconciled", "CRITICAL", "gold", [state, facts], lambda s, f: s.join(counts(f), "activity_id", "left").where("evaluation_status = 'CURRENT' and achievement_count <> coalesce(_n, 0)").select("activity_id", "achievement_count", "_n"))
    add("achievement_facts_have_evaluation_state", "CRITICAL", "gold", [facts, state], lambda f, s: V.orphans(f.select("activity_id").distinct(), s, ["activity_id"]))
    return checks
