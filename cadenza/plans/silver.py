"""Silver tables: activities with their power classification, streams, laps, gear."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import at, object_or_only, tri_state
from ..operators.joins import exists_flag, with_control_row
from ..operators.windows import latest_per_key

# Fixed values of the classification.
TRAINER_APP = "trainerroad"
OUTDOOR_SPORTS = ("Ride", "GravelRide", "MountainBikeRide", "EBikeRide", "Handcycle")
DEFAULT_RULE_VERSION = "power_source_classification_v1"
METRES_PER_MILE = 1609.344
KMH_PER_MS = 3.6
MPH_PER_MS = 2.2369362920544

# JSON type of each stream of samples, and its column.
STREAMS = {
    "time": ("int", "time_seconds"),
    "distance": ("double", "distance_metres"),
    "altitude": ("double", "altitude_metres"),
    "velocity_smooth": ("double", "velocity_smooth_metres_per_second"),
    "heartrate": ("int", "heartrate_bpm"),
    "cadence": ("int", "cadence_rpm"),
    "watts": ("int", "watts"),
    "temp": ("int", "temperature_celsius"),
    "moving": ("boolean", "is_moving"),
    "grade_smooth": ("double", "grade_smooth_percent"),
}


def power_evidence(activities: DataFrame, streams: DataFrame, laps: DataFrame, details: DataFrame) -> DataFrame:
    """Raw activities with what the classification looks at."""
    key = ["activity_id"]
    a = exists_flag(activities, streams.where("stream_type = 'watts'"), key, "has_watts_stream")
    a = exists_flag(a, streams.where("stream_type = 'latlng'"), key, "has_latlng_stream")
    a = exists_flag(exists_flag(exists_flag(a, streams, key, "has_streams"), laps, key, "has_laps"), details, key, "has_details")
    identity = F.lower(F.concat_ws(" ", *(F.coalesce(c, F.lit("")) for c in (F.col("activity_name"), at("raw_payload", "external_id"), at("raw_payload", "device_name")))))
    a = a.withColumns({"is_manual": tri_state(object_or_only("raw_payload", "manual")), "is_trainer": tri_state(object_or_only("raw_payload", "trainer")), "source_identity_text": identity})
    device = F.coalesce("is_device_watts", F.lit(False))
    app = F.col("source_identity_text").contains(TRAINER_APP)
    return a.withColumns(
        {
            "has_usable_power": device | F.col("average_power_watts").isNotNull() | F.col("weighted_average_power_watts").isNotNull() | F.col("has_watts_stream"),
            "is_trainer_app": app,
            "is_outdoor_power_candidate": F.col("sport_type").isin(*OUTDOOR_SPORTS) & ~F.coalesce("is_trainer", F.lit(False)) & F.col("has_latlng_stream") & ~app,
        }
    )


def ladder(*steps: tuple[Column, object], otherwise: object = None) -> Column:
    """The value of the first step that holds."""
    out = None
    for condition, value in steps:
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return out.otherwise(F.lit(otherwise))


def classify_power(evidence: DataFrame, control: DataFrame, overrides: DataFrame) -> DataFrame:
    """Seven governed outputs for each activity; an active override comes first, then the first rule that holds.

    ``control``: at most one active row with effective_cutover_at and rule_version. ``overrides``: activity_id,
    is_active and the override columns.
    """
    fields = ("power_source_type", "power_source_status", "is_measured_power", "is_power_record_eligible", "power_record_exclusion_reason", "power_classification_rule", "power_classification_method")
    o = overrides.where("is_active").select("activity_id", *(F.col(c).alias(f"_o_{c}") for c in fields))
    e = with_control_row(evidence, control.select("effective_cutover_at", "rule_version")).join(o, "activity_id", "left")

    cutover, start = F.col("effective_cutover_at"), F.col("start_datetime_utc")
    usable, app, outdoor = F.col("has_usable_power"), F.col("is_trainer_app"), F.col("is_outdoor_power_candidate") & F.col("is_device_watts")
    device, no_device = F.col("is_device_watts"), ~F.coalesce("is_device_watts", F.lit(False))
    after, before = device & (start >= cutover), device & (start < cutover)

    def by_rule(none, app_open, app_before, gps, open_, late, early, estimated, rest, override):
        return ladder((F.col(override).isNotNull(), F.col(override)), (~usable, none), (app & cutover.isNull(), app_open), (app & (start < cutover), app_before), (outdoor, gps), (cutover.isNull(), open_), (after, late), (before, early), (no_device & usable, estimated), otherwise=rest)

    no_cutover, app_virtual = "power_meter_cutover_unavailable", "trainerroad_virtual_power_before_roller_bike_power_cutover"
    flag = lambda c: ladder((F.col(c).isNotNull(), F.col(c)), (usable & outdoor, True), (usable & cutover.isNotNull() & after, True), otherwise=False)
    exclusion = by_rule("no_usable_power", no_cutover, app_virtual, None, no_cutover, None, "pre_cutover_device_watts_ambiguous", "strava_non_device_watts", "unknown_power_source", "_o_power_record_exclusion_reason")
    out = {
        "power_source_type": by_rule("none", "unknown", "virtual", "measured", "unknown", "measured", "unknown", "estimated", "unknown", "_o_power_source_type"),
        "power_source_status": by_rule("unavailable", "ambiguous", "inferred_virtual", "inferred_measured", "ambiguous", "inferred_measured", "ambiguous", "ambiguous", "ambiguous", "_o_power_source_status"),
        "is_measured_power": flag("_o_is_measured_power"),
        "is_power_record_eligible": flag("_o_is_power_record_eligible"),
        # the override's reason counts, even none, as soon as it overrides eligibility
        "power_record_exclusion_reason": F.when(F.col("_o_is_power_record_eligible").isNotNull(), F.col("_o_power_record_exclusion_reason")).otherwise(exclusion),
        "power_classification_rule": ladder(
            (F.col("_o_power_classification_rule").isNotNull(), F.col("_o_power_classification_rule")),
            (~usable, "no_usable_power"),
            (app & cutover.isNull(), no_cutover),
            (app & (start < cutover), app_virtual),
            (app & after, "trainerroad_at_or_after_roller_bike_power_cutover"),
            (outdoor & (start < cutover), "outdoor_device_watts_before_cutover"),
            (outdoor, "outdoor_device_watts_gps_evidence"),
            (cutover.isNull(), no_cutover),
            (after, "device_watts_at_or_after_power_meter_cutover"),
            (before, "pre_cutover_device_watts_ambiguous"),
            (no_device & usable, "strava_non_device_watts"),
            otherwise="unknown_power_source",
        ),
        "power_classification_method": ladder(
            (F.col("_o_power_classification_method").isNotNull(), F.col("_o_power_classification_method")),
            (app, "activity_name_or_payload_pattern"),
            (outdoor, "outdoor_gps_device_watts_evidence"),
            (usable & cutover.isNotNull(), "cutover_rule"),
            otherwise="source_field_fallback",
        ),
        "power_classification_version": F.coalesce("rule_version", F.lit(DEFAULT_RULE_VERSION)),
        "power_meter_cutover_at": cutover,
    }
    return e.withColumns(out).drop("effective_cutover_at", "rule_version", *(f"_o_{c}" for c in fields))


def silver_activities(classified: DataFrame) -> DataFrame:
    """Converted units, local date and time."""
    metres, speed = F.col("distance_metres"), F.col("average_speed_metres_per_second")
    return classified.withColumns(
        {
            "activity_type": F.col("sport_type"),
            "start_date_local": F.to_date("start_datetime_local"),
            "start_time_local": F.date_format("start_datetime_local", "HH:mm:ss"),
            "distance_kilometres": metres / 1000,
            "distance_miles": metres / METRES_PER_MILE,
            "average_speed_kilometres_per_hour": speed * KMH_PER_MS,
            "average_speed_miles_per_hour": speed * MPH_PER_MS,
        }
    ).drop("raw_payload", "source_identity_text")


def power_cutover(candidates: DataFrame, manual: DataFrame) -> DataFrame:
    """One control row: the earliest candidate ride (start, then id), the manual cutover, and which of them holds."""
    derived = candidates.agg(F.min(F.struct("start_datetime_utc", "activity_id")).alias("c")).select(F.col("c.start_datetime_utc").alias("derived_cutover_at"), F.col("c.activity_id").alias("supporting_activity_id"))
    return derived.join(F.broadcast(manual.limit(1).select("manual_cutover_at", "rule_version")), F.lit(True), "left").withColumn("effective_cutover_at", F.coalesce("manual_cutover_at", "derived_cutover_at"))


def cutover_candidates(evidence: DataFrame, gear_id: str) -> DataFrame:
    """Outdoor rides on the given gear with device watts."""
    return evidence.where(F.col("is_outdoor_power_candidate") & F.col("is_device_watts") & (F.col("gear_id") == gear_id) & (F.col("sport_type") != "VirtualRide"))


def widen_streams(raw: DataFrame, key: str = "activity_id") -> DataFrame:
    """Sample rows from one JSON array for each stream type: as many as the largest original size says.

    Short arrays are filled with nulls, positions become latitude and longitude. Rows: key, sample_index (from 1),
    a column for each stream, raw_stream_count, raw_max_original_size, raw_stream_retrieved_at.
    """
    types = [*STREAMS, "latlng"]
    payloads = [F.max(F.when(F.col("stream_type") == t, F.col("stream_payload"))).alias(f"_{t}") for t in types]
    wide = raw.groupBy(key).agg(*payloads, F.count("*").cast("int").alias("raw_stream_count"), F.max("original_size").alias("raw_max_original_size"), F.max("retrieved_at").alias("raw_stream_retrieved_at"))
    kinds = {"int": "array<double>", "double": "array<double>", "boolean": "array<boolean>"}
    wide = wide.withColumns({f"_{t}": F.from_json(f"_{t}", kinds[k]) for t, (k, _) in STREAMS.items()} | {"_latlng": F.from_json("_latlng", "array<array<double>>")})
    rows = wide.where("raw_max_original_size > 0").withColumn("sample_index", F.explode(F.sequence(F.lit(1), F.col("raw_max_original_size"))))
    i = F.col("sample_index") - 1
    values = {c: F.get(f"_{t}", i).cast("int" if k == "int" else k) for t, (k, c) in STREAMS.items()}
    values |= {"latitude": F.get(F.get("_latlng", i), F.lit(0)), "longitude": F.get(F.get("_latlng", i), F.lit(1))}
    return rows.select(key, "sample_index", *(v.alias(c) for c, v in values.items()), "raw_stream_count", "raw_max_original_size", "raw_stream_retrieved_at")


# Fixed values: (column, JSON field, type) of a lap.
LAP_FIELDS = (
    ("elapsed_time_seconds", "elapsed_time", "int"),
    ("moving_time_seconds", "moving_time", "int"),
    ("distance_metres", "distance", "double"),
    ("start_sample_index", "start_index", "int"),
    ("end_sample_index", "end_index", "int"),
    ("average_speed_metres_per_second", "average_speed", "double"),
    ("average_cadence_rpm", "average_cadence", "double"),
    ("average_power_watts", "average_watts", "double"),
    ("average_heartrate_bpm", "average_heartrate", "double"),
    ("maximum_heartrate_bpm", "max_heartrate", "double"),
    ("elevation_gain_metres", "total_elevation_gain", "double"),
)
LAP_VERSION = "strava_activity_laps_v3"


def type_laps(raw: DataFrame, activities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(laps, rejects). A value that is there but has the wrong type rejects its lap, with the reason.

    Offsets are seconds from the activity's start; the end is exclusive; either is null without its inputs.
    A payload's fields are read in one pass over it. Of an id that good laps share, one row a task meets the others: counts and, as a
    lap with an id of its own is its group's only row, maxima give the laps without a second pass.
    """
    p = F.col("lap_payload")
    fields = ("id", "lap_index", "name", "start_date", "start_date_local", "device_watts", *(f for _, f, _ in LAP_FIELDS))
    raw = raw.select("activity_id", F.col("lap_index").alias("_response"), p, F.json_tuple(p, *fields).alias(*(f"_f_{f}" for f in fields)))
    text = {f: F.col(f"_f_{f}") for f in fields} | {"activity.id": at(p, "activity.id")}
    number = {f: text[f].try_cast("double") for _, f, _ in LAP_FIELDS} | {"lap_index": text["lap_index"].try_cast("double")}
    device = tri_state(text["device_watts"])
    moment = lambda c: F.regexp_replace(F.regexp_replace(c, "T", " "), "Z$", "").try_cast("timestamp_ntz")
    utc, local = moment(text["start_date"]), moment(text["start_date_local"])
    index = number["lap_index"].try_cast("int")
    wrong = [F.when(text[f].isNotNull() & number[f].isNull(), F.lit(f"{f} is not numeric")) for f in number]
    reason = F.coalesce(
        F.when(F.try_parse_json(p).isNull(), "malformed payload"),
        F.when(~F.coalesce(text["id"].rlike("^[0-9]+$"), F.lit(False)) | text["id"].try_cast("long").isNull(), "missing or invalid lap id"),
        F.when(~text["activity.id"].eqNullSafe(F.col("activity_id").cast("string")), "activity mismatch"),
        *wrong,
        F.when(F.coalesce(index, F.lit(-1)) < 0, "missing or invalid lap index"),
        F.when(text["device_watts"].isNotNull() & device.isNull(), "device_watts is no boolean"),
        F.when((text["start_date"].isNotNull() & utc.isNull()) | (text["start_date_local"].isNotNull() & local.isNull()), "a start is no date and time"),
    )
    starts = activities.select("activity_id", F.col("start_datetime_utc").alias("_activity_start"))
    rows = raw.join(starts, "activity_id", "left").withColumn("reject_reason", reason)
    offset = F.bround((F.unix_micros(utc.cast("timestamp")) - F.unix_micros(F.col("_activity_start").cast("timestamp"))) / 1e6).cast("int")
    out = rows.select(
        text["id"].try_cast("long").alias("lap_id"),
        "activity_id",
        index.alias("lap_index"),
        F.col("_response").alias("raw_response_index"),
        F.when(F.trim(text["name"]) != "", text["name"]).alias("lap_name"),
        utc.alias("start_datetime_utc"),
        local.alias("start_datetime_local"),
        *(number[f].try_cast("int").alias(c) if t == "int" else number[f].alias(c) for c, f, t in LAP_FIELDS),
        offset.alias("start_time_seconds"),
        (offset + number["elapsed_time"].try_cast("int")).alias("end_time_seconds"),
        device.alias("is_device_watts"),
        F.sha2(p, 256).alias("raw_payload_hash"),
        F.lit(LAP_VERSION).alias("transform_version"),
        "reject_reason",
    )
    good = out.where("reject_reason is null").drop("reject_reason")
    by_id = good.groupBy("lap_id").agg(F.count("*").alias("_n"), *(F.max(c).alias(c) for c in good.columns if c != "lap_id"))
    repeated = by_id.where("_n > 1").select("lap_id", "_n")
    out = out.join(repeated, "lap_id", "left").withColumn("reject_reason", F.coalesce("reject_reason", F.when(F.col("_n") > 1, F.lit("repeated lap id")))).drop("_n")
    return by_id.where("_n = 1").select(*good.columns), out.where("reject_reason is not null")


def lap_power_provenance(power: Column, device: Column, parent: tuple[Column, Column, Column, Column]) -> Column:
    """parent: source type, source status, is measured, is eligible."""
    _, _, measured, eligible = parent
    unknown = parent[0].isNull() | parent[1].isNull() | measured.isNull() | eligible.isNull()
    return ladder((power.isNull(), "no_lap_power"), (unknown, "missing_canonical_context"), (device.isNull(), "source_assertion_missing"), (device & (~measured | ~eligible), "governed_override"), (~device & measured, "potential_inconsistency"), otherwise="expected_agreement")


def silver_gear(observations: DataFrame, runs: DataFrame) -> DataFrame:
    """The latest observation of each gear, when it was first and last seen, and whether the current collection
    of the latest successful run holds it; without a successful run all are historical."""
    latest_run = runs.where("status = 'SUCCESS'").agg(F.max("run_id").alias("_latest_run"))
    seen = observations.crossJoin(F.broadcast(latest_run))
    spans = seen.groupBy("gear_id").agg(
        F.min("first_observed_at").alias("first_seen_at"),
        F.max("last_observed_at").alias("last_seen_at"),
        F.coalesce(F.bool_or((F.col("run_id") == F.col("_latest_run")) & F.col("observed_in_current_collection")), F.lit(False)).alias("is_current"),
    )
    return latest_per_key(observations, ["gear_id"], ["last_observed_at", "gear_observation_id"]).join(spans, "gear_id")
