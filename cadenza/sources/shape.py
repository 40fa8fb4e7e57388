"""Shaping of landed JSON responses. Each function takes rows with a JSON text column ``payload`` (and run_id,
source_id, retrieved_at) and returns typed rows; what lacks a required field goes to a second DataFrame of rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys
from ..functions.json import at, boolean_word, civil_date, either_case, first_of, instant

LINEAGE = ("run_id", "source_id", "retrieved_at")

# Fixed values: (column, JSON field, type) of an activity summary.
ACTIVITY_FIELDS = (
    ("activity_id", "id", "long"),
    ("athlete_id", "athlete.id", "long"),
    ("activity_name", "name", "string"),
    ("sport_type", "sport_type", "string"),
    ("timezone_name", "timezone", "string"),
    ("distance_metres", "distance", "double"),
    ("moving_time_seconds", "moving_time", "int"),
    ("elapsed_time_seconds", "elapsed_time", "int"),
    ("elevation_gain_metres", "total_elevation_gain", "double"),
    ("average_speed_metres_per_second", "average_speed", "double"),
    ("average_cadence_rpm", "average_cadence", "double"),
    ("average_heartrate_bpm", "average_heartrate", "double"),
    ("average_power_watts", "average_watts", "double"),
    ("weighted_average_power_watts", "weighted_average_watts", "double"),
    ("energy_kilojoules", "kilojoules", "double"),
    ("gear_id", "gear_id", "string"),
)
GEAR_FIELDS = (
    ("gear_id", "id", "string"),
    ("gear_name", "name", "string"),
    ("is_primary", "primary", "boolean"),
    ("distance_metres", "distance", "double"),
    ("brand_name", "brand_name", "string"),
    ("model_name", "model_name", "string"),
    ("frame_type", "frame_type", "int"),
    ("description", "description", "string"),
    ("resource_state", "resource_state", "int"),
)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed response files, one document each: (file, payload)."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("payload"))


def elements(pages: DataFrame, *fields: str) -> DataFrame:
    """A row for each element of a page's array: of the page itself, or of the first of its fields that is there."""
    source = first_of("payload", list(fields)) if fields else F.col("payload")
    out = pages.withColumn("_a", F.from_json(source, "array<string>"))
    rest = [c for c in pages.columns if c != "payload"]
    return out.select(*rest, F.posexplode("_a").alias("_pos", "payload")).withColumn("response_index", F.col("_pos") + 1).drop("_pos")


def data_points(pages: DataFrame) -> DataFrame:
    """The points of all pages, in camel or snake case."""
    return elements(pages, "dataPoints", "data_points")


def _typed(field: str, kind: str) -> Column:
    value = at("payload", field)
    if kind == "int":  # numbers are cut towards zero
        return value.try_cast("double").try_cast("int")
    return value if kind == "string" else value.try_cast(kind)


def _split(rows: DataFrame, valid: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    good = F.coalesce(valid, F.lit(False))
    return rows.where(good), rows.where(~good).withColumn("reject_reason", F.lit(reason))


def activities(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row for each activity of a response; fields it lacks are null, the payload stays as text."""
    rows = elements(pages)
    out = rows.select(
        *(c for c in LINEAGE if c in rows.columns),
        *(_typed(f, t).alias(c) for c, f, t in ACTIVITY_FIELDS),
        instant(at("payload", "start_date")).alias("start_datetime_utc"),
        instant(at("payload", "start_date_local")).alias("start_datetime_local"),
        boolean_word(at("payload", "device_watts")).alias("is_device_watts"),
        *(F.lit("PENDING").alias(f"{child}_status") for child in ("stream", "details", "laps")),
        F.col("payload").alias("raw_payload"),
    )
    return _split(out, F.col("activity_id").isNotNull(), "missing activity id")


def streams(responses: DataFrame, key: str = "activity_id") -> DataFrame:
    """(key, stream_type, series_type, original_size, resolution, stream_payload) of a response keyed by stream type."""
    parsed = responses.withColumn("_m", F.from_json("payload", "map<string,struct<data:string,series_type:string,original_size:int,resolution:string>>"))
    rest = [c for c in LINEAGE if c in responses.columns]
    out = parsed.select(key, *rest, F.explode("_m").alias("stream_type", "_s"))
    return out.select(key, *rest, "stream_type", F.col("_s.series_type"), F.col("_s.original_size"), F.col("_s.resolution"), F.col("_s.data").alias("stream_payload"))


def laps(responses: DataFrame, key: str = "activity_id") -> tuple[DataFrame, DataFrame]:
    """(laps in response order from 1, keys whose response has none)."""
    rows = elements(responses).select(key, *(c for c in LINEAGE if c in responses.columns), F.col("response_index").alias("lap_index"), F.col("payload").alias("lap_payload"))
    none = responses.where(F.coalesce(F.json_array_length("payload"), F.lit(0)) == 0).select(key)
    return rows, none


def details(responses: DataFrame, key: str = "activity_id") -> DataFrame:
    return responses.select(key, *(c for c in LINEAGE if c in responses.columns), F.col("payload").alias("details_payload"))


def gear(objects: DataFrame, gear_type: Column, current: Column) -> tuple[DataFrame, DataFrame]:
    """Typed observations with a hash of the content; id and name are required."""
    out = objects.select(
        *(c for c in LINEAGE if c in objects.columns),
        *(_typed(f, t).alias(c) for c, f, t in GEAR_FIELDS),
        gear_type.alias("gear_type"),
        current.alias("observed_in_current_collection"),
        F.col("payload").alias("source_payload"),
        F.sha2("payload", 256).alias("payload_hash"),
    )
    return _split(out, (F.length("gear_id") > 0) & (F.length("gear_name") > 0), "missing gear id or name")


def gear_collection(athletes: DataFrame) -> DataFrame:
    """(gear_type, payload) of the current bikes and shoes."""
    parts = [elements(athletes, field).withColumn("gear_type", F.lit(kind)) for field, kind in (("bikes", "bike"), ("shoes", "shoes"))]
    return parts[0].unionByName(parts[1])


def referenced_gear(collection: DataFrame, historical: DataFrame) -> DataFrame:
    """Ids of the current collection and of what activities refer to."""
    return collection.select(at("payload", "id").alias("gear_id")).unionByName(historical.select("gear_id")).where("gear_id is not null").distinct()


def heart_rate_days(pages: DataFrame) -> DataFrame:
    """One response row for each user, day and level of detail, its pages in order."""
    key = ["source_id", "fitbit_user_id", "activity_date", "detail_level"]
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("page", "payload"))), lambda p: p["payload"])
    out = pages.groupBy(*key).agg(ordered.alias("_pages"), F.max("run_id").alias("run_id"), F.max("retrieved_at").alias("retrieved_at"))
    payload = F.concat(F.lit('{"pages":['), F.array_join("_pages", ","), F.lit("]}"))
    return out.withColumn("heart_rate_payload", payload).drop("_pages")


def heart_rate_samples(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, rejects): one row for each heart-rate sample of responses whose ``heart_rate_payload`` holds pages of points.

    A sample is told by its source, user, point name, time, rate and source name. Responses overlap, so of a sample that comes
    more than once the row of the latest response counts (a tie goes to the greater response key, then place). A response is told by
    source, user, date and level. A sample needs a time and a whole rate. Its local date is its civil date or else that of the time moved by
    the offset (seconds as ``3600s``); it is null without either. Empty or malformed payloads give no rows.
    """
    paths = lambda *p: [(root, *q) for root in ("heartRate", "heart_rate") for q in either_case(*p)]
    of_response = ["source_id", "google_health_user_id", "activity_date", "detail_level", "retrieved_at"]
    pages = elements(responses.select(*of_response, F.col("heart_rate_payload").alias("payload")), "pages").withColumnRenamed("response_index", "_page")
    points = data_points(pages)
    offset = first_of("payload", paths("sampleTime", "utcOffset"))
    read = points.select(
        *of_response,
        "_page",
        F.col("response_index").alias("_point"),
        at("payload", "name").alias("source_data_point_id"),
        first_of("payload", ["dataSource.name", "data_source.name", "source.name"]).alias("source_name"),
        instant(first_of("payload", paths("sampleTime", "physicalTime"))).alias("sample_datetime_utc"),
        offset.alias("sample_utc_offset"),
        civil_date(first_of("payload", paths("sampleTime", "civilTime", "date"))).alias("_civil"),
        first_of("payload", paths("beatsPerMinute")).try_cast("int").alias("heart_rate_bpm"),
        "payload",
    )
    sample = keys.key(*(F.col(c) for c in ("source_id", "google_health_user_id", "source_data_point_id", "sample_datetime_utc", "heart_rate_bpm", "source_name")))
    response = keys.key(*(F.col(c) for c in of_response[:4]))
    good, rejects = _split(read, F.col("sample_datetime_utc").isNotNull() & F.col("heart_rate_bpm").isNotNull(), "missing sample time or rate")
    moved = F.col("sample_datetime_utc") + F.make_dt_interval(secs=F.regexp_extract("sample_utc_offset", r"^(-?\d+)(?:\.\d+)?s$", 1).try_cast("decimal(18,6)"))
    row = F.struct(
        F.col("retrieved_at").alias("raw_retrieved_at"),
        response.alias("raw_response_key"),
        *("_page", "_point", "sample_utc_offset"),
        F.coalesce("_civil", moved.cast("date")).alias("sample_date_local"),
        F.col("activity_date").alias("raw_activity_date"),
        F.col("detail_level").alias("raw_detail_level"),
    )
    of_sample = ["source_id", "google_health_user_id", "source_data_point_id", "source_name", "sample_datetime_utc", "heart_rate_bpm"]
    latest = good.groupBy(sample.alias("heart_rate_sample_key"), *of_sample).agg(F.max(row).alias("_r"))
    out = latest.select("heart_rate_sample_key", *of_sample, F.to_date("sample_datetime_utc").alias("sample_date_utc"), "_r.*").drop("_page", "_point")
    return out, rejects.select(*of_response, "payload", "reject_reason")


def source_field(*field: str) -> Column:
    """A field of the data source, under any of its names."""
    paths = [(root, *p) for root in ("dataSource", "data_source", "source") for p in either_case(*field)]
    return first_of("payload", paths)


def ecosystem(platform: Column, manufacturer: Column) -> Column:
    platform, manufacturer = F.upper(platform), F.lower(manufacturer)
    return (
        F.when(platform == "FITBIT", "fitbit")
        .when(platform == "HEALTH_KIT", "apple_health")
        .when(platform == "GOOGLE_FIT", "google_fit")
        .when(manufacturer.contains("apple"), "apple_health")
        .when(manufacturer.contains("fitbit"), "fitbit")
        .otherwise("unknown")
    )


def provenance() -> dict[str, Column]:
    platform, manufacturer = source_field("platform"), source_field("device", "manufacturer")
    return {
        "source_ecosystem": ecosystem(platform, manufacturer),
        "source_platform": platform,
        "source_recording_method": source_field("recordingMethod"),
        "source_device_manufacturer": manufacturer,
        "source_device_model": source_field("device", "model"),
    }


def _under(*path: str, roots: tuple[tuple[str, ...], ...] = (("sleep",), ())) -> list[tuple[str, ...]]:
    return [(*root, *p) for root in roots for p in either_case(*path)]


def sleep_logs(points: DataFrame) -> DataFrame:
    """One row for each sleep log; each field comes from the first of its paths that is there."""
    time = lambda end: first_of("payload", [p for root in (("sleep",), ()) for pair in zip(either_case("interval", end, "physicalTime"), either_case("interval", end)) for p in ((*root, *pair[0]), (*root, *pair[1]))])
    offset = lambda end: first_of("payload", [p for root in (("sleep",), ()) for a, b in zip(either_case("interval", f"{end}Time", "utcOffset"), either_case("interval", f"{end}UtcOffset")) for p in ((*root, *a), (*root, *b))])
    civil = lambda end: civil_date(first_of("payload", _under("interval", end, "civilTime", "date")))
    # a time that is an object is not a time: its physicalTime comes first
    start, end = time("startTime"), time("endTime")
    stages = F.coalesce(F.json_array_length(at("payload", "sleep.stages")), F.lit(0))
    source, log_id = first_of("payload", ["dataSource.name", "data_source.name", "source.name"]), at("payload", "name")
    flag = lambda *names: boolean_word(first_of("payload", [("sleep", "metadata", n) for n in names]))
    return points.select(
        keys.sleep_log_key(log_id, start, end, source, F.col("payload")).alias("sleep_log_key"),
        log_id.alias("source_log_id"),
        *(c for c in ("google_user_id", *LINEAGE) if c in points.columns),
        source.alias("source_name"),
        instant(start).alias("start_physical_time"),
        instant(end).alias("end_physical_time"),
        offset("start").alias("start_utc_offset"),
        offset("end").alias("end_utc_offset"),
        civil("startTime").alias("start_civil_date"),
        civil("endTime").alias("end_civil_date"),
        at("payload", "sleep.type").alias("sleep_type"),
        first_of("payload", ["sleep.metadata.stagesStatus", "sleep.metadata.stages_status"]).alias("stages_status"),
        flag("processed").alias("is_processed"),
        flag("nap").alias("is_nap"),
        flag("manuallyEdited", "manually_edited").alias("is_manually_edited"),
        (stages > 0).alias("has_sleep_stages"),
        stages.alias("sleep_stage_count"),
        at("payload", "sleep.summary").isNotNull().alias("has_sleep_summary"),
        F.col("payload").alias("sleep_log_payload"),
    )


# Object of a daily point, and (column, field, type) of its measures.
DAILY = {
    "daily_resting_heart_rate": ("dailyRestingHeartRate", (("resting_heart_rate_bpm", "beatsPerMinute", "decimal(6,2)"), ("calculation_method", "calculationMethod", "string"))),
    "daily_heart_rate_variability": (
        "dailyHeartRateVariability",
        (
            ("average_hrv_milliseconds", "averageHeartRateVariabilityMilliseconds", "decimal(10,3)"),
            ("deep_sleep_rmssd_milliseconds", "deepSleepRootMeanSquareOfSuccessiveDifferencesMilliseconds", "decimal(10,3)"),
            ("non_rem_heart_rate_bpm", "nonRemHeartRateBeatsPerMinute", "decimal(6,2)"),
            ("entropy", "entropy", "decimal(10,3)"),
        ),
    ),
    "daily_respiratory_rate": ("dailyRespiratoryRate", (("respiratory_rate_brpm", "breathsPerMinute", "decimal(6,2)"),)),
}


def daily(points: DataFrame, entity: str) -> DataFrame:
    """A row for each daily point of ``entity`` (a key of DAILY)."""
    root, measures = DAILY[entity]
    roots = tuple(either_case(root))
    day = civil_date(first_of("payload", _under("date", roots=roots)))
    point, source = at("payload", "name"), first_of("payload", ["dataSource.name", "data_source.name", "source.name"])
    user = F.col("google_health_user_id") if "google_health_user_id" in points.columns else F.lit(None).cast("string")
    value = lambda f, t: first_of("payload", _under(f, roots=roots) + _under("dailyRestingHeartRateMetadata", f, roots=roots)) if t == "string" else first_of("payload", _under(f, roots=roots)).try_cast(t)
    return points.select(
        keys.daily_key(entity, point, user, day, source, F.col("payload")).alias(f"{entity}_key"),
        *(c for c in LINEAGE if c in points.columns),
        user.alias("google_health_user_id"),
        point.alias("source_data_point_id"),
        day.alias("activity_date"),
        *(value(f, t).alias(c) for c, f, t in measures),
        source.alias("source_name"),
        *(v.alias(c) for c, v in provenance().items()),
        F.col("payload").alias(f"{entity}_payload"),
    )


def exercise(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row for each exercise observation; the exercise object and the point's id are required."""
    part = lambda *f: first_of("payload", [("exercise", *p) for p in either_case(*f)])
    point = first_of("payload", ["name", "dataPointName", "data_point_name"])
    user = F.col("google_health_user_id") if "google_health_user_id" in points.columns else F.lit(None).cast("string")
    out = points.select(
        keys.exercise_key(user, point, F.col("payload")).alias("exercise_observation_key"),
        *(c for c in LINEAGE if c in points.columns),
        user.alias("google_health_user_id"),
        point.alias("source_data_point_id"),
        part("exerciseType").alias("exercise_type"),
        part("displayName").alias("display_name"),
        instant(part("interval", "startTime")).alias("interval_start_time"),
        instant(part("interval", "endTime")).alias("interval_end_time"),
        part("interval", "startUtcOffset").alias("start_utc_offset"),
        part("interval", "endUtcOffset").alias("end_utc_offset"),
        instant(part("updateTime")).alias("source_update_time"),
        *(v.alias(c) for c, v in provenance().items()),
        F.col("payload").alias("exercise_payload"),
        at("payload", "exercise").alias("_exercise"),
    )
    rows, rejects = _split(out, F.col("_exercise").isNotNull() & (F.length("source_data_point_id") > 0), "missing exercise or id")
    return rows.drop("_exercise"), rejects.drop("_exercise")
