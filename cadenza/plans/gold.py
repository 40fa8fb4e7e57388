"""Gold tables: best efforts with eligibility, and achievements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import keys, text
from ..operators.chunks import asof_join
from ..operators.joins import unpivot
from ..operators.records import year_records
from ..operators.windows import best_efforts, normalised_power, running_records

# Fixed values.
METRICS = {"watts": "watts", "cadence_rpm": "cadence_rpm", "heartrate_bpm": "heartrate_bpm"}
DURATIONS = (5, 10, 20, 60, 120, 300, 600, 1200, 1800, 3600)
PROVENANCE = ("sample_index", "time_seconds", "distance_metres", "latitude", "longitude")
ALL_TIME = ("1000-01-01", "9999-12-31")
EFFORTS_VERSION = "activity_best_efforts_v1"
ACHIEVEMENTS_VERSION = "activity_achievements_v1"
POWER_METRICS_VERSION = "activity_power_metrics_v1"
TRAINING_LOAD_VERSION = "activity_training_load_v1"
RIDE_METRICS = {"distance_metres": "longest_distance", "moving_time_seconds": "longest_moving_duration", "elevation_gain_metres": "highest_elevation_gain"}

RECORD_KEY, RECORD_ORDER = ["achievement_type", "metric_name", "duration_seconds"], ["activity_date", "activity_id"]


def with_eligibility(efforts: DataFrame, activities: DataFrame) -> DataFrame:
    """Power efforts take eligibility and provenance from their activity, none meaning ineligible; others are always eligible."""
    parent = activities.select("activity_id", F.col("is_power_record_eligible").alias("_ok"), F.col("power_record_exclusion_reason").alias("_why"), F.col("power_source_type").alias("_type"), F.col("power_classification_version").alias("_version"))
    power = F.col("metric_name") == "watts"
    return efforts.join(parent, "activity_id", "left").select(
        *efforts.columns,
        F.when(power, F.coalesce("_ok", F.lit(False))).otherwise(True).alias("is_record_eligible"),
        F.when(power & ~F.coalesce("_ok", F.lit(False)), F.col("_why")).alias("record_exclusion_reason"),
        F.when(power, F.col("_type")).alias("source_classification"),
        F.when(power, F.col("_version")).alias("power_classification_version"),
    )


def activity_best_efforts(streams: DataFrame, activities: DataFrame, durations=DURATIONS) -> DataFrame:
    found = best_efforts(streams, "activity_id", ["sample_index"], METRICS, list(durations), list(PROVENANCE))
    return with_eligibility(found, activities).withColumn("calculation_version", F.lit(EFFORTS_VERSION))


def achievement_sources(efforts: DataFrame, activities: DataFrame, durations=DURATIONS) -> DataFrame:
    """activity_id, activity_date, achievement_type, metric_name, duration_seconds, value of everything that can be a record."""
    dated = activities.select("activity_id", F.col("start_date_local").alias("activity_date"), *RIDE_METRICS)
    power = efforts.where((F.col("metric_name") == "watts") & F.col("is_record_eligible") & (F.col("peak_value") > 0) & F.col("duration_seconds").isin(*durations))
    power = power.join(dated.select("activity_id", "activity_date"), "activity_id").select("activity_id", "activity_date", F.lit("power_best_effort").alias("achievement_type"), F.lit("power_watts").alias("metric_name"), F.col("duration_seconds").cast("int"), F.col("peak_value").alias("value"))
    rides = unpivot(dated, ["activity_id", "activity_date"], {m: F.col(m) for m in RIDE_METRICS}, "metric_name").where("value > 0")
    kind = F.create_map(*(F.lit(x) for pair in RIDE_METRICS.items() for x in pair))[F.col("metric_name")]
    rides = rides.select("activity_id", "activity_date", kind.alias("achievement_type"), "metric_name", F.lit(0).alias("duration_seconds"), "value")
    return power.unionByName(rides).where("activity_date is not null and value is not null")


def achievements(sources: DataFrame, candidates: DataFrame | None = None) -> DataFrame:
    """All-time and calendar-year records, with what they beat (all time) or equalled last (year)."""
    key, order = RECORD_KEY, RECORD_ORDER
    all_time = running_records(sources, key, order, "value", "activity_date")
    all_time = all_time.select(*sources.columns, F.lit("all_time").alias("comparison_scope"), F.lit(ALL_TIME[0]).cast("date").alias("comparison_period_start"), F.lit(ALL_TIME[1]).cast("date").alias("comparison_period_end"), "previous", F.lit(None).cast("int").alias("days_since_previous_best"))
    year = year_records(sources, key, order, "value", "activity_date")
    y = F.year("activity_date")
    year = year.select(*sources.columns, F.lit("calendar_year").alias("comparison_scope"), F.make_date(y, F.lit(1), F.lit(1)).alias("comparison_period_start"), F.make_date(y, F.lit(12), F.lit(31)).alias("comparison_period_end"), F.col("prior").alias("previous"), F.datediff("activity_date", "prior.activity_date").alias("days_since_previous_best"))
    out = all_time.unionByName(year)
    if candidates is not None:
        out = out.join(candidates.select("activity_id").distinct(), "activity_id", "left_semi")
    c = {n: F.col(n) for n in out.columns}
    return out.select(
        keys.achievement_key(*(c[n] for n in ("activity_id", *key, "comparison_scope", "comparison_period_start", "comparison_period_end"))).alias("activity_achievement_key"),
        "activity_id",
        "activity_date",
        *key,
        "comparison_scope",
        "comparison_period_start",
        "comparison_period_end",
        F.lit(1).alias("achievement_rank"),
        F.col("value").alias("metric_value"),
        F.col("previous.value").alias("previous_best_value"),
        F.col("previous.activity_id").alias("previous_best_activity_id"),
        F.col("previous.activity_date").alias("previous_best_date"),
        "days_since_previous_best",
        text.achievement_title(c["achievement_type"], c["duration_seconds"], c["comparison_scope"]).alias("achievement_title"),
        text.achievement_detail(c["achievement_type"], c["metric_name"], c["duration_seconds"], c["comparison_scope"], c["value"], c["days_since_previous_best"]).alias("achievement_detail"),
        F.lit(ACHIEVEMENTS_VERSION).alias("calculation_version"),
    )


def activity_power_metrics(activities: DataFrame, streams: DataFrame) -> DataFrame:
    """One row per activity: what its source states, and normalised power and variability from its samples."""
    measured = normalised_power(streams, "activity_id", ["sample_index"], "watts")
    found = activities.join(measured.select("activity_id", "average", "normalised", "variability_index"), "activity_id", "left")
    average = F.coalesce("average_power_watts", "average")
    return found.select(
        "activity_id",
        F.col("start_date_local").alias("activity_date"),
        "moving_time_seconds",
        average.alias("average_power_watts"),
        "weighted_average_power_watts",
        F.col("normalised").alias("normalized_power_watts"),
        "variability_index",
        (average * F.col("moving_time_seconds") / 1000).alias("work_kilojoules"),
        F.lit(POWER_METRICS_VERSION).alias("calculation_version"),
    )


def activity_training_load(metrics: DataFrame, ftp_history: DataFrame, athlete: list[str] = ()) -> DataFrame:
    """Intensity and stress of each activity by the FTP (valid_from, ftp_watts) in force on its day; nulls before the first entry."""
    known = asof_join(metrics, ftp_history, list(athlete), "activity_date", "valid_from", ["valid_from", "ftp_watts"])
    ftp = F.when(F.col("ftp_watts") > 0, F.col("ftp_watts"))
    intensity = F.col("normalized_power_watts") / ftp
    stress = F.col("moving_time_seconds") * F.col("normalized_power_watts") * intensity / (ftp * 3600) * 100
    return known.select(*athlete, "activity_id", ftp.alias("ftp_watts_used"), intensity.alias("intensity_factor"), stress.alias("training_stress_score"), F.lit(TRAINING_LOAD_VERSION).alias("calculation_version"))


def notification_eligible(facts: DataFrame, recent: DataFrame, daily: bool, had_facts: bool) -> DataFrame:
    """Only a daily run's recent activities, and not on the first run."""
    hit = recent.select("activity_id").distinct().withColumn("_recent", F.lit(True))
    return facts.join(hit, "activity_id", "left").withColumn("notification_eligible", F.coalesce("_recent", F.lit(False)) & F.lit(daily and had_facts)).drop("_recent")


def input_signatures(activities: DataFrame, sources: DataFrame) -> DataFrame:
    """(activity_id, sig): a signature of what an activity puts into the evaluation; of nothing too."""
    row = F.to_json(F.struct("activity_date", "achievement_type", "metric_name", "duration_seconds", "value"))
    put = sources.groupBy("activity_id").agg(F.array_join(F.array_sort(F.collect_list(row)), ",").alias("_in"))
    return activities.select("activity_id").join(put, "activity_id", "left").select("activity_id", F.sha2(F.coalesce("_in", F.lit("")), 256).alias("sig"))
