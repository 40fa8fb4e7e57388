"""Curated events with stages: rules on rows, then two tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Allowed states and the lengths of texts.
STATUSES = ("planned", "confirmed", "cancelled", "completed")
LENGTHS = {"event_key": 100, "event_name": 200, "location": 200, "notes": 2000}
MOST_METRES = 9_999_999_999
STAGE = "struct<stage_key:string,stage_name:string,stage_date:string,distance_metres:string,elevation_gain_metres:string,notes:string>"
EVENT = f"event_key string, event_name string, status string, start_date string, end_date string, location string, notes string, stages array<{STAGE}>"
FIELDS = ("event_key", "event_name", "status", "start_date", "end_date", "location", "notes", "stages")


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """One event a file, as text beside its parsed form, so that unknown fields can be told."""
    text = spark.read.option("wholetext", True).text(path).select(F.col("value").alias("payload"))
    return text.select("payload", F.from_json("payload", EVENT).alias("e")).select("payload", "e.*")


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", F.trim(c))


def exact_date(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), c.try_cast("date"))


def whole_metres(c: Column) -> Column:
    value = F.when(c.rlike(r"^\d{1,10}$"), c.try_cast("decimal(10,0)"))
    return F.when(value <= MOST_METRES, value)


def validated(events: DataFrame) -> DataFrame:
    """Events with trimmed texts, dates as dates, and ``errors``: what is wrong with each, empty if nothing."""
    e = events.withColumns({c: blank_to_null(F.col(c)) for c in FIELDS[:-1]})
    start, end = exact_date(F.col("start_date")), exact_date(F.col("end_date"))
    stages = F.coalesce("stages", F.array().cast(f"array<{STAGE}>"))
    extra = F.array_except(F.json_object_keys("payload"), F.array(*map(F.lit, FIELDS))) if "payload" in events.columns else F.array().cast("array<string>")
    stage_keys = F.transform(stages, lambda s: s["stage_key"])
    rules = {
        "event_key is missing": F.col("event_key").isNull(),
        "event_name is missing": F.col("event_name").isNull(),
        "status is not allowed": ~F.coalesce(F.col("status").isin(*STATUSES), F.lit(False)),
        "start_date is no exact date": start.isNull(),
        "end_date is no exact date": F.col("end_date").isNotNull() & end.isNull(),
        "end_date is before start_date": end < start,
        "a field is unknown": F.size(extra) > 0,
        "a stage key is missing or repeated": F.exists(stages, lambda s: blank_to_null(s["stage_key"]).isNull()) | (F.size(F.array_distinct(stage_keys)) < F.size(stages)),
        "a stage date is no exact date": F.exists(stages, lambda s: blank_to_null(s["stage_date"]).isNotNull() & exact_date(F.trim(s["stage_date"])).isNull()),
        "a stage distance is no whole number of metres": F.exists(stages, lambda s: (s["distance_metres"].isNotNull() & whole_metres(s["distance_metres"]).isNull()) | (s["elevation_gain_metres"].isNotNull() & whole_metres(s["elevation_gain_metres"]).isNull())),
        **{f"{c} is too long": F.char_length(F.col(c)) > n for c, n in LENGTHS.items()},
    }
    errors = F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for text, bad in rules.items())))
    return e.withColumns({"stages": stages, "errors": errors}).withColumns({"start_date": start, "end_date": end})


def event_tables(valid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, stages) of the events without errors."""
    good = valid.where(F.size("errors") == 0)
    s = good.select("event_key", F.posexplode("stages").alias("pos", "s"))
    stages = s.select(
        "event_key",
        blank_to_null(F.col("s.stage_key")).alias("stage_key"),
        (F.col("pos") + 1).alias("stage_number"),
        blank_to_null(F.col("s.stage_name")).alias("stage_name"),
        exact_date(F.trim("s.stage_date")).alias("stage_date"),
        whole_metres(F.col("s.distance_metres")).alias("distance_metres"),
        whole_metres(F.col("s.elevation_gain_metres")).alias("elevation_gain_metres"),
        blank_to_null(F.col("s.notes")).alias("notes"),
    )
    return good.select(*FIELDS[:-1]), stages


def upcoming(events: DataFrame, as_of: str) -> DataFrame:
    """Events that are not cancelled and not over."""
    return events.where((F.col("status") != "cancelled") & (F.coalesce("end_date", "start_date") >= F.lit(as_of).cast("date"))).orderBy("start_date", "event_key")


def stages_of(stages: DataFrame, event_key: str) -> DataFrame:
    return stages.where(F.col("event_key") == event_key).orderBy("stage_number")
