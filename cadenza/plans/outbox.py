"""Achievement messages: a queue table and its state machine, as transforms from table to table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import message_key

# Fixed values.
EVENT_TYPE, SOURCE = "activity_achievement", "activity_achievements"
LONGEST_ERROR = 2000


def messages(facts: DataFrame, activities: DataFrame, channel: str, now: str, include_historical: bool = False) -> DataFrame:
    """One message for each activity with notifiable achievements; its key depends on the set of achievements only."""
    wanted = facts if include_historical else facts.where("notification_eligible")
    entry = F.struct("comparison_scope", "achievement_type", "duration_seconds", "metric_name", "metric_value", "achievement_title", "achievement_detail", "activity_achievement_key")
    grouped = wanted.groupBy("activity_id").agg(F.array_sort(F.collect_list(entry)).alias("achievements"), message_key(F.collect_set("activity_achievement_key")).alias("source_key"))
    joined = grouped.join(activities.select("activity_id", "activity_name", "start_date_local", "distance_kilometres"), "activity_id")
    lines = F.transform("achievements", lambda a: a["achievement_detail"])
    payload = F.to_json(F.struct(F.struct("activity_id", "activity_name", "start_date_local", "distance_kilometres").alias("activity"), "achievements", lines.alias("lines")))
    return joined.select(
        F.sha2(F.concat_ws("|", "source_key", F.lit(channel)), 256).alias("notification_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        F.lit(SOURCE).alias("source_object"),
        "source_key",
        "activity_id",
        F.lit(channel).alias("channel"),
        F.lit("PENDING").alias("notification_status"),
        F.lit(0).alias("attempt_count"),
        payload.alias("payload_json"),
        F.lit(now).cast("timestamp_ntz").alias("next_attempt_at"),
        F.lit(None).cast("timestamp_ntz").alias("attempted_at"),
        F.lit(None).cast("timestamp_ntz").alias("sent_at"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(now).cast("timestamp_ntz").alias("created_at"),
    )


def queue(new: DataFrame, outbox: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(outbox with the messages that it lacks, one row: queued, skipped, already_sent, already_queued)."""
    grain = ["event_type", "source_object", "source_key", "channel"]
    known = outbox.select(*grain, F.col("notification_status").alias("_have"))
    both = new.join(known, grain, "left")
    sent = F.col("_have") == "SENT"
    counts = both.agg(F.count_if(F.col("_have").isNull()).alias("queued"), F.count_if(F.col("_have").isNotNull()).alias("skipped"), F.count_if(sent).alias("already_sent"), F.count_if(F.col("_have").isNotNull() & ~sent).alias("already_queued"))
    return outbox.unionByName(both.where("_have is null").select(*outbox.columns)), counts


def due(outbox: DataFrame, now: str, max_attempts: int, limit: int) -> DataFrame:
    """The oldest messages to send now."""
    ready = F.col("notification_status").isin("PENDING", "RETRY") & (F.col("attempt_count") < max_attempts) & (F.col("next_attempt_at").isNull() | (F.col("next_attempt_at") <= F.lit(now).cast("timestamp_ntz")))
    return outbox.where(ready).orderBy("created_at", "notification_id").limit(limit)


def sending(outbox: DataFrame, ids: DataFrame, now: str) -> DataFrame:
    hit = ids.select("notification_id").distinct().withColumn("_hit", F.lit(True))
    o, is_hit = outbox.join(hit, "notification_id", "left"), F.col("_hit").isNotNull()
    out = {
        "notification_status": F.when(is_hit, "SENDING").otherwise(F.col("notification_status")),
        "attempt_count": F.col("attempt_count") + is_hit.cast("int"),
        "attempted_at": F.when(is_hit, F.lit(now).cast("timestamp_ntz")).otherwise(F.col("attempted_at")),
        "error_message": F.when(~is_hit, F.col("error_message")),
    }
    return o.withColumns(out).select(*outbox.columns)


def apply_outcomes(outbox: DataFrame, outcomes: DataFrame, max_attempts: int, delay_minutes: int, now: str) -> DataFrame:
    """``outcomes``: notification_id, delivered, error. SENT, or RETRY after a delay, or FAILED after the last attempt."""
    o = outbox.join(outcomes.select("notification_id", "delivered", "error"), "notification_id", "left")
    hit, ok, last = F.col("delivered").isNotNull(), F.col("delivered"), F.col("attempt_count") >= max_attempts
    moment = F.lit(now).cast("timestamp_ntz")
    status = F.when(ok, "SENT").when(last, "FAILED").otherwise("RETRY")
    again = F.when(ok, F.col("next_attempt_at")).when(~last, moment + F.make_dt_interval(mins=F.lit(delay_minutes)))
    out = {
        "notification_status": F.when(hit, status).otherwise(F.col("notification_status")),
        "sent_at": F.when(hit & ok, moment).otherwise(F.col("sent_at")),
        "next_attempt_at": F.when(hit, again).otherwise(F.col("next_attempt_at")),
        "error_message": F.when(hit & ok, F.lit(None)).when(hit, F.substring("error", 1, LONGEST_ERROR)).otherwise(F.col("error_message")),
    }
    return o.withColumns(out).select(*outbox.columns)
