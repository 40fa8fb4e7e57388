"""Text for people: durations, metric values, achievement titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What each type of achievement is called.
TYPE_LABELS = {
    "power_best_effort": "power best",
    "longest_distance": "longest ride",
    "longest_moving_duration": "longest moving duration",
    "highest_elevation_gain": "highest elevation gain",
}


def _plain(number: Column) -> Column:
    """A number without a trailing .0"""
    return F.regexp_replace(number.cast("string"), r"\.0+$", "")


def duration(seconds: Column) -> Column:
    """45s, 3m 5s, 1h 2m 3s; unknown for null."""
    s = F.bround(seconds.cast("double")).cast("long")
    h, m, rest = F.floor(s / 3600), F.floor(F.pmod(s, F.lit(3600)) / 60), F.pmod(s, F.lit(60))
    return (
        F.when(s.isNull(), "unknown")
        .when(s < 60, F.format_string("%ds", s))
        .when(s < 3600, F.format_string("%dm %ds", m, rest))
        .otherwise(F.format_string("%dh %dm %ds", h, m, rest))
    )


def duration_label(seconds: Column) -> Column:
    """5-second, 20-minute, 1-hour; empty for none."""
    s = seconds.cast("long")
    return (
        F.when(F.coalesce(s, F.lit(0)) <= 0, "")
        .when(F.pmod(s, F.lit(3600)) == 0, F.format_string("%d-hour", F.floor(s / 3600)))
        .when((s >= 60) & (F.pmod(s, F.lit(60)) == 0), F.format_string("%d-minute", F.floor(s / 60)))
        .otherwise(F.format_string("%d-second", s))
    )


def metric_value(metric: Column, value: Column) -> Column:
    return (
        F.when(value.isNull(), "unknown")
        .when(metric == "distance_metres", F.concat(_plain(F.bround(value / 1000, 1)), F.lit(" km")))
        .when(metric == "moving_time_seconds", duration(value))
        .when(metric == "power_watts", F.concat(_plain(F.bround(value)), F.lit(" W")))
        .when(metric == "elevation_gain_metres", F.concat(_plain(F.bround(value)), F.lit(" m")))
        .otherwise(_plain(F.bround(value, 1)))
    )


def achievement_title(kind: Column, seconds: Column, scope: Column) -> Column:
    label = F.create_map(*(F.lit(x) for pair in TYPE_LABELS.items() for x in pair))[kind]
    when = F.when(scope == "all_time", "all-time").otherwise("this year")
    length = F.when(kind == "power_best_effort", F.concat(duration_label(seconds), F.lit(" "))).otherwise("")
    return F.concat(F.lit("New "), when, F.lit(" "), length, label)


def achievement_detail(kind: Column, metric: Column, seconds: Column, scope: Column, value: Column, days: Column) -> Column:
    """The title and value; for a year's record also for how many days it is the best, if any."""
    since = F.when((scope != "all_time") & (days > 0), F.concat(F.lit(" -- best for "), days.cast("string"), F.lit(" days"))).otherwise("")
    return F.concat(achievement_title(kind, seconds, scope), F.lit(": "), metric_value(metric, value), since)


def gear_name(gear_id: Column, name: Column) -> Column:
    return F.when(gear_id.isNull(), "Not recorded").when(name.isNotNull(), name).otherwise(F.concat(F.lit("Unknown gear ("), gear_id, F.lit(")")))
