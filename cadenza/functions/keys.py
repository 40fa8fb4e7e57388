"""Deterministic keys and signatures: SHA-256 over parts in a canonical text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How a missing part shows in key material and in a signature.
MISSING_PART, MISSING_VALUE = "NA", "<NA>"


def key(*parts: Column) -> Column:
    """SHA-256 of the parts joined by ``|``; a missing part is NA."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit(MISSING_PART)) for p in parts)), 256)


def achievement_key(activity_id: Column, kind: Column, metric: Column, duration: Column, scope: Column, start: Column, end: Column) -> Column:
    return key(activity_id, kind, metric, duration, scope, start, end)


def sleep_log_key(log_id: Column, start: Column, end: Column, source: Column, payload: Column) -> Column:
    """The log's own id if it has one, else its interval, source and content."""
    return F.when(F.length(log_id) > 0, key(log_id)).otherwise(key(start, end, source, F.sha2(payload, 256)))


def daily_key(data_type: str, point_id: Column, user: Column, day: Column, source: Column, payload: Column) -> Column:
    return F.when(F.length(point_id) > 0, key(F.lit(data_type), point_id)).otherwise(key(F.lit(data_type), user, day, source, F.sha2(payload, 256)))


def source_grain_key(data_type: str, point_id: Column, user: Column, day: Column, provenance: list[Column], payload: Column) -> Column:
    return F.when(F.length(point_id) > 0, key(F.lit(data_type), point_id)).otherwise(key(F.lit(data_type), user, day, *provenance, F.sha2(payload, 256)))


def exercise_key(user: Column, point_id: Column, payload: Column) -> Column:
    """A revision of an observation has a key of its own."""
    return key(user, point_id, F.sha2(payload, 256))


def message_key(keys: Column) -> Column:
    """One key for a set of keys, whatever their order."""
    return F.sha2(F.array_join(F.array_sort(keys), "|"), 256)


def row_signature(*columns: Column) -> Column:
    """Equal for rows with equal values; nulls differ from any text."""
    return F.sha2(F.to_json(F.array(*(F.coalesce(c.cast("string"), F.lit(MISSING_VALUE)) for c in columns))), 256)


def group_signature(df: DataFrame, group: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """(group, sig): a signature of each group's rows in order, from the rows' own signatures.

    The rows' signatures of one group come together, as text of fixed length.
    """
    rows = df.select(*group, F.struct(*order, row_signature(*(F.col(c) for c in columns)).alias("_row")).alias("_r"))
    ordered = F.transform(F.array_sort(F.collect_list("_r")), lambda r: r["_row"])
    return rows.groupBy(*group).agg(F.sha2(F.array_join(ordered, ""), 256).alias("sig"))
