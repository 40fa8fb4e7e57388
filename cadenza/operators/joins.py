"""Range, interval and control-row joins, and flags for existence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exists_flag(df: DataFrame, other: DataFrame, on: list[str], name: str) -> DataFrame:
    """``df`` with a boolean: does ``other`` have a row with the same key?"""
    keys = other.select(*(F.col(c).alias(f"_e_{c}") for c in on)).distinct().withColumn("_found", F.lit(True))
    match = F.lit(True)
    for c in on:
        match = match & (F.col(c) == F.col(f"_e_{c}"))
    return df.join(keys, match, "left").withColumn(name, F.col("_found").isNotNull()).drop("_found", *(f"_e_{c}" for c in on))


def with_control_row(df: DataFrame, control: DataFrame) -> DataFrame:
    """``df`` with the columns of a control table's only row; nulls if it has none."""
    return df.join(F.broadcast(control.limit(1)), F.lit(True), "left")


def range_expand(counts: DataFrame, count: str, durations: list[int], name: str = "duration_seconds") -> DataFrame:
    """A row for each of the durations that does not exceed the row's count."""
    fitting = F.filter(F.array(*map(F.lit, sorted(durations))), lambda d: d <= F.col(count))
    return counts.withColumn(name, F.explode(fitting))


def interval_join(samples: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, width: int | None = None) -> DataFrame:
    """Samples with the intervals [start, end) of their key that hold them.

    With ``width``, both sides also meet on the number of a time bucket of that width, so a key with many
    samples and intervals is spread out. But for the key the two sides may share no column name.
    """
    if shared := (set(samples.columns) & set(intervals.columns)) - {key}:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    i = intervals.select(*(F.col(c).alias("_key") if c == key else F.col(c) for c in intervals.columns))
    inside = (samples[key] == i["_key"]) & (samples[at] >= i[start]) & (samples[at] < i[end])
    if width is None:
        return samples.join(i, inside).drop("_key")
    i = i.where(F.col(end) > F.col(start)).withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / width).cast("long"), F.floor((F.col(end) - 1) / width).cast("long"))))
    s = samples.withColumn("_a", F.floor(F.col(at) / width).cast("long"))
    inside = (s[key] == i["_key"]) & (s["_a"] == i["_b"]) & (s[at] >= i[start]) & (s[at] < i[end])
    return s.join(i, inside).drop("_key", "_a", "_b")


def unpivot(df: DataFrame, ids: list[str], measures: dict[str, Column], name: str = "metric", value: str = "value") -> DataFrame:
    """A row for each measure, in one pass over ``df``."""
    pairs = F.array(*(F.struct(F.lit(m).alias("m"), c.cast("double").alias("v")) for m, c in measures.items()))
    return df.select(*ids, F.explode(pairs).alias("_p")).select(*ids, F.col("_p.m").alias(name), F.col("_p.v").alias(value))
