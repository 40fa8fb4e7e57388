"""Profiles, densified days, coverage and log statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .medians import LONGEST, running_median


def greatest_or_null(*columns: Column) -> Column:
    """The greatest; null if any is null."""
    whole = columns[0].isNotNull()
    for c in columns[1:]:
        whole = whole & c.isNotNull()
    return F.when(whole, F.greatest(*columns))


def population_profile(df: DataFrame, columns: list[str] | None = None, counterpart: dict[str, Column] | None = None, values: int = 0) -> DataFrame:
    """column_name, rows, non_null, distinct_values, source_non_null and anomaly of each column, in one pass.

    ``counterpart``: expressions over the same rows that a column is filled from. ``values``: list a column's
    values (as text, sorted, comma-joined) if there are no more than so many.
    """
    columns, counterpart = columns or df.columns, counterpart or {}
    measured = []
    for i, c in enumerate(columns):
        measured += [F.count(F.col(c)).alias(f"n{i}"), F.count_distinct(F.col(c)).alias(f"d{i}"), F.count(counterpart[c] if c in counterpart else F.lit(None)).alias(f"s{i}")]
    one = df.agg(F.count("*").alias("rows"), *measured)
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.col("rows").alias("rows"), F.col(f"n{i}").alias("non_null"), F.col(f"d{i}").alias("distinct_values"), (F.col(f"s{i}") if c in counterpart else F.lit(None).cast("long")).alias("source_non_null"))
        for i, c in enumerate(columns)
    ]
    out = one.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    anomaly = (
        F.when((F.col("non_null") == 0) & (F.coalesce("source_non_null", F.lit(0)) > 0), "source_populated_but_empty")
        .when(F.col("non_null") == 0, "all_null")
        .when(F.col("non_null") < F.coalesce("source_non_null", F.lit(0)), "fewer_than_source")
        .when((F.col("distinct_values") == 1) & (F.col("rows") > 1), "constant")
        .otherwise("none")
    )
    out = out.withColumn("anomaly", anomaly)
    if not values:
        return out
    listed = [F.when(F.count_distinct(F.col(c)) <= values, F.array_join(F.array_sort(F.collect_set(F.col(c).cast("string"))), ",")).alias(f"v{i}") for i, c in enumerate(columns)]
    texts = df.agg(*listed).select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias("value_list")) for i, c in enumerate(columns)))).alias("e")).select("e.*")
    return out.join(texts, "column_name")


def date_windows(spark, start: str, end: str) -> DataFrame:
    """The days from start to end, each as (date, start_ts, end_ts), the end exclusive."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date"))
    return days.select("date", F.col("date").cast("timestamp_ntz").alias("start_ts"), F.date_add("date", 1).cast("timestamp_ntz").alias("end_ts"))


def densify_daily(df: DataFrame, day: str, value: str, fill: float = 0) -> DataFrame:
    """(day, value): the sum of each day from the first to the last; ``fill`` for days without rows."""
    sums = df.groupBy(F.col(day).alias("day")).agg(F.sum(value).alias("value")).where("day is not null")
    spine = sums.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias("day"))
    return spine.join(sums, "day", "left").select("day", F.coalesce("value", F.lit(fill)).alias("value"))


def coverage(df: DataFrame, by: list[str], day: str) -> DataFrame:
    """First and last day, observations and distinct days of each group."""
    return df.groupBy(*by).agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"), F.count("*").alias("observations"), F.count_distinct(day).alias("days"))


def histogram_of_counts(df: DataFrame, key: list[str]) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(*key).agg(F.count("*").alias("rows_per_key")).groupBy("rows_per_key").agg(F.count("*").alias("keys"))


def zero_filled(counts: DataFrame, keys: DataFrame, on: list[str], count: str) -> DataFrame:
    return keys.join(counts, on, "left").withColumn(count, F.coalesce(count, F.lit(0)))


def multiple_values_per_key(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """Keys with more than one value, and the values in order."""
    grouped = df.where(F.col(value).isNotNull()).groupBy(*key).agg(F.count_distinct(value).alias("n_values"), F.array_join(F.array_sort(F.collect_set(value)), ",").alias("value_list"))
    return grouped.where("n_values > 1")


def slow_batches(log: DataFrame, run: str, order: str, seconds: str, floor_s: float = 60, factor: float = 3, min_prior: int = 5, longest: int = LONGEST) -> DataFrame:
    """The log with ``is_slow``: longer than the floor and, once the run has ``min_prior`` earlier batches, than the factor times their median.

    The medians are exact (``medians.running_median``). Null durations don't count and aren't slow; NaN counts as infinite.
    """
    out = running_median(log, [run], [order], seconds, longest)
    limit = F.when(F.col("prior") >= min_prior, F.greatest(F.lit(float(floor_s)), factor * F.col("prior_median"))).otherwise(F.lit(float(floor_s)))
    return out.withColumn("is_slow", F.coalesce(F.col(seconds) > limit, F.lit(False)))


def throughput_trend(log: DataFrame, run: str, order: str, rows: str, seconds: str, window: int = 10, tolerance: float = 0.1) -> DataFrame:
    """stable, improving or degrading for each run: rows a second in the later against the earlier half of its last batches (the later
    has the odd one). calculating: fewer than four batches, a null among them, no time spent in a half, or no rows in the earlier."""
    recent = log.withColumn("_r", F.row_number().over(Window.partitionBy(run).orderBy(F.col(order).desc()))).where(F.col("_r") <= window)
    recent = recent.withColumn("_n", F.count("*").over(Window.partitionBy(run)))
    late = F.col("_r") <= F.ceil(F.col("_n") / 2)
    rate = lambda c: F.try_divide(F.sum(F.when(c, F.col(rows))), F.sum(F.when(c, F.col(seconds))))
    whole = (F.count(rows) == F.count("*")) & (F.count(seconds) == F.count("*")) & (F.count("*") >= 4)
    out = recent.groupBy(run).agg(F.when(whole, rate(~late)).alias("earlier"), F.when(whole, rate(late)).alias("later"))
    change = F.try_divide("later", "earlier") - 1
    trend = F.when(change.isNull() | F.isnan(change) | (F.col("earlier") <= 0), "calculating").when(change > tolerance, "improving").when(change < -tolerance, "degrading").otherwise("stable")
    return out.withColumn("trend", trend)


def rolling_throughput(log: DataFrame, run: str, order: str, rows: str, seconds: str, remaining: str, window: int = 10) -> DataFrame:
    """Rows a second over the last batches of the run, and the seconds that the remaining rows would take. In no time at all
    rows come at an infinite rate (the rest takes 0 seconds), and no rows at none (NaN; the rest's time is unknown: null)."""
    frame = Window.partitionBy(run).orderBy(order).rowsBetween(-(window - 1), 0)
    done, took = F.sum(rows).over(frame).cast("double"), F.sum(seconds).over(frame).cast("double")
    out = log.withColumn("rows_per_second", F.when(took == 0, done * F.lit(float("inf"))).otherwise(F.try_divide(done, took)))
    rate = F.col("rows_per_second")
    return out.withColumn("eta_seconds", F.when((rate > 0) & ~F.isnan(rate), F.col(remaining) / rate))


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def custom_order(column: Column, names: list[str]) -> Column:
    """The place of a name in a list, for sorting; names that it lacks come first (0)."""
    return F.array_position(F.array(*map(F.lit, names)), column)


def latest_of_log(log: DataFrame, order: list[str], where: Column | None = None) -> DataFrame:
    rows = log if where is None else log.where(where)
    return rows.orderBy(*(F.col(c).desc() for c in order)).limit(1)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) of each table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = one if out is None else out.unionByName(one)
    return out
