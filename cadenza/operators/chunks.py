"""Ordered work on histories that are too long for one task: ranks over all rows, chunks with a halo, values carried over chunks.

Rows are sorted by range and keep their rank in the whole order, so chunks have equal numbers of rows whatever the keys' sizes: a key's history
goes through many tasks, and small keys share one. What crosses a chunk's border comes as a halo of copied rows, or
as one carried row a chunk.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .stored import stored

#: Keys with more rows than this go through chunks of so many rows.
LONGEST = 1_000_000
_PARTITION = 33  # monotonically_increasing_id holds the partition above these bits


def ranked(df: DataFrame, order: list[Column], name: str = "_rank") -> DataFrame:
    """``df`` with the 0-based place of each row in ``order``, which should end in a unique column."""
    held = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_id", _PARTITION)
    sizes = sorted((r["p"], r["n"]) for r in held.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())  # a row a partition
    starts = accumulate((n for _, n in sizes), initial=0)
    first = df.sparkSession.createDataFrame([(p, s) for (p, _), s in zip(sizes, starts)], "_p long, _start long")
    out = held.withColumn("_p", part).join(F.broadcast(first), "_p")
    return out.withColumn(name, F.col("_start") + F.col("_id") - F.shiftleft("_p", _PARTITION)).drop("_p", "_id", "_start")


def running_count(rows: DataFrame, counted: Column, name: str, longest: int = LONGEST) -> DataFrame:
    """Ranked rows with the number of rows up to each, itself included, for which ``counted`` holds."""
    chunk = F.floor(F.col("_rank") / longest)
    marked = rows.withColumn("_chunk", chunk).withColumn(name, F.when(counted, 1).otherwise(0).cast("long"))
    sizes = sorted((r["c"], r["n"]) for r in marked.groupBy(F.col("_chunk").alias("c")).agg(F.sum(name).alias("n")).collect())  # a row a chunk
    starts = accumulate((n for _, n in sizes), initial=0)
    before = rows.sparkSession.createDataFrame([(c, s) for (c, _), s in zip(sizes, starts)], "_chunk long, _before long")
    within = F.sum(name).over(Window.partitionBy("_chunk").orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0))
    return marked.withColumn(name, within).join(F.broadcast(before), "_chunk").withColumn(name, F.col(name) + F.col("_before")).drop("_chunk", "_before")


def with_halo(rows: DataFrame, size: int, halo: int) -> DataFrame:
    """Ranked rows in chunks of ``size``: ``_chunk``, and ``_own``, false for copies of the ``halo`` rows before a chunk."""
    if halo >= size:
        raise ValueError(f"chunks of {size} rows are too small for {halo} rows of the one before")
    chunk = F.floor(F.col("_rank") / size)
    near = F.col("_rank") % size >= size - halo
    copies = F.when(near, F.array(chunk, chunk + 1)).otherwise(F.array(chunk))
    return rows.withColumn("_chunk", F.explode(copies)).withColumn("_own", F.col("_chunk") == chunk)


def long_keys(df: DataFrame, key: list[str], longest: int) -> DataFrame | None:
    """Keys with more than ``longest`` rows, at most one for each so many rows; None if there are none."""
    hot = stored(df.groupBy(*key).agg(F.count("*").alias("_n")).where(F.col("_n") > longest).drop("_n"), "long_keys")
    return None if hot.isEmpty() else hot


def apart(df: DataFrame, hot: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of the keys in ``hot``, other rows); null keys count as a key."""
    marks = hot.select(*(F.col(k).alias(f"_h{i}") for i, k in enumerate(key)), F.lit(True).alias("_hot"))
    same = F.lit(True)
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_h{i}"))
    marked = df.join(marks, same, "left").drop(*(f"_h{i}" for i in range(len(key))))
    return marked.where("_hot").drop("_hot"), marked.where("_hot is null").drop("_hot")


def running_last(df: DataFrame, key: list[str], order: list[Column], value: Column, name: str, longest: int = LONGEST) -> DataFrame:
    """``df`` with the latest non-null ``value`` of the key's rows up to each row, in ``order``."""
    df = df.withColumn(name, value)
    hot = long_keys(df, key, longest)
    plain = lambda rows: rows.withColumn(name, F.last(name, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    if hot is None:
        return plain(df)
    some, rest = apart(df, hot, key)
    rows = ranked(some, [*(F.col(k) for k in key), *order]).withColumn("_chunk", F.floor(F.col("_rank") / longest))
    within = F.last(name, ignorenulls=True).over(Window.partitionBy("_chunk", *key).orderBy("_rank").rowsBetween(Window.unboundedPreceding, 0))
    # the last value of each key and chunk, carried to the key's later chunks: a row or two a chunk
    ends = rows.groupBy("_chunk", *key).agg(F.max_by(name, F.when(F.col(name).isNotNull(), F.col("_rank"))).alias("_tail"))
    before = F.last("_tail", ignorenulls=True).over(Window.partitionBy(*key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1))
    carried = ends.withColumn("_before", before).where("_before is not null").select(F.col("_chunk").alias("_c"), *(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), "_before")
    same = F.col("_chunk") == F.col("_c")
    for i, k in enumerate(key):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    out = rows.withColumn(name, within).join(F.broadcast(carried), same, "left").withColumn(name, F.coalesce(name, "_before"))
    return out.select(*df.columns).unionByName(plain(rest))


def asof_join(left: DataFrame, right: DataFrame, key: list[str], left_at: str, right_at: str, columns: list[str], longest: int = LONGEST) -> DataFrame:
    """``left`` with ``columns`` of the key's latest right row at or before ``left_at``; nulls if there is none.

    Both sides are merged in one order and the last right row is carried along, so nothing is compared by inequality. Of right rows
    of one moment the greatest counts, by ``columns`` in turn; right rows without a time are left out, left rows without one find nothing.
    """
    row = F.struct(*left.columns)
    held = F.struct(*(F.col(c).alias(c) for c in columns))
    key_of = [F.col(k).alias(f"_a{i}") for i, k in enumerate(key)] or [F.lit(0).alias("_a0")]
    none_left = F.lit(None).cast(left.select(row.alias("r")).schema["r"].dataType)
    none_right = F.lit(None).cast(right.select(held.alias("r")).schema["r"].dataType)
    kind = dict(left.dtypes)[left_at]
    sides = left.select(*key_of, F.col(left_at).alias("_at"), F.lit(1).alias("_side"), row.alias("_row"), none_right.alias("_held"))
    others = right.where(F.col(right_at).isNotNull()).select(*key_of, F.col(right_at).cast(kind).alias("_at"), F.lit(0).alias("_side"), none_left.alias("_row"), held.alias("_held"))
    names = [f"_a{i}" for i in range(len(key_of))]
    found = running_last(sides.unionByName(others), names, [F.col("_at").asc_nulls_first(), F.col("_side"), F.col("_held"), F.xxhash64("_row")], F.col("_held"), "_latest", longest)
    return found.where("_side = 1").select("_row.*", *(F.col(f"_latest.{c}").alias(c) for c in columns))
