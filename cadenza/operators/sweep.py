"""Interval joins whose cost follows what they return, however unlike the intervals' lengths are."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import LONGEST, ranked, running_count
from .stored import stored

#: Samples meet intervals in pieces of so many neighbouring samples.
PIECE = 64
#: Intervals of a piece beyond this number go to further tasks, each with a copy of the piece's samples.
CROWD = 1_000_000


def sweep_join(samples: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, piece: int = PIECE, longest: int = LONGEST, crowd: int = CROWD) -> DataFrame:
    """Samples with the intervals [start, end) of their key that hold them; the rows of ``interval_join`` without a width to choose.

    Samples and the intervals' ends are put into one order by key and time, and a count of samples is carried along it. An
    interval then holds the samples from one count to another, whatever time that takes: it meets only the pieces of samples
    between the two, of which all but the first and last lie in it as a whole. So at most 2 * ``piece`` pairs an interval are
    compared in vain, and a long interval is repeated once for each ``piece`` rows that it returns.

    Null keys and times find nothing, nor do intervals that don't end after their start. Repeated rows of either side each
    count. But for the key the two sides may share no column name.
    """
    if shared := (set(samples.columns) & set(intervals.columns)) - {key}:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    held = stored(intervals.where(F.col(key).isNotNull() & (F.col(end) > F.col(start))).withColumn("_i", F.monotonically_increasing_id()), "intervals")
    row = F.struct(*samples.columns)
    no_row = F.lit(None).cast(samples.select(row.alias("r")).schema["r"].dataType)
    points = samples.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_side"), row.alias("_row"), F.lit(None).cast("long").alias("_i"))
    ends = held.select(F.col(key).alias("_key"), F.explode(F.array(start, end)).alias("_at"), F.lit(0).alias("_side"), no_row.alias("_row"), "_i")
    order = [F.col("_key"), F.col("_at"), F.col("_side"), F.xxhash64("_row", "_i")]  # ends come before the samples of their moment
    counted = stored(running_count(ranked(points.unionByName(ends), order), F.col("_side") == 1, "_n", longest).drop("_rank"), "counted")

    bounds = counted.where("_side = 0").groupBy("_i").agg(F.min("_n").alias("_from"), F.max("_n").alias("_to")).where("_to > _from")
    pieces = stored(bounds.withColumn("_piece", F.explode(F.sequence(F.floor(F.col("_from") / piece), F.floor((F.col("_to") - 1) / piece)))), "pieces")
    crowded = pieces.groupBy("_piece").agg(F.count("*").alias("_m")).where(F.col("_m") > crowd)  # at most one for each so many rows
    parts = crowded.select("_piece", F.ceil(F.col("_m") / crowd).alias("_parts"))
    split = lambda df: df.join(F.broadcast(parts), "_piece", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("long")))
    there = split(counted.where("_side = 1").select("_row", (F.col("_n") - 1).alias("_place"), F.floor((F.col("_n") - 1) / piece).alias("_piece")))
    there = there.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))).drop("_parts")
    asked = split(pieces.join(held.drop(key), "_i")).withColumn("_part", F.pmod(F.xxhash64("_i"), F.col("_parts"))).drop("_parts")
    met = there.hint("merge").join(asked, ["_piece", "_part"]).where("_place >= _from and _place < _to")
    return met.select("_row.*", *(c for c in intervals.columns if c != key))
