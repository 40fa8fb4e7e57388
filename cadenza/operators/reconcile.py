"""Source against store: canonical JSON, NEW / CHANGED / UNCHANGED / MISSING, repair flags, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The states of a reconciled row.
STATES = ("NEW", "CHANGED", "UNCHANGED", "MISSING")


def canonical_json(payload: Column, schema: str | None = None) -> Column:
    """Text that is equal for equal JSON, whatever the order of object keys.

    With a schema, by reading and writing it again; else by a variant, which orders keys. What is no JSON stays as it is.
    """
    if schema is not None:
        return F.to_json(F.from_json(payload, schema))
    return F.coalesce(F.to_json(F.try_parse_json(payload)), payload)


def baseline(df: DataFrame, at: str, now: str, days: int) -> DataFrame:
    """Rows of the last ``days`` days before ``now``."""
    return df.where(F.col(at) >= F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))


def classify_sources(incoming: DataFrame, existing: DataFrame, key: str, payload: str, children: list[str], schema: str | None = None) -> DataFrame:
    """(key, reconciliation_status, child_status, payload_changed, repair_<child> flags).

    ``children``: status columns of ``existing``. A child that FAILED makes the row FAILED; one that is not
    SUCCESS or NOT_FOUND makes it INCOMPLETE. Changed and new rows need all children.
    """
    i = incoming.select(key, canonical_json(F.col(payload), schema).alias("_new"), F.lit(True).alias("_i"))
    e = existing.select(key, canonical_json(F.col(payload), schema).alias("_old"), F.lit(True).alias("_e"), *children)
    both = i.join(e, key, "full_outer")
    status = (
        F.when(F.col("_e").isNull(), "NEW").when(F.col("_i").isNull(), "MISSING").when(F.col("_new").eqNullSafe(F.col("_old")), "UNCHANGED").otherwise("CHANGED")
    )
    done = lambda c: F.coalesce(F.col(c).isin("SUCCESS", "NOT_FOUND"), F.lit(False))
    any_of = lambda cs: F.greatest(*cs) if len(cs) > 1 else cs[0]
    failed = any_of([F.coalesce(F.col(c) == "FAILED", F.lit(False)) for c in children])
    open_ = any_of([~done(c) for c in children])
    child = F.when(F.col("_e").isNull(), "INCOMPLETE").when(failed, "FAILED").when(open_, "INCOMPLETE").otherwise("COMPLETE")
    return both.select(
        key,
        status.alias("reconciliation_status"),
        child.alias("child_status"),
        (status == "CHANGED").alias("payload_changed"),
        *((F.col("_i").isNotNull() & ((status.isin("NEW", "CHANGED")) | ~done(c))).alias(f"repair_{c}") for c in children),
    )


def upsertable(incoming: DataFrame, reconciled: DataFrame, key: str) -> DataFrame:
    """The incoming rows that are new or changed."""
    return incoming.join(reconciled.where(F.col("reconciliation_status").isin("NEW", "CHANGED")).select(key), key, "left_semi")


def mark_children_pending(existing: DataFrame, reconciled: DataFrame, key: str, children: list[str]) -> DataFrame:
    """Children of changed rows start anew."""
    changed = reconciled.where("payload_changed").select(key, F.lit(True).alias("_c"))
    out = existing.join(changed, key, "left")
    return out.select(*(F.when(F.col("_c"), F.lit("PENDING")).otherwise(F.col(c)).alias(c) if c in children else F.col(c) for c in existing.columns))


def affected(reconciled: DataFrame, key: str) -> DataFrame:
    return reconciled.where(F.col("reconciliation_status").isin("NEW", "CHANGED") | F.col("child_status").isin("INCOMPLETE", "FAILED")).select(key).distinct()


def summary(reconciled: DataFrame) -> DataFrame:
    """A row for each of the four states: rows, and how many need a repair of each child; 0 where there are none."""
    repairs = [c for c in reconciled.columns if c.startswith("repair_")]
    counts = reconciled.groupBy("reconciliation_status").agg(F.count("*").alias("rows"), *(F.count_if(c).alias(c) for c in repairs))
    states = reconciled.sparkSession.createDataFrame([(s,) for s in STATES], "reconciliation_status string")
    return states.join(counts, "reconciliation_status", "left").fillna(0)
