"""Landed files to a keyed table, file by file as they come; late data are a matter of dates, not of watermarks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.incremental import signature_diff
from ..operators.tables import BUCKET_BYTES, KeyedTable, Snapshot


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: str,
    shape: Callable[[DataFrame], DataFrame],
    root: str,
    keys: list[str],
    checkpoint: str,
    on_change: Callable[[DataFrame, DataFrame, DataFrame, int], None] | None = None,
    bucket_bytes: int = BUCKET_BYTES,
) -> None:
    """Upsert all JSON files that have landed since the last call into the table at ``root``, and stop.

    A micro-batch reads and rewrites the buckets that its keys fall into; buckets split as they grow (``KeyedTable``), and other writers of the
    table lose nothing. A batch without rows publishes nothing, and one that is run again after a failure gives the same table.
    ``on_change`` gets the ids whose rows changed, the table before and after, and the batch's number: the start of
    what depends on it.
    """
    table = KeyedTable(spark, root, keys, bucket_bytes)

    def batch(df: DataFrame, number: int) -> None:
        rows = shape(df)
        change = table.upsert(rows)
        if change and on_change:
            empty = Snapshot(buckets={}, schema=change.after.schema)
            before = change.before if change.before.buckets else empty
            now = table.read(change.after, change.written)
            changed = signature_diff(table.read(before, change.read), now, keys[0], [c for c in now.columns if c not in keys])
            on_change(changed, table.read(before), table.read(change.after), number)

    stream = spark.readStream.schema(schema).json(landing)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
