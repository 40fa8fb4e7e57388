"""Run, batch and request logs: rows are only appended; the latest row of an id is its state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import latest_per_key

RUN = "run_id long, entity string, status string, started_at timestamp_ntz, ended_at timestamp_ntz, rows_read long, rows_written long, duration_seconds double, error_message string"
BATCH = "run_id long, entity string, batch_number int, status string, started_at timestamp_ntz, ended_at timestamp_ntz, rows_written long, duration_seconds double, error_message string"


def append(spark: SparkSession, rows: list[dict], schema: str, path: str) -> None:
    """Append state rows: RUNNING at the start, SUCCESS or FAILED with counts at the end."""
    names = [c.split()[0] for c in schema.split(", ")]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)
    both = F.col("started_at").isNotNull() & F.col("ended_at").isNotNull()
    seconds = F.when(both, F.timestamp_diff("SECOND", "started_at", "ended_at").cast("double"))
    df.withColumn("duration_seconds", F.coalesce("duration_seconds", seconds)).write.mode("append").parquet(path)


def states(log: DataFrame, keys: list[str]) -> DataFrame:
    """The latest row of each id: an ended one before a running one."""
    return latest_per_key(log.withColumn("_ended", F.col("ended_at").isNotNull()), keys, ["_ended", "ended_at", "started_at"]).drop("_ended")
