"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a local session may lack the setting; it gets a folder of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return base.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: what was drawn once (partitions, ids) stays so, and the lineage ends."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
