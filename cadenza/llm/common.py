"""What several operators share: input tables, the shared work folder, written intermediates."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

#: Java and Python pattern of a word: a run of anything but ASCII white space. ``bytes.split()`` cuts alike.
WORD = r"[^\x20\x09-\x0D]+"
#: Python workers take texts in slices of about so many bytes.
SLICE_BYTES = 6 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``, the folder that driver and executors share.

    Only a local session may lack that setting; it then gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _own_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of about ``most`` bytes of ``column``, a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, to - at)
        at = to
