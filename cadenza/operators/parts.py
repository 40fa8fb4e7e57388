"""Tables in parts by key ranges: a merge reads and writes the parts that may hold its keys, all others stay by reference.

Each part is a file of neighbouring keys. Beside the parts lie two side tables: the range of each part's keys, and a Bloom filter of them in blocks of
512 bits. Keys to be merged meet the ranges by a sweep over one order (no key is compared with every range), then the blocks of the
parts whose range holds them; what passes both is read. Keys that no part has go to new parts, whose ranges may overlap old ones, so a late
row among old ones rewrites nothing; ``compact`` brings small parts together again.

Ranges suit keys that come in order (ids, times), where a write meets the latest parts only. ``tables.KeyedTable`` has hash buckets, which suit keys
without order. Pointers and conflicts are those of ``tables``; a writer that meets another does its work again, as the other may have brought the same
keys. Null keys are equal.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .stored import stored
from .sweep import sweep_join
from .tables import ATTEMPTS, Change, Conflict, Snapshot, commit, read, snapshot
from .upsert import one_per_key, upsert

PART_ROWS = 1_000_000
#: Up to so many parts are named to the scan of their filters, which passes over others; more are left to the join.
FEW = 1000
BLOCK_WORDS, KEY_BITS, PROBES = 8, 10, 7  # 512 bits a block, ten a key: some 1 % of foreign keys pass


def _key(keys: list[str], last: int) -> Column:
    """The keys and a number after them: with 0 a key's own place in the order, with 1 the place right after it."""
    return F.struct(*(F.col(k).alias(f"k{i}") for i, k in enumerate(keys)), F.lit(last).alias("last"))


def _bits(keys: list[str]) -> list[Column]:
    """The words of a block with a key's bits set."""
    h = F.xxhash64(*keys, F.lit("bits"))
    places = [F.shiftrightunsigned(h, 9 * i).bitwiseAND(511) for i in range(PROBES)]
    one = lambda p, w: F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(63).cast("int"))).otherwise(F.lit(0).cast("long"))
    return [reduce(lambda a, b: a.bitwiseOR(b), (one(p, w) for p in places)) for w in range(BLOCK_WORDS)]


def _block(keys: list[str], blocks: str) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit("block")), F.col(blocks))


class RangedTable:
    """A table of one row a key, in parts of about ``part_rows`` rows."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], part_rows: int = PART_ROWS):
        self.spark, self.root, self.keys, self.part_rows = spark, root, keys, part_rows

    def snapshot(self) -> Snapshot:
        return snapshot(self.spark, self.root)

    def read(self, at: Snapshot | None = None, only: set[str] | None = None) -> DataFrame:
        return read(self.spark, self.root, at or self.snapshot(), only)

    def _write(self, rows: DataFrame, version: str) -> dict[str, tuple[str | None, int]]:
        """New parts of ``rows`` and their side tables; part -> (version, rows)."""
        held = stored(rows, "merged")
        number = max(1, -(-held.count() // self.part_rows))
        name = F.concat(F.lit(f"p{uuid.uuid4().hex[:12]}-"), F.spark_partition_id())
        path = f"{self.root}/version={version}"
        held.repartitionByRange(number, *self.keys).withColumn("_bucket", name).sortWithinPartitions("_bucket", *self.keys).write.partitionBy("_bucket").parquet(path)
        made = self.spark.read.schema(StructType([*rows.schema.fields, StructField("_bucket", StringType())])).parquet(path)
        ranges = made.groupBy("_bucket").agg(F.min(_key(self.keys, 0)).alias("low"), F.max(_key(self.keys, 1)).alias("high"), F.count("*").alias("rows"))
        ranges = ranges.withColumn("blocks", F.ceil(F.col("rows") * KEY_BITS / (64 * BLOCK_WORDS)))
        ranges.write.parquet(f"{self.root}/_ranges/version={version}")
        ranges = self.spark.read.schema(ranges.schema).parquet(f"{self.root}/_ranges/version={version}")
        sized = made.join(F.broadcast(ranges.select("_bucket", "blocks")), "_bucket")  # a row a part, as in the pointer
        words = [F.bit_or(w).alias(f"w{i}") for i, w in enumerate(_bits(self.keys))]
        filters = sized.groupBy("_bucket", _block(self.keys, "blocks").alias("block")).agg(*words)
        # few files in the order of parts: a folder a part would hold a file of each task
        filters.repartitionByRange("_bucket").sortWithinPartitions("_bucket", "block").write.parquet(f"{self.root}/_filters/version={version}")
        return {r["_bucket"]: (version, r["rows"]) for r in ranges.select("_bucket", "rows").collect()}

    def hit(self, rows: DataFrame, at: Snapshot) -> set[str]:
        """The parts that may hold keys of ``rows``: all that do, and few others."""
        if not at.buckets:
            return set()
        live = self.spark.createDataFrame([(p,) for p in at.buckets], "_bucket string")
        ranges = self.spark.read.parquet(*(f"{self.root}/_ranges/version={v}" for v in sorted({v for v, _ in at.buckets.values()})))
        ranges = ranges.join(F.broadcast(live), "_bucket", "left_semi").withColumn("all", F.lit(1))
        keys = rows.select(*(F.col(k).alias(f"k_{i}") for i, k in enumerate(self.keys))).distinct()
        names = keys.columns
        near = stored(sweep_join(keys.withColumn("at", _key(names, 0)).withColumn("all", F.lit(1)), ranges, "all", "at", "low", "high"), "near")
        parts = sorted(r["_bucket"] for r in near.select("_bucket").distinct().collect())
        if not parts:
            return set()
        filters = self.spark.read.parquet(*(f"{self.root}/_filters/version={v}" for v in sorted({at.buckets[p][0] for p in parts})))
        if len(parts) <= FEW:
            filters = filters.where(F.col("_bucket").isin(parts))
        met = near.withColumn("block", _block(names, "blocks")).join(filters.hint("merge"), ["_bucket", "block"])
        there = reduce(lambda a, b: a & b, (F.col(f"w{i}").bitwiseAND(bits) == bits for i, bits in enumerate(_bits(names))))
        return {r["_bucket"] for r in met.where(there).select("_bucket").distinct().collect()}

    def _commit(self, new: Snapshot) -> bool:
        return commit(self.spark, self.root, new)

    def _replace(self, base: Snapshot, touched: set[str], rows: DataFrame) -> Change | None:
        """Publish ``rows`` in place of the parts ``touched``; None if another writer came first."""
        made = self._write(rows, f"{base.seq + 1:012d}-{uuid.uuid4().hex[:8]}")
        kept = {p: v for p, v in (base.buckets or {}).items() if p not in touched}
        new = Snapshot(base.seq + 1, None, kept | made, rows.schema.json())
        return Change(base, new, touched, set(made)) if self._commit(new) else None

    def upsert(self, rows: DataFrame, attempts: int = ATTEMPTS) -> Change | None:
        """Insert or update ``rows`` and publish; None if there are none."""
        rows = stored(one_per_key(rows, self.keys), "source")
        if rows.isEmpty():
            return None
        for _ in range(attempts):
            base = self.snapshot()
            touched = self.hit(rows, base)
            merged = upsert(self.read(base, touched), rows, self.keys)[0] if touched else rows
            if change := self._replace(base, touched, merged):
                return change
        raise Conflict(f"{self.root}: {attempts} attempts met other writers")

    def compact(self, attempts: int = ATTEMPTS) -> Change | None:
        """Bring the parts of less than half a part's rows together; None if there are no two."""
        for _ in range(attempts):
            base = self.snapshot()
            small = {p for p, (_, n) in (base.buckets or {}).items() if 2 * n < self.part_rows}
            if len(small) < 2:
                return None
            if change := self._replace(base, small, self.read(base, small)):
                return change
        raise Conflict(f"{self.root}: {attempts} attempts met other writers")
