"""Published tables: versions beside each other, numbered pointers that only one writer can create, buckets that grow.

A table is a folder. Every write puts its files under a new ``version=`` and then creates the next pointer, a small file with the next
number that says where the table's parts lie. The pointer is created only if no other writer has taken its number, so of two
writers one learns of the other and does its work again, or only its pointer if the other has touched nothing that it
has read. Nothing is overwritten or deleted: readers see the table before or after, and a run that stops half-way leaves
an unused folder.

A file system must create a name once only: HDFS renames without overwriting, local disks link. On an object store without such an
operation two writers of one moment are not told apart.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A bucket above this is split when it is written; one task writes a bucket.
BUCKET_BYTES = 64 << 20
ATTEMPTS = 20


class Conflict(Exception):
    """Another writer has published since the table was read."""


@dataclass(frozen=True)
class Snapshot:
    """What a pointer says. buckets: name -> (version, bytes), version None for a bucket without rows; None: the version is the table."""

    seq: int = -1
    version: str | None = None
    buckets: dict[str, tuple[str | None, int]] | None = field(default=None, hash=False)
    schema: str | None = None


class _Files:
    """The few calls to the table's file system that Spark's readers and writers don't cover."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        path = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(path)] if self.fs.exists(path) else []

    def sizes(self, folder: str) -> dict[str, int]:
        """Bytes of each folder inside ``folder``."""
        return {n: self.fs.getContentSummary(self.path(f"{folder}/{n}")).getLength() for n in self.names(folder) if not n.startswith(("_SUCCESS", "."))}

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Put ``text`` in a new file as a whole; False if there is one of that name."""
        folder, base = name.rsplit("/", 1)
        made = f"{folder}/.{base}-{uuid.uuid4().hex}"
        out = self.fs.create(self.path(made), False)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self.fs.getUri().getScheme() == "file":
                files, of = self.jvm.java.nio.file.Files, lambda n: self.jvm.java.io.File(self.path(n).toUri().getPath()).toPath()
                files.createLink(of(name), of(made))
            else:
                none = self.jvm.org.apache.hadoop.fs.Options.Rename
                context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(made).toUri(), self.conf)
                context.rename(self.path(made), self.path(name), self._array(none))
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName():
                raise
            return False
        finally:
            self.fs.delete(self.path(made), False)

    def _array(self, kind):
        from pyspark import SparkContext

        return SparkContext._active_spark_context._gateway.new_array(kind, 0)


def snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The latest pointer; one with seq -1 if nothing has been published."""
    files = _Files(spark, root)
    names = [n for n in files.names(f"{root}/_pointers") if n.endswith(".json") and not n.startswith(".")]
    if not names:
        return Snapshot()
    found = json.loads(files.read(f"{root}/_pointers/{max(names)}"))
    buckets = found["buckets"]
    return Snapshot(found["seq"], found["version"], None if buckets is None else {b: (v, n) for b, v, n in buckets}, found["schema"])


def commit(spark: SparkSession, root: str, new: Snapshot) -> bool:
    """Create the pointer; False if its number is taken."""
    buckets = None if new.buckets is None else [[b, v, n] for b, (v, n) in sorted(new.buckets.items())]
    text = json.dumps({"seq": new.seq, "version": new.version, "buckets": buckets, "schema": new.schema})
    return _Files(spark, root).create(f"{root}/_pointers/{new.seq:012d}.json", text)


def publish(spark: SparkSession, df: DataFrame, root: str, version: str, base: Snapshot | None = None, gate: Callable[[DataFrame], None] | None = None) -> str:
    """Full replacement by ``df``. With ``base``, what ``df`` was made from, it is a ``Conflict`` if others have published since;
    without, the replacement goes on top of whatever there is. ``gate`` gets the version as written and raises if it may not be published."""
    path = f"{root}/version={version}"
    df.write.parquet(path)
    if gate:
        gate(spark.read.schema(df.schema).parquet(path))
    while True:
        last = base or snapshot(spark, root)
        if commit(spark, root, Snapshot(last.seq + 1, version, None, df.schema.json())):
            return path
        if base:
            raise Conflict(f"{root} has been published since number {base.seq} was read")


def published(spark: SparkSession, root: str) -> DataFrame:
    """The table that the latest pointer names."""
    last = snapshot(spark, root)
    if last.seq < 0:
        raise ValueError(f"PATH_NOT_FOUND: nothing has been published at {root}")
    return read(spark, root, last)


def replace(spark: SparkSession, root: str, change: Callable[[DataFrame], DataFrame], attempts: int = ATTEMPTS, gate: Callable[[DataFrame], None] | None = None) -> Snapshot:
    """Publish ``change`` of the table, on top of all that others publish meanwhile: on a conflict it is made, and passes the gate, again from what they left."""
    for _ in range(attempts):
        base = snapshot(spark, root)
        try:
            publish(spark, change(read(spark, root, base)), root, f"{base.seq + 1:012d}-{uuid.uuid4().hex[:8]}", base, gate)
            return snapshot(spark, root)
        except Conflict:
            continue
    raise Conflict(f"{root}: {attempts} attempts met other writers")


def read(spark: SparkSession, root: str, at: Snapshot, only: set[str] | None = None) -> DataFrame:
    """The table as of a snapshot, or some of its buckets."""
    if at.buckets is None:
        return spark.read.schema(_schema(at)).parquet(f"{root}/version={at.version}")
    paths = [f"{root}/version={v}/_bucket={b}" for b, (v, _) in sorted(at.buckets.items()) if v and (only is None or b in only)]
    return spark.read.schema(_schema(at)).parquet(*paths) if paths else spark.createDataFrame([], _schema(at))


def _schema(at: Snapshot) -> StructType:
    return StructType.fromJson(json.loads(at.schema))


def hash_bits(keys: list[str]) -> Column:
    return F.lpad(F.bin(F.xxhash64(*keys)), 64, "0")


@dataclass(frozen=True)
class Change:
    """A commit: the table before and after, and the buckets read and written."""

    before: Snapshot
    after: Snapshot
    read: set[str]
    written: set[str]


class KeyedTable:
    """A table of one row a key, in buckets by the leading bits of the keys' hash: "b" holds all, "b0" and "b1" its halves.

    A write reads and writes the buckets that its keys fall into. One that has grown beyond ``bucket_bytes`` is split into as many as it takes, each of
    one task, so tasks stay as large as they are while the table grows; the pointer holds the directory.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], bucket_bytes: int = BUCKET_BYTES):
        self.spark, self.root, self.keys, self.bucket_bytes = spark, root, keys, bucket_bytes

    def snapshot(self) -> Snapshot:
        return snapshot(self.spark, self.root)

    def read(self, at: Snapshot | None = None, only: set[str] | None = None) -> DataFrame:
        return read(self.spark, self.root, at or self.snapshot(), only)

    def placed(self, rows: DataFrame, buckets: set[str]) -> DataFrame:
        """``rows`` with their ``_bucket``."""
        if buckets == {"b"}:
            return rows.withColumn("_bucket", F.lit("b"))
        depths = sorted({len(b) - 1 for b in buckets})
        names = F.array(*(F.concat(F.lit("b"), F.substring("_bits", 1, d)) for d in depths))  # one of them is a bucket
        known = F.broadcast(self.spark.createDataFrame([(b,) for b in sorted(buckets)], "_bucket string"))  # as many as the pointer holds
        return rows.withColumn("_bits", hash_bits(self.keys)).withColumn("_bucket", F.explode(names)).join(known, "_bucket", "left_semi").select(*rows.columns, "_bucket")

    def _split(self, buckets: dict[str, int]) -> set[str]:
        """The names into which buckets of these sizes go."""
        out = set()
        for b, size in buckets.items():
            bits = max(0, math.ceil(math.log2(max(1.0, size / self.bucket_bytes))))
            out |= {b + (f"{i:0{bits}b}" if bits else "") for i in range(1 << bits)}
        return out

    def _write(self, rows: DataFrame, buckets: set[str], version: str) -> dict[str, tuple[str | None, int]]:
        path = f"{self.root}/version={version}"
        self.placed(rows, buckets).repartition("_bucket").write.partitionBy("_bucket").parquet(path)
        sizes = {n.removeprefix("_bucket="): s for n, s in _Files(self.spark, self.root).sizes(path).items()}
        found: dict[str, tuple[str | None, int]] = {b: (version if b in sizes else None, sizes.get(b, 0)) for b in buckets}
        large = {b: s for b, (_, s) in found.items() if s > 2 * self.bucket_bytes}
        if large:  # grown at one stroke: parted before anybody sees it
            at = Snapshot(0, version, {b: found[b] for b in large}, rows.schema.json())
            found = {b: v for b, v in found.items() if b not in large} | self._write(self.read(at), self._split(large), f"{version}-s")
        return found

    def _commit(self, new: Snapshot) -> bool:
        return commit(self.spark, self.root, new)

    def upsert(self, rows: DataFrame, attempts: int = ATTEMPTS) -> Change | None:
        """Insert or update ``rows`` and publish; None if there are none. Meeting other writers, only the pointer is made again
        if they have left the buckets alone that this write has read, else the write."""
        from .upsert import upsert

        for _ in range(attempts):
            base = self.snapshot()
            have = base.buckets or {"b": (None, 0)}
            touched = {r["_bucket"] for r in self.placed(rows, set(have)).select("_bucket").distinct().collect()}
            if not touched:
                return None
            like = base if base.schema else Snapshot(schema=rows.schema.json(), buckets=have)
            merged, _ = upsert(self.read(like, touched), rows, self.keys)
            made = self._write(merged, self._split({b: have[b][1] for b in touched}), f"{base.seq + 1:012d}-{uuid.uuid4().hex[:8]}")
            at = base
            while True:
                kept = {b: v for b, v in (at.buckets or have).items() if b not in touched}
                new = Snapshot(at.seq + 1, None, kept | made, merged.schema.json())
                if self._commit(new):
                    return Change(base, new, touched, set(made))
                at = self.snapshot()
                if any((at.buckets or {}).get(b) != (base.buckets or {}).get(b) for b in touched):
                    break  # what was read is no longer the table
        raise Conflict(f"{self.root}: {attempts} attempts met other writers")
