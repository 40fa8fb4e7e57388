"""Operator 4: near duplicates by SimHash, linked through multi-index hashing.

Fingerprint: letters A-Z are lower-cased, words are runs of non-white-space (ASCII), shingles are three
words joined by a space, repeats included (a shorter text is one shingle, a text without words has
fingerprint zero). A bit is 1 if it is set in more than half of the shingles' XXH64 (seed 42).

Search: a fingerprint has two segments of 32 bits. Two fingerprints within 3 bits are within 1 bit in
one of the segments, so each looks up the 33 values of that small ball in a table of segment values,
and each match is verified over all 64 bits. Equal fingerprints are one entry, however many
documents hold them.

A null text has fingerprint zero, as an empty one. Documents with equal doc_id keep their rows. A null
doc_id takes no part in the choice of a component's smallest id (null if no member has one). An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written
from .components import components

SHINGLE_WORDS, RADIUS = 3, 3


def shingle_hashes(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The XXH64 of each shingle, repeats included; none for a text without words."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    whole = b" ".join(words)
    if len(words) < shingle_words:
        cuts = [(0, len(whole))]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        cuts = zip(starts[: len(words) - shingle_words + 1].tolist(), ends[shingle_words - 1 :].tolist())
    return np.fromiter((xxh64_intdigest(whole[s:e], 42) for s, e in cuts), np.uint64, max(1, len(words) - shingle_words + 1))


def fingerprint(text: str | None) -> int:
    return fingerprint_of(shingle_hashes(text))


def fingerprint_of(hashes: np.ndarray) -> int:
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 13):  # bounded memory for long texts
        ones += np.unpackbits(hashes[at : at + (1 << 13)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, fp): tag is a hash of the text; fp is the fingerprint as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(fps)], ["doc_id", "tag", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"), "text").mapInArrow(hashed, "doc_id long, tag long, fp long")


def links(fps: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct fingerprints ``fp`` that differ in 1 to 3 bits."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    # a segment's value with its number in the bit above it
    held = fps.select(F.col("fp").alias("b"), F.explode(F.array(low, high.bitwiseOR(F.lit(1 << 32)))).alias("segment"))
    masks = F.array(F.lit(0).cast("long"), *(F.lit(1 << i).cast("long") for i in range(32)))
    asked = held.select(F.col("b").alias("a"), F.col("segment").alias("own"), F.explode(masks).alias("mask"))
    asked = asked.select("a", F.col("own").bitwiseXOR(F.col("mask")).alias("segment"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    return asked.join(held.hint("merge"), "segment").where((F.col("a") < F.col("b")) & near).select("a", "b").distinct()


def _grouped(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, fp, root, component_id) of each document; a root is a component's least fingerprint."""
    hashed = written(fingerprints(docs), "fingerprints")
    distinct = written(hashed.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    member = components(links(distinct.select("fp")))
    rooted = distinct.join(member, distinct.fp == member.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return hashed.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def simhash_components(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) of each document; the id is the smallest one that links reach."""
    return _grouped(docs).select("doc_id", "fp", "component_id")


def only(docs: DataFrame, keep: DataFrame) -> DataFrame:
    """One row of ``docs`` for each row of ``keep`` (none: is the id null; id; tag: a hash of the text). Of rows with equal
    id and text, the one whose other columns have the smallest hash stays."""
    key = ["none", "id", "tag"]
    rows = docs.select(F.struct("*").alias("doc"), F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.xxhash64("text").alias("tag"))
    others = F.xxhash64(F.to_json(F.col("doc").dropFields("text")))
    return rows.join(keep.select(*key), key, "left_semi").groupBy(*key).agg(F.min_by("doc", others).alias("doc")).select("doc.*")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest id (of equal ids, with the smallest hash of its
    text, then of the whole row; a document without an id only where none has one)."""
    first = _grouped(docs).groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tag")).alias("k"))
    return only(docs, first.select("k.*"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
