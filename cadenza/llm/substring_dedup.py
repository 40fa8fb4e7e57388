"""Operator 10: repeated passages by relative Lempel-Ziv parsing against an index of all documents.

The index is a table of all 13-word windows that occur in more than one document, each with the smallest
doc_id that has it and the first place there: a position in the reference. A document is parsed greedily from left to
right: a factor starts at a window that the index holds with a smaller doc_id and runs on while each following window is
held at the next position of the same reference, so a factor is one passage of its reference: (start, words, reference,
position). Windows across the end of a factor are looked up like all others, so what two references cover only together
is found too. Factors are at least a window long; the words of all factors are removed.

Steps: (1) every window names its anchor, the least hash of its 5-word shingles; anchors found in several documents
go into a bit table of fixed size (SKETCH_BITS; tasks pack it in blocks, so the driver passes on 16 MB, whatever the
input). A table that is nearly full, as with a corpus of many TB, only lets more windows through: at worst every window
is shuffled, 24 bytes a word before compression. (2) Windows whose anchor is in the table are hashed to 64 bits and grouped,
for the smallest position, after Spark's partial aggregation. (3) Windows join that index, and what has a smaller doc_id goes
back to its document. Only documents with such windows (a second bit table tells most others apart) are moved for the join.
Equal windows always share their anchor, so no window is lost; hashes are 64-bit polynomials, mixed, and
unequal windows meet with probability 2**-64 a pair: no such pair is expected up to some 10**9 windows, and some
10**6 among the 10**13 windows of a corpus of 100 TB.

A null text has no words. A null doc_id neither removes from others nor loses words. Rows with equal
doc_id don't remove from each other. Windows are judged on the input. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, written

WINDOW, SHINGLE = 13, 5
SKETCH_BITS, DOCUMENT_BITS = 27, 24
BASE = 0x5851F42D4C957F2D | 1
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, factors array<struct<start:int,words:int,reference:long,position:int>>"
_FACTORS = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("reference", pa.int64()), ("position", pa.int32())]))


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)


@lru_cache(4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    up, down = np.full(size, BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hashed:
    """The words of a text, and hashes of any number of words in a row."""

    def __init__(self, text: str | None):
        self.words = (text or "").encode("utf-8", "replace").split()
        n = len(self.words)
        if n < WINDOW:
            return
        data = np.frombuffer(b" ".join(self.words), np.uint8)
        lengths = np.fromiter(map(len, self.words), np.int64, n)
        self.ends = np.cumsum(lengths + 1) - 1
        self.starts = self.ends - lengths
        up, self.down = _powers(1 << max(12, int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_letters()[data] * up[: len(data)], out=self.sums[1:])

    def rows(self, k: int) -> np.ndarray:
        s, e = self.starts[: len(self.words) - k + 1], self.ends[k - 1 :]
        return _mixed((self.sums[e] - self.sums[s]) * self.down[s])

    def windows(self) -> np.ndarray:
        return self.rows(WINDOW) if len(self.words) >= WINDOW else np.zeros(0, np.uint64)

    def anchors(self) -> np.ndarray:
        """Each window's anchor."""
        if len(self.words) < WINDOW:
            return np.zeros(0, np.uint64)
        h, width = self.rows(SHINGLE), 1
        whole = WINDOW - SHINGLE + 1
        while width < whole:
            step = min(width, whole - width)
            h = np.minimum(h[:-step], h[step:])
            width += step
        return h


BLOCK_BITS = 17
PACKED_BITS = 62


def _bits(column: str, bits: int, df: DataFrame) -> np.ndarray:
    """A table of 2**bits bits with the bit of each hash in ``column`` set: of fixed size, whatever the rows. It comes to
    the driver in blocks of 16 KB that tasks have packed."""
    place = F.shiftrightunsigned(column, 64 - bits)
    words = df.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned({column}, {64 - bits}) & 63 as int))")).alias("bits"))
    size = 1 << (min(bits, BLOCK_BITS) - 6)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, np.ndarray] = {}
        for batch in batches:
            word, held = batch.column("word").to_numpy(), batch.column("bits").to_numpy()
            for block in np.unique(word // size).tolist():
                here = word // size == block
                blocks.setdefault(block, np.zeros(size, np.int64))[word[here] % size] = held[here]
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int64()), pa.array([b.tobytes() for b in blocks.values()], pa.binary())], ["block", "data"])

    packed = words.repartition(max(1, (1 << bits >> BLOCK_BITS) // 32), F.floor(F.col("word") / size)).mapInArrow(pack, "block long, data binary").toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    for block, data in zip(packed["block"].to_pylist(), packed["data"]):
        out[block * size : (block + 1) * size] = np.frombuffer(data.as_buffer(), np.int64)
    return out.view(np.uint64)


def _held(sketch: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    place = hashes >> np.uint64(64 - bits)
    return (sketch[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def _id_hash(ids: np.ndarray) -> np.ndarray:
    return _mixed(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


def _hashes(docs: DataFrame, sketch=None) -> DataFrame:
    """(hash, doc_id, place), once for each document, at its first place: of anchors or, with ``sketch``, of windows whose
    anchor it holds."""

    def row_batch(out: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        hashes, ids, places = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(ids), pa.array(places.astype(np.int32))], ["hash", "doc_id", "place"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, n = [], 0
            for i, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                h = Hashed(text.as_py())
                found = h.anchors()
                places = np.arange(len(found))
                if sketch is not None and len(found):
                    places = np.flatnonzero(_held(sketch.value, found, SKETCH_BITS))
                    found = h.windows()[places]
                found, first = np.unique(found, return_index=True)
                out.append((found, np.full(len(found), i, np.int64), places[first]))
                n += len(found)
                if n > 1 << 16:
                    yield row_batch(out)
                    out, n = [], 0
            if out:
                yield row_batch(out)

    return docs.where("doc_id is not null").mapInArrow(hashed, "hash long, doc_id long, place int")


def factors(hashes: np.ndarray, known: np.ndarray, references: np.ndarray, positions: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, words, reference, position) of the greedy parse; ``known`` ascends."""
    if not len(known) or not len(hashes):
        return []
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    places = np.flatnonzero(known[at] == hashes)
    if not len(places):
        return []
    source, position = references[at[places]], positions[at[places]]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(places) != 1) | (np.diff(source) != 0) | (np.diff(position) != 1))))
    last = np.append(new[1:], len(places)) - 1
    return [(s, e - s + WINDOW, r, p) for s, e, r, p in zip(places[new].tolist(), places[last].tolist(), source[new].tolist(), position[new].tolist())]


def _positions(docs: DataFrame) -> tuple[Column, Column, Column]:
    """(reference, position, first): a document and a place in it as one value that orders by both, and what it holds. It is
    a long where the ids' range and the longest text leave enough bits, which hash aggregates take; else a struct."""
    low, high, most = docs.agg(F.min("doc_id"), F.max("doc_id"), F.max(F.octet_length("text"))).first()
    low, bits = low or 0, ((most or 0) // 2 + 1).bit_length()  # a word and a space are two bytes
    if ((high or 0) - low).bit_length() + bits > PACKED_BITS:
        return F.col("first.doc_id"), F.col("first.place"), F.struct("doc_id", "place")
    packed = F.shiftleft(F.col("doc_id") - low, bits) + F.col("place")
    return F.shiftright("first", bits) + low, F.col("first").bitwiseAND(F.lit((1 << bits) - 1).cast("long")).cast("int"), packed


def _result(doc_id: int | None, hashed: Hashed, found: list[tuple[int, int, int, int]], texts: bool) -> tuple:
    words = hashed.words
    keep = np.ones(len(words), bool)
    for start, n, *_ in found:
        keep[start : start + n] = False
    kept = b" ".join(w for w, k in zip(words, keep.tolist()) if k) if found else b" ".join(words)
    return doc_id, len(words), int((~keep).sum()), hashlib.sha256(kept).hexdigest(), kept.decode() if texts else None, [dict(zip(("start", "words", "reference", "position"), f)) for f in found]


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), _FACTORS]
    names = [c.name for c in pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string()), ("factors", _FACTORS)])]
    out = []
    for row in rows:
        out.append(row)
        if len(out) == 500:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def parse(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (the text that stays; null without ``texts``) and factors of each document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    shared = _hashes(docs).groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    sketch = spark.sparkContext.broadcast(_bits("hash", SKETCH_BITS, shared))
    windows = _hashes(docs, sketch)
    reference, position, first = _positions(docs)
    index = windows.groupBy("hash").agg(F.min(first).alias("first"), F.count("*").alias("n")).where("n > 1").select("hash", reference.alias("reference"), position.alias("position"))
    hits = windows.select("hash", "doc_id").join(index.hint("merge"), "hash").where("doc_id > reference")
    hits = hits.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("hash", "reference", "position"))).alias("hits"))  # no more than the document has windows
    hits = written(hits.select("doc_id", F.col("hits.hash").alias("hashes"), F.col("hits.reference").alias("references"), F.col("hits.position").alias("positions")), "hits")

    def id_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_id_hash(np.array(batch.column("doc_id").to_pylist(), np.int64)).view(np.int64))], ["hash"])

    touched = spark.sparkContext.broadcast(_bits("hash", DOCUMENT_BITS, hits.select("doc_id").mapInArrow(id_hashes, "hash long")))

    def maybe(batch: pa.RecordBatch) -> np.ndarray:
        ids = np.array([x or 0 for x in batch.column("doc_id").to_pylist()], np.int64)
        return _held(touched.value, _id_hash(ids), DOCUMENT_BITS) if len(ids) else np.zeros(0, bool)

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.filter(pa.array(~maybe(batch)))
            yield from _batches(_result(i.as_py(), Hashed(t.as_py()), [], texts) for i, t in zip(part.column("doc_id"), part.column("text")))

    def others(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(maybe(batch)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for i in range(batch.num_rows):
                doc_id, text, *held = (batch.column(c)[i].as_py() for c in ("doc_id", "text", "hashes", "references", "positions"))
                h = Hashed(text)
                known, references, positions = (np.array(x or [], np.int64) for x in held)
                order = np.argsort(known.view(np.uint64))  # Spark sorts longs as signed
                yield _result(doc_id, h, factors(h.windows(), known.view(np.uint64)[order], references[order], positions[order]), texts)

        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                yield from _batches(rows(batch.slice(at, 500)))

    joined = docs.mapInArrow(others, "doc_id long, text string").join(hits, "doc_id", "left")
    return docs.mapInArrow(untouched, RESULT).unionByName(joined.select("doc_id", "text", "hashes", "references", "positions").mapInArrow(cut, RESULT))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13)
),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
c AS (SELECT DISTINCT doc_id, i + unnest(range(13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id),
t AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w WHERE len(ws) > 0),
k AS (
  SELECT t.doc_id, array_to_string(list(t.ws[t.p] ORDER BY t.p) FILTER (WHERE c.p IS NULL), ' ') AS kept, count(c.p) AS removed
  FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.p = c.p GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)
"""
