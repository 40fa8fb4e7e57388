"""Operator 1: token ids as length-delimited binary records with a separate offset index.

A file is a sequence of frames, each::

    length   unsigned 64-bit little-endian: bytes of the payload
    crc      unsigned 32-bit little-endian: masked CRC-32 of the 8 length bytes
    payload  1 byte: 1 if the document has an id, else 0; 8 bytes: the id (signed, little-endian);
             1 byte: bytes per token id (2 or 4); then the ids, little-endian, unsigned
    crc      masked CRC-32 of the payload
    newline  one byte, 0x0A

Files are numbered in ascending order of doc_id and records ascend inside each file. The index is
a Parquet table beside the files: file, ordinal, offset, length, doc_id, n_tokens, start_in_file and
ids_crc32, so that a reader can take records in any order: ``read_at`` cuts them out by offset and length.

Frames are written by Spark's text writer, which puts out a string column's bytes as they are, valid UTF-8 or not, and
ends each row with its separator, here the frame's newline. The writer needs no file system of its own so.

Null texts count as empty; a null doc_id sorts first. Repeated doc_ids are separate records, ordered
by the text's hash and then the text, so that a hot id is spread over files; only rows with equal id and text are
kept together. An empty table gives no records. Other columns are ignored. A text that holds a zero byte or
begins with white space is encoded as one piece.

Workers take texts in small slices, since the lists and arrays that encode a slice take some ten times its bytes; they give
unused memory back after each batch and what they know of chunks when files are read, so that it adds little to an executor's.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import slices, table, work_folder

TEXT_BYTES_PER_FILE = 32 << 20
CACHED_CHUNKS = 300_000
#: Texts are encoded in slices of about so many bytes.
ENCODE_BYTES = 1 << 20
INDEX = "file int, ordinal int, offset long, length long, doc_id long, n_tokens long, start_in_file long, ids_crc32 long"

_HEAD = struct.Struct("<QI")
_KEY = struct.Struct("<bqb")
_CRC = struct.Struct("<I")
_MARKS = ".,;:!?"
_CUT = "\0"
_SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"  # at least all that the tokenizer takes for white space
#: White space after a space or newline, or at the start: not every space and newline is a place to cut.
_UNSAFE = rf"[ \n][{_SPACE}]|^[{_SPACE}]"
_SAFE = rf"([ \n])([^{_SPACE}])"


def masked_crc(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


class ChunkEncoder:
    """Encodes texts with a byte-level BPE tokenizer, chunk by chunk.

    The tokenizer's splitting pattern always cuts before a space or newline that precedes a visible character, whatever
    stands before, so the ids of a text are those of its chunks. Arrow cuts a slice of texts and numbers
    its distinct chunks, these are looked up or encoded once each, and numpy puts their ids together.
    A text begins a line for this purpose; that newline's id is taken away again.
    """

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        self.begins = {}
        for lead, name in ((" ", "\u0120"), ("\n", "\u010a")):  # the byte-level names of a space and a newline
            self.begins[lead] = np.zeros(max(tokens.values()) + 1, bool)
            self.begins[lead][[i for t, i in tokens.items() if t.startswith(name)]] = True
        self.marks = dict(zip(_MARKS, self._ids(list(_MARKS))))

    def pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [self.pack(e.ids) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word_ids(self, chunks: list[str], lead: str) -> list[bytes]:
        """The ids of ``chunks``, which begin with ``lead`` and hold no other white space: encoded as one text and cut there."""
        packed, width = [], self.dtype.itemsize
        for i in range(0, len(chunks), 20_000):
            part = chunks[i : i + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast(["".join(part)], add_special_tokens=False)[0].ids, self.dtype)
            starts = np.flatnonzero(self.begins[lead][ids])
            if len(starts) != len(part):  # never seen; then the slow way
                packed += self._ids(part)
                continue
            data, cuts = ids.tobytes(), [*(starts * width).tolist(), len(ids) * width]
            packed += [data[s:e] for s, e in zip(cuts, cuts[1:])]
        return packed

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """The ids of distinct chunks that ``known`` lacks. When ``known`` is full it becomes ``older``."""
        older, known, marks = self.older, self.known, self.marks
        found = {x: older[x] for x in chunks if x in older}
        # a mark after a plain letter is a piece of its own, so the word before it needs encoding only once
        marked, words = [], {}
        for x in chunks if not found else [x for x in chunks if x not in found]:
            if x[-1] in marks and len(x) > 2 and x[-2] < "\u0250" and x[-2].isalpha():
                marked.append(x)
                x = x[:-1]
            words[x] = None
        found.update((x, known[x]) for x in words if x in known)
        plain, rest = {lead: [] for lead in self.begins}, []
        for x in words:
            if x not in found:
                (plain[x[0]] if x.split() == [x[1:]] else rest).append(x)
        for lead, those in plain.items():
            found.update(zip(those, self._word_ids(those, lead)))
        found.update(zip(rest, self._ids(rest)))
        found.update((x, found[x[:-1]] + marks[x[-1]]) for x in marked)
        if len(known) + len(found) > CACHED_CHUNKS:
            self.older, self.known = known, {}
        self.known.update(found)
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The packed ids of each text; null is as empty."""
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring(texts, _CUT)  # holds the mark that cuts are shown by: encoded as it is
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False) | pc.match_substring_regex(texts, rf"^[{_SPACE}]").to_numpy(zero_copy_only=False))
        given = dict(zip(odd.tolist(), self._ids(texts.take(pa.array(odd)).to_pylist())))
        texts = pc.if_else(whole, "", texts)
        unsafe = pc.match_substring_regex(texts, _UNSAFE)
        lined = pc.binary_join_element_wise("\n", texts, "")
        cut = pc.replace_substring(pc.replace_substring(lined, " ", _CUT + " "), "\n", _CUT + "\n")
        if pc.any(unsafe).as_py():
            cut = pc.if_else(unsafe, pc.replace_substring_regex(lined, _SAFE, rf"{_CUT}\1\2"), cut)
        split = pc.split_pattern(cut, _CUT)
        bounds = split.offsets.to_numpy().astype(np.int64)
        numbered = split.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
        chunks, at = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        packed = list(map(self.known.get, chunks))
        gaps = [i for i, p in enumerate(packed) if p is None]
        if gaps:
            found = self._learn([c for i in gaps if (c := chunks[i])])
            found[""] = b""
            for i in gaps:
                packed[i] = found[chunks[i]]
        flat = np.frombuffer(b"".join(packed), self.dtype)
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        n = sizes[at]
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts[at] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        edges = np.concatenate(([0], ends))[bounds - bounds[0]].tolist()
        out = [ids[s + 1 : e].tobytes() for s, e in zip(edges, edges[1:])]
        for i, x in given.items():
            out[i] = x
        return out


@lru_cache(1)
def encoder_of(tokenizer_file: str) -> ChunkEncoder:
    """One for each Python worker: what it knows serves the worker's later tasks too."""
    return ChunkEncoder(tokenizer_file)


def frame(doc_id: int | None, ids: bytes, width: int) -> bytes:
    payload = _KEY.pack(doc_id is not None, doc_id or 0, width) + ids
    length = struct.pack("<Q", len(payload))
    return length + _CRC.pack(masked_crc(length)) + payload + _CRC.pack(masked_crc(payload))


def frames(data: bytes | memoryview) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length with its newline, doc_id, ids) of each record; a wrong checksum is an error."""
    at = 0
    while at < len(data):
        size, crc = _HEAD.unpack_from(data, at)
        if masked_crc(data[at : at + 8]) != crc:
            raise ValueError(f"wrong length checksum at byte {at}")
        payload = data[at + 12 : at + 12 + size]
        if masked_crc(payload) != _CRC.unpack_from(data, at + 12 + size)[0]:
            raise ValueError(f"wrong payload checksum at byte {at}")
        known, doc_id, width = _KEY.unpack_from(payload)
        yield at, size + 17, doc_id if known else None, np.frombuffer(payload, f"<u{width}", offset=_KEY.size)
        at += size + 17


def encoded(batches: Iterator[pa.RecordBatch], tokenizer_file: str, end_id: int) -> Iterator[pa.RecordBatch]:
    """The frame of each row (doc_id, text)."""
    encoder = encoder_of(tokenizer_file)
    end, width = encoder.pack([end_id]), encoder.dtype.itemsize
    for batch in batches:
        for part in slices(batch, "text", ENCODE_BYTES):
            ids = encoder.encode(part.column("text"))
            out = [frame(d, x + end, width) for d, x in zip(part.column("doc_id").to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
        pa.default_memory_pool().release_unused()


def write_token_records(docs: DataFrame, path: str, tokenizer_file: str, end_id: int, bytes_per_file: int = TEXT_BYTES_PER_FILE) -> None:
    """Encode ``docs`` (doc_id, text) in ascending doc_id order into numbered files under ``path``/data."""
    docs = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return encoded(batches, tokenizer_file, end_id)

    parts = docs.repartitionByRange(max(1, -(-total // bytes_per_file)), "doc_id", "tag").sortWithinPartitions("doc_id", "tag", "text")
    parts.select("doc_id", "text").mapInArrow(encode, "frame binary").select(F.col("frame").cast("string").alias("value")).write.option("lineSep", "\n").text(f"{path}/data")


def _read(spark: SparkSession, path: str, schema: str, rows) -> DataFrame:
    """``rows(file, data)`` of every file."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()  # files are read when all are written
        for batch in batches:
            for name, data in zip(batch.column("path"), batch.column("content")):
                yield from rows(int(re.search(r"part-(\d+)", name.as_py())[1]), memoryview(data.as_buffer()))
            pa.default_memory_pool().release_unused()

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    return files.select("path", "content").mapInArrow(parse, schema)


def write_index(spark: SparkSession, path: str) -> None:
    """Check every record and write the offset index to ``path``/index."""

    def rows(file: int, data: memoryview) -> Iterator[pa.RecordBatch]:
        out, start = [], 0
        for i, (offset, length, doc_id, ids) in enumerate(frames(data)):
            out.append((file, i, offset, length, doc_id, len(ids), start, zlib.crc32(ids.astype("<u4").tobytes())))
            start += len(ids)
        if out:
            types = [pa.int32()] * 2 + [pa.int64()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [c.split()[0] for c in INDEX.split(", ")])

    _read(spark, path, INDEX, rows).write.parquet(f"{path}/index")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The index with ``start``: tokens of all records before it, over all files."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = index.groupBy("file").agg(F.sum("n_tokens").alias("n")).select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("file_start"))
    return index.join(files, "file").withColumn("start", F.col("file_start") + F.col("start_in_file")).drop("file_start")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, file, ordinal, ids) of every record."""

    def rows(file: int, data: memoryview) -> Iterator[pa.RecordBatch]:
        for i, (_, _, doc_id, ids) in enumerate(frames(data)):
            yield pa.RecordBatch.from_arrays([pa.array([doc_id], pa.int64()), pa.array([file], pa.int32()), pa.array([i], pa.int32()), pa.array([ids.astype(np.int32)], pa.list_(pa.int32()))], ["doc_id", "file", "ordinal", "ids"])

    return _read(spark, path, "doc_id long, file int, ordinal int, ids array<int>", rows)


def read_at(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """(place, doc_id, ids) of the records that ``wanted`` (place, file, offset, length) names, each cut out of its file
    by offset and length and checked; the other records of the file are not looked at."""
    n = (wanted.agg(F.max("file")).first()[0] or 0) + 1
    places = wanted.select("file", F.struct("offset", "length", "place").alias("at")).repartition(n, "file").groupBy("file").agg(F.array_sort(F.collect_list("at")).alias("at"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")
    files = files.select(F.regexp_extract("path", r"part-(\d+)", 1).cast("int").alias("file"), "content").repartition(n, "file")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, at in zip(batch.column("content"), batch.column("at")):
                data, out = memoryview(data.as_buffer()), []
                for x in at.as_py():
                    ((_, size, doc_id, ids),) = frames(bytes(data[x["offset"] : x["offset"] + x["length"]]))
                    out.append((x["place"], doc_id, ids.astype(np.int32)))
                for i in range(0, len(out), 500):
                    place, doc_id, ids = zip(*out[i : i + 500])
                    yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(doc_id, pa.int64()), pa.array(ids, pa.list_(pa.int32()))], ["place", "doc_id", "ids"])

    return files.join(places.hint("merge"), "file").select("content", "at").mapInArrow(fetch, "place long, doc_id long, ids array<int>")


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """(place, doc_id, ids) in an order drawn from ``seed``, each record fetched by the index."""
    index = spark.read.schema(INDEX).parquet(f"{path}/index")
    wanted = index.select(F.xxhash64(F.lit(seed), "file", "ordinal").alias("place"), "file", "offset", "length")
    return read_at(spark, path, wanted).orderBy("place")


def token_records(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """Write ``docs`` and the index to the shared folder and return the index, read from there."""
    spark = docs.sparkSession
    path = work_folder(spark, "tokens")
    write_token_records(docs, path, tokenizer_file, end_id)
    write_index(spark, path)
    return read_index(spark, path)


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    index = token_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 2)
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "file", "offset", "length")
