"""Operator 11: SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of a model has a white-space marker after another character, a piece never reaches from one marked word
into the next, so a text's pieces are those of its chunks: runs of markers, each with the word that follows. A slice of
texts is cut into chunks, Arrow numbers the distinct ones, the library segments each distinct chunk once (a worker keeps what it
has seen for its later slices), and numpy joins the ids back by the chunks' positions. Decoding goes the same way: ids are cut
before each piece that begins with a marker, each distinct sequence is decoded once, and the texts are joined back.

The table is one of a slice and worker, not of the corpus: a table of all chunks would have to be joined with every
occurrence of every word, a shuffle of several times the input, and its size has no bound. Nothing is shuffled here.
The model's conditions are checked when it is read: an identity normalizer, a dummy prefix, no piece across markers. A model that
meets them not is right all the same: then each whole text is one chunk.

A null text counts as empty and gives no ids; null ids give an empty text. Very long texts are cut like others, in a slice of their own; memory follows
the longest text. A word without white space, however long, is one chunk. Texts with a zero byte are one chunk each. A marker in a text is as a space. Each row gives
a row, repeated or not, with a null doc_id too; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from .common import slices, table

MARK = "▁"
_CUT = "\0"
SLICE_BYTES = 2 << 20
KNOWN_CHUNKS = 200_000


class _Known:
    """What a worker has worked out: two generations, the older one dropped when the younger is full."""

    def __init__(self, work):
        self.work, self.young, self.old = work, {}, {}

    def __call__(self, chunks: list) -> list:
        if len(self.young) + len(chunks) > KNOWN_CHUNKS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new = [c for c in chunks if c not in young]
        young.update((c, old[c]) for c in new if c in old)
        new = [c for c in new if c not in young]
        young.update(zip(new, self.work(new)))
        return [young[c] for c in chunks]


class ChunkTable:
    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor
        from sentencepiece.sentencepiece_model_pb2 import ModelProto

        self.model = SentencePieceProcessor(model_file=model_file)
        proto = ModelProto.FromString(self.model.serialized_model_proto())
        rules, pieces = proto.normalizer_spec, [p.piece for p in proto.pieces]
        plain = not rules.precompiled_charsmap and rules.add_dummy_prefix and not rules.remove_extra_whitespaces and rules.escape_whitespaces
        #: do chunks stand alone?
        self.apart = plain and not proto.trainer_spec.treat_whitespace_as_suffix and not any(MARK in p.lstrip(MARK) for p in pieces)
        self.begins = np.array([p.startswith(MARK) for p in pieces])
        self.names = pa.array([str(i) for i in range(len(pieces))])
        self._ids, self._texts = _Known(self._segmented), _Known(self._read)

    def _segmented(self, chunks: list[str]) -> list[bytes]:
        """The packed ids of each chunk, which begins with the space that the library puts before a text."""
        ids = self.model.encode([c[1:] for c in chunks], num_threads=1)
        mark = self.model.piece_to_id(MARK)
        return [np.array([mark] if c == " " else i, "<i4").tobytes() for c, i in zip(chunks, ids)]

    def _read(self, chunks: list[bytes]) -> list[str]:
        return self.model.decode([np.frombuffer(c, "<i4").tolist() for c in chunks])

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(i, "<i4").tobytes() for i in self.model.encode(texts, num_threads=1)]

    def encode(self, texts: pa.Array) -> pa.Array:
        """The ids of each text, as lists."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring(texts, _CUT) if self.apart else pa.array(np.ones(len(texts), bool))
        at = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        given = dict(zip(at.tolist(), self._whole(texts.take(pa.array(at)).to_pylist())))
        texts = pc.replace_substring(pc.if_else(odd, "", texts), MARK, " ")
        lined = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        runs = pc.match_substring(lined, "  ")
        cut = pc.replace_substring(lined, " ", _CUT + " ")
        if pc.any(runs).as_py():  # a run of spaces belongs to the word after it
            cut = pc.if_else(runs, pc.replace_substring_regex(lined, "([^ ]) ", rf"\1{_CUT} "), cut)
        split = pc.split_pattern(cut, _CUT)
        bounds = split.offsets.to_numpy().astype(np.int64)
        numbered = split.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
        chunks, codes = numbered.dictionary.to_pylist(), numbered.indices.to_numpy()
        some = [c for c in chunks if c]
        found = dict(zip(some, self._ids(some))) | {"": b""}
        packed = [found[c] for c in chunks]
        flat = np.frombuffer(b"".join(packed), "<i4")
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        starts, n = np.cumsum(sizes) - sizes, sizes[codes]
        ends = np.cumsum(n)
        ids = flat[np.repeat(starts[codes] - (ends - n), n) + np.arange(int(n.sum()))]
        edges = np.concatenate(([0], ends))[bounds - bounds[0]]
        if given:
            parts = [np.frombuffer(given[i], "<i4") if i in given else ids[s:e] for i, (s, e) in enumerate(zip(edges, edges[1:]))]
            edges = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
            ids = np.concatenate(parts)
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids, pa.int32()))

    def decode(self, ids: pa.Array) -> pa.Array:
        """The text of each list of ids."""
        ids = pc.fill_null(ids, pa.scalar([], pa.list_(pa.int32())))
        bounds = ids.offsets.to_numpy().astype(np.int64)
        flat = ids.values.to_numpy()[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        full = np.diff(bounds) > 0
        begins = self.begins[flat] if self.apart else np.zeros(len(flat), bool)
        # what stands before a list's first marker is decoded together with it, as only a text's first marker is dropped
        before = np.concatenate(([0], np.cumsum(begins)))
        firsts = np.flatnonzero(begins)
        own = full & (before[bounds[1:]] > before[bounds[:-1]])
        begins[firsts[before[bounds[:-1]][own]]] = False
        begins[bounds[:-1][full]] = True
        cuts = np.append(np.flatnonzero(begins), len(flat))
        buffers = [None, pa.py_buffer((cuts * 4).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(flat, "<i4"))]
        numbered = pa.Array.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).dictionary_encode()
        texts = pa.array(self._texts(numbered.dictionary.to_pylist()), pa.string()).take(numbered.indices)
        edges = pa.array(np.searchsorted(cuts, bounds), pa.int32())
        return pc.binary_join(pa.ListArray.from_arrays(edges, texts), " ")

    def digests(self, ids: pa.Array) -> list[str]:
        """The SHA-256 of each list's decimal ids, joined by commas."""
        bounds = ids.offsets
        names = self.names.take(ids.values)
        return [_sha256(x) for x in pc.binary_join(pa.ListArray.from_arrays(bounds, names), ",")]


def _sha256(text: pa.Scalar) -> str:
    return hashlib.sha256(text.as_buffer()).hexdigest()


@lru_cache(1)
def table_of(model_file: str) -> ChunkTable:
    """One for each Python worker."""
    return ChunkTable(model_file)


_Batches = Iterator[pa.RecordBatch]


def _encoded(batches: _Batches, model_file: str) -> _Batches:
    for batch in batches:
        for part in slices(batch, "text", SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), table_of(model_file).encode(part.column("text"))], ["doc_id", "ids"])


def _decoded(batches: _Batches, model_file: str) -> _Batches:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([*batch.columns, table_of(model_file).decode(batch.column("ids"))], ["doc_id", "ids", "text"])


def _digested(batches: _Batches, model_file: str) -> _Batches:
    for batch in batches:
        ids, texts = batch.column("ids"), batch.column("text")
        columns = [pc.list_value_length(ids).cast(pa.int64()), pa.array(table_of(model_file).digests(ids), pa.string())]
        columns.append(pa.array([_sha256(t) for t in texts], pa.string()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids) of each row of (doc_id, text)."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(lambda b: _encoded(b, model_file), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """(doc_id, ids, text) of each row of (doc_id, ids)."""
    rows = encoded.selectExpr("cast(doc_id as long) doc_id", "cast(ids as array<int>) ids")
    return rows.mapInArrow(lambda b: _decoded(b, model_file), "doc_id long, ids array<int>, text string")


def round_trip_digests(docs: DataFrame, model_file: str) -> DataFrame:
    """Count and digests of each text's ids and of the text that these decode to: both ways in one Python stage."""
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    rows = docs.selectExpr("cast(doc_id as long) doc_id", "text")
    return rows.mapInArrow(lambda b: _digested(_decoded(_encoded(b, model_file), model_file), model_file), schema)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return round_trip_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
