import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import pieces as P

public = pytest.importorskip("public_tokenizers")
FILE = public.path("piece_bpe_32k.model")
PARTS = ["a", "B", " ", "  ", "   ", "\n", "\t", "'s", "é", "ß", "1", "23", ".", "<s>", "<0x0A>", "\r\n", "▁", "\0", "漢", "😀", " the", "　", "\xa0", "ing", "é", "�", "ﬁ", "ขข"]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=FILE)


def texts(rows):
    rng = random.Random(1)
    odd = ["", " ", "  ", " a", "a ", "a  ", "▁", "a▁▁b", "x" * 5000, " " * 300, "\0", "a\0 b"]
    return odd + ["".join(rng.choices(PARTS, k=rng.randint(0, 30))) for _ in range(3000)] + [t or "" for _, t, _ in rows]


def test_ids_and_texts_are_the_library_s(library, rows):
    own, given = P.ChunkTable(FILE), texts(rows)
    assert own.apart
    want = library.encode(given, num_threads=1)
    got = own.encode(pa.array([*given, None]))
    assert got.to_pylist() == [*want, []]
    assert own.decode(got).to_pylist() == [*library.decode(want), ""]
    assert own.decode(got.slice(7, 50)).to_pylist() == library.decode(want[7:57])  # a slice's offsets don't begin at zero


def test_any_ids_decode_as_the_library_does(library):
    rng = random.Random(2)
    some = [*range(3, 270), *library.encode(" the of  and    x\n")]  # bytes and pieces with markers
    given = [[rng.choice(some) for _ in range(rng.randint(0, 12))] for _ in range(3000)] + [[1, 264], [1], [2, 2, 264, 264]]
    assert P.ChunkTable(FILE).decode(pa.array(given, pa.list_(pa.int32()))).to_pylist() == library.decode(given)


def test_each_distinct_chunk_is_segmented_once(monkeypatch):
    own, seen = P.ChunkTable(FILE), []
    work = own._ids.work
    own._ids.work = lambda chunks: seen.extend(chunks) or work(chunks)
    for _ in range(3):
        own.encode(pa.array(["one two one two", "two  one", "two"]))
    assert sorted(seen) == ["  one", " one", " two"]


def test_a_full_table_or_pieces_across_markers_change_nothing(monkeypatch, library, rows):
    given = texts(rows)[:400]
    want = library.encode(given, num_threads=1)
    monkeypatch.setattr(P, "KNOWN_CHUNKS", 10)
    own = P.ChunkTable(FILE)
    for at in range(0, 400, 20):
        got = own.encode(pa.array(given[at : at + 20]))
        assert got.to_pylist() == want[at : at + 20] and own.decode(got).to_pylist() == library.decode(want[at : at + 20])
    own.apart = False
    got = own.encode(pa.array(given))
    assert got.to_pylist() == want and own.decode(got).to_pylist() == library.decode(want)


def test_digests_of_all_documents(spark, docs, rows, library):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    got = [tuple(r) for r in P.round_trip_digests(docs, FILE).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert P.round_trip_digests(docs.where(F.lit(False)), FILE).isEmpty()
    both = P.decode(P.encode(docs, FILE), FILE).collect()
    assert sorted((str(r.doc_id), r.text) for r in both) == sorted((str(i), t or "") for i, t, _ in rows)


def test_the_query(spark, library):
    folder = "/root/testdata/sf0.001"
    want = {r.doc_id: library.encode(r.text or "") for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = P.op11_sentencepiece(spark, folder).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.n_tokens == len(want[r.doc_id]) and r.ids_sha256 == hashlib.sha256(",".join(map(str, want[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(want[r.doc_id]).encode()).hexdigest()
