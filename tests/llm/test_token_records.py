import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import token_records as R
from cadenza.llm.common import slices

public = pytest.importorskip("public_tokenizers")
FILE = public.path("byte_bpe_50k.json")


def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    return t


def test_chunks_have_the_library_s_ids(rows):
    rng = random.Random(1)
    pieces = ["a", "B", " ", "  ", "\n", "\t", "'s", "'ll", "é", "ß", "1", "23", ".", ",", "!", "<|endoftext|>", "\x1c", "\x85", "　", "漢", "😀", " the", "\r\n", "ʼ", "_", "-"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(3000)] + [t or "" for _, t, _ in rows]
    want = [e.ids for e in library().encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, "<u2").tolist() for b in R.ChunkEncoder(FILE).encode(pa.array(texts))] == want


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(R, "CACHED_CHUNKS", 5)
    encoder, rng = R.ChunkEncoder(FILE), random.Random(2)
    for _ in range(20):
        texts = [" ".join(f"w{rng.randrange(30)}" + rng.choice(["", ",", "\n", "é."]) for _ in range(20)) for _ in range(3)] + [None, "a\0b", " a"]
        want = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [np.frombuffer(b, "<u2").tolist() for b in encoder.encode(pa.array(texts))] == want


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (5, 1, 1, 90, 0, 3)] + [None]})
    got = list(slices(batch, "text", 7))
    assert [b.num_rows for b in got] == [3, 1, 3] and pa.Table.from_batches(got).equals(pa.Table.from_batches([batch]))


def test_a_worker_s_memory_stays_small():
    rng = random.Random(4)
    words = [f"w{i}" for i in range(5000)]
    texts = [" ".join(rng.choices(words, k=400)) for _ in range(5000)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    list(R.encoded(iter([batch.slice(0, 10)]), FILE, 2))
    tracemalloc.start()
    n = sum(b.num_rows for b in R.encoded(iter([batch]), FILE, 2))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert batch.nbytes > 10 << 20 and n == len(texts) and most < 40 << 20


def test_reading_takes_no_copy():
    data = b"".join(R.frame(i, b"\1\0\2\0", 2) + b"\n" for i in range(3))
    assert [(at, d, ids.tolist()) for at, _, d, ids in R.frames(memoryview(data))] == [(at, d, ids.tolist()) for at, _, d, ids in R.frames(data)]
    (_, _, _, ids), *_ = R.frames(memoryview(data))
    assert np.shares_memory(ids, np.frombuffer(data, np.uint8))


def test_files_hold_all_documents_in_order(spark, docs, rows):
    path = R.work_folder(spark, "tokens")
    R.write_token_records(docs, path, FILE, 2, bytes_per_file=100_000)
    R.write_index(spark, path)
    index = R.read_index(spark, path).orderBy("file", "ordinal").collect()
    order = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).orderBy("doc_id", F.xxhash64("text"), "text").collect()
    want = [[*e.ids, 2] for e in library().encode_batch([t for _, t in order], add_special_tokens=False)]
    assert [r.doc_id for r in index] == [i for i, _ in order] and len({r.file for r in index}) > 1
    assert [r.n_tokens for r in index] == [len(w) for w in want]
    assert [r.start for r in index] == [sum(map(len, want[:i])) for i in range(len(want))]
    assert [r.ids_crc32 for r in index] == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]
    read = R.read_tokens(spark, path).orderBy("file", "ordinal").collect()
    assert [r.ids for r in read] == want
    one, two = ([(r.doc_id, r.ids) for r in R.read_shuffled(spark, path, s).collect()] for s in (1, 2))
    assert one != two and all(sorted(x, key=str) == sorted(zip([r.doc_id for r in index], want), key=str) for x in (one, two))
    some = [r for r in index if r.n_tokens > 50]
    wanted = spark.createDataFrame([(r.start, r.file, r.offset, r.length) for r in some], "place long, file int, offset long, length long")
    assert {r.place: (r.doc_id, len(r.ids)) for r in R.read_at(spark, path, wanted).collect()} == {r.start: (r.doc_id, r.n_tokens) for r in some}
    assert R.read_at(spark, path, wanted.where("place < 0")).isEmpty()


def test_damage_is_an_error():
    data = R.frame(5, b"\1\0\2\0", 2) + b"\n"
    assert [(d, ids.tolist()) for _, _, d, ids in R.frames(data)] == [(5, [1, 2])]
    for at in range(len(data) - 1):
        with pytest.raises(Exception):
            list(R.frames(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :]))


def test_no_documents(spark, docs):
    assert R.token_records(docs.where(F.lit(False)), FILE, 2).isEmpty()
