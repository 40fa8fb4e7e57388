import gzip
import hashlib
import random

from pyspark.sql import functions as F

from cadenza.llm import warc as W

A, B = "<p>" + "a" * 200, "<p>" + "b" * 200
PAGES = [(1, "http://a/1", A), (2, "http://a/2\r\nX: y", A), (3, None, B), (4, "u", None), (5, "u", ""), (6, "u", "short"), (7, "u", "short"), (8, "u", "é" * 60), (9, "u", "é" * 60), (3, "again", B), (None, "u", A), (10, "u", "x" * (17 << 20)), (11, "u", "WARC/1.1\r\n\x1f\x8b\x08\r\n\r\n" * 9)]


def pages(spark):
    return spark.createDataFrame([(*p, 1, "x", "y") for p in PAGES], "page_id long, url string, html string, first long, digest string, payload string")


def test_round_trip(spark):
    path = W.work_folder(spark, "warc")
    W.write_warc(pages(spark), path)
    got = W.read_warc(spark, path).collect()
    payload = lambda h: (h or "").encode()
    least = {}
    for i, _, h in PAGES:
        if i is not None and len(payload(h)) >= 100:
            least[h] = min(i, least.get(h, i))
    want = sorted((i or 0, len(payload(h)), hashlib.sha256(payload(h)).hexdigest(), "revisit" if least.get(h, i) != i else "response", least[h] if h in least and least[h] != i else None) for i, _, h in PAGES)
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(hashlib.sha256(r.payload).hexdigest() == r.payload_digest for r in got if r.record_type == "response")
    assert W.read_gaps(spark, path).isEmpty()
    for f in spark.read.format("binaryFile").load(path).where(F.col("length") < 1 << 20).collect():
        assert gzip.decompress(f.content).count(b"WARC/1.1\r\nWARC-Type") >= (len(f.content) > 0)  # a common reader takes them too


def test_salvage():
    payloads = [f"<p>{i} {'z' * 300}".encode() for i in range(6)]
    plain = [W.record(i, "u", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]
    members = [gzip.compress(r) for r in plain]
    rng = random.Random(1)
    for parts in (members, plain):
        data, starts = b"".join(parts), [sum(map(len, parts[:i])) for i in range(len(parts) + 1)]
        whole = list(W.salvage(data))
        assert [block for *_, block in whole] == payloads
        for _ in range(40):
            at = rng.randrange(len(data))
            hit = max(i for i in range(len(parts)) if starts[i] <= at)
            damaged = data[:at] + bytes([data[at] ^ (1 << rng.randrange(8))]) + data[at + 1 :]
            items = list(W.salvage(damaged))
            blocks = [b for _, _, h, b in items if not isinstance(h, str)]
            assert all(p in blocks for i, p in enumerate(payloads) if i != hit), (at, hit)
            assert sum(n for _, n, _, _ in items) == len(data)
        cut = list(W.salvage(data[: starts[3] + 20]))
        assert [b for _, _, h, b in cut if not isinstance(h, str)] == payloads[:3] and isinstance(cut[-1][2], str)
    junk = b"junk" + members[0] + b"more" + members[1]
    assert [(at, n) for at, n, h, _ in W.salvage(junk) if isinstance(h, str)] == [(0, 4), (4 + len(members[0]), 4)]


def plain_records(n, size=3000):
    rng = random.Random(3)
    payloads = [f"<p>{i} {rng.randbytes(size).hex()}".encode() for i in range(n)]
    return payloads, [W.record(i, "u", p, hashlib.sha256(p).hexdigest(), None) for i, p in enumerate(payloads)]


def blocks_of(items):
    return [b for _, _, h, b in items if not isinstance(h, str)]


def test_members_with_several_records():
    payloads, plain = plain_records(6)
    one = gzip.compress(b"".join(plain[:4]))
    items = list(W.salvage(one + gzip.compress(plain[4]) + plain[5]))
    assert blocks_of(items) == payloads and not any(isinstance(h, str) for _, _, h, _ in items)
    # a record damaged before it was packed: the others stay, and its bytes are a gap
    bad = bytearray(plain[1])
    bad[len(bad) // 2] ^= 1
    items = list(W.salvage(gzip.compress(plain[0] + bytes(bad) + plain[2]) + gzip.compress(plain[3])))
    assert blocks_of(items) == [payloads[0], payloads[2], payloads[3]]
    assert [(n, h) for _, n, h, _ in items if isinstance(h, str)] == [(len(bad), "the record is damaged")]
    # a member damaged in its middle, or cut off: what was unpacked before stays, the rest is a gap, later members are read
    for broken in (one[: len(one) // 2] + b"\0" * 50 + one[len(one) // 2 + 50 :], one[: len(one) // 2]):
        items = list(W.salvage(broken + gzip.compress(plain[4])))
        assert blocks_of(items)[0] == payloads[0] and blocks_of(items)[-1] == payloads[4]
        assert any(isinstance(h, str) for _, _, h, _ in items)


def test_a_wrong_payload_digest_is_damage():
    payload = b"x" * 200
    items = list(W.salvage(W.record(1, "u", payload, hashlib.sha256(payload).hexdigest(), None).replace(b"WARC-Payload-Digest: sha256:", b"WARC-Payload-Digest: sha256:0")))
    assert not blocks_of(items)


def test_plain_records_take_linear_time():
    payloads, plain = plain_records(4000, 100)
    assert blocks_of(W.salvage(b"".join(plain) + b"WARC/1.1 " * 2000)) == payloads


def test_no_pages(spark):
    path = W.work_folder(spark, "warc")
    W.write_warc(pages(spark).limit(0), path)
    assert W.read_warc(spark, path).isEmpty()
