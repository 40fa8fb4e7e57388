import json

from cadenza.operators.tables import published, snapshot
from cadenza.streaming.ingest import ingest_stream


def test_landed_files_are_upserted_once(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    (tmp_path / "landing").mkdir()
    changed = []

    def land(name, *rows):
        (tmp_path / "landing" / name).write_text("\n".join(json.dumps(r) for r in rows))
        ingest_stream(spark, landing, "k int, v string", lambda d: d, root, ["k"], checkpoint, lambda ids, *_: changed.append(sorted(r.k for r in ids.collect())))

    land("1.json", {"k": 1, "v": "a"}, {"k": 2, "v": "b"})
    land("2.json", {"k": 2, "v": "c"}, {"k": 1, "v": "a"})
    assert {r.k: r.v for r in published(spark, root).collect()} == {1: "a", 2: "c"}
    assert changed == [[1, 2], [2]]


def test_a_batch_rewrites_only_the_buckets_of_its_keys(spark, tmp_path):
    landing, root, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    (tmp_path / "landing").mkdir()
    seen = []

    def land(name, rows):
        (tmp_path / "landing" / name).write_text("\n".join(json.dumps(r) for r in rows))
        note = lambda ids, before, now, n: seen.append((ids.count(), before.count(), now.count()))
        ingest_stream(spark, landing, "k int, v string", lambda d: d.where("v <> 'none'"), root, ["k"], checkpoint, note, bucket_bytes=1200)

    land("1.json", [{"k": k, "v": f"{k * 7919 % 1000003}" * 3} for k in range(400)])
    first = snapshot(spark, root)
    assert len(first.buckets) > 4 and max(n for _, n in first.buckets.values()) <= 2400
    land("2.json", [{"k": 7, "v": "b"}, {"k": 2000, "v": "b"}])
    land("3.json", [{"k": 1, "v": "none"}])
    assert {r.k: r.v for r in published(spark, root).collect()} == {**{k: f"{k * 7919 % 1000003}" * 3 for k in range(400)}, 7: "b", 2000: "b"}
    assert seen == [(400, 0, 400), (2, 400, 401)]
    last = snapshot(spark, root)
    assert last.seq == 1 and 1 <= sum(first.buckets.get(b) != v for b, v in last.buckets.items()) <= 4
