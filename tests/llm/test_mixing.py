import re

from cadenza.llm import mixing as M

from .conftest import NAMES


def brute_targets(sizes):
    """By the rule as told: share by weight, stop at three times the size, deal out the rest again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: M.WEIGHTS[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), float(sum(sizes.values())), set(order)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s, more in share.items():
            target[s] += more
            if target[s] > 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = 3.0 * sizes[s]
        open_ = {s for s in open_ if target[s] < 3 * sizes[s] - 1e-9}
    return target


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 70}, {"a": 0, "b": 4}, {"x": 7}, {"a": 1, "b": 1, "c": 1, "d": 90, "e": 400, "\U0001f600": 3, "￿": 2}):
        got = {r.source: r.target for r in M.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want), (got, want)


def test_permutations(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 64, 1000):
        seen = [[r[0] for r in spark.range(n).orderBy("id").select(M.permuted(F.col("id"), F.lit(n), F.lit(k))).collect()] for k in (1, 2)]
        assert all(sorted(s) == list(range(n)) for s in seen)
        assert n < 64 or seen[0] != seen[1]


def test_the_mix(spark, docs, rows):
    got = M.mix(docs, block=16).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r.doc_id or 0, r.size) for r in got) == sorted((i or 0, size(t)) for i, t, _ in rows)
    totals = {}
    for _, t, s in rows:
        totals[s] = totals.get(s, 0) + size(t)
    want = brute_targets(totals)
    for s in totals:
        of = [r for r in got if r.source == s]
        assert {r.source_size for r in of} == {totals[s]} and all(abs(r.target - want[s]) < 1e-6 for r in of)
        assert abs(sum(r.taken for r in of) - want[s]) <= 3 * 16
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    again = M.mix(docs.repartition(3), block=16).collect()
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.size, r.taken)
    assert sorted(again, key=key) == sorted(got, key=key)


def test_the_mix_as_documents(spark, docs):
    whole = docs.dropDuplicates(["doc_id"]).where("doc_id is not null")
    taken = {r.doc_id: r.taken for r in M.mix(whole, block=16).collect()}
    mixed = M.mixed_documents(whole, block=16)
    assert mixed.columns == docs.columns
    words, texts = {}, {r.doc_id: r.text for r in whole.collect()}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        assert r.n_chars == len(r.text) and (r.text == texts[r.doc_id] or len(r.text) <= len(texts[r.doc_id]))
    assert words == {i: n for i, n in taken.items() if n}


def test_no_documents(spark, docs):
    none = docs.limit(0)
    assert M.mix(none).isEmpty() and M.mixed_documents(none).isEmpty()


def test_the_mix_as_documents_keeps_rows_with_equal_ids_apart(spark, docs):
    more = spark.createDataFrame([(i, f"{'x' if i else 'n'}{k} " * (30 + k), "en", "a", 0, 1, 2, 3, "4", "5", 6, 0.5, 7, "8", *NAMES) for i in (None, 2) for k in range(12)], docs.schema)
    rows = docs.unionByName(more)
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    by_source = {}
    for r in M.mix(rows, block=16).collect():
        by_source.setdefault(r.source, []).append((r.taken, r.size))
    mixed, texts = M.mixed_documents(rows, block=16).collect(), [r.text for r in rows.collect() if r.text]
    for source, of in by_source.items():
        assert sum(count(r.text) for r in mixed if r.source == source) == sum(t for t, _ in of)
    # each word of the added rows comes as often as its row was taken, three times at most
    for name in (f"{c}{k}" for c in "xn" for k in range(12)):
        times = sum(r.text.split().count(name) for r in mixed)
        size = sum(t.split().count(name) for t in texts)
        assert times <= 3 * size and any((times, size) == pair for pair in by_source["a"])


def test_the_draw(spark, monkeypatch):
    """Counts by source and shard: they add up to the quotas and the shards' sizes, and vary as a draw without replacement does."""
    monkeypatch.setattr(M, "SLOTS_PER_SHARD", 64)
    sources = spark.createDataFrame([("a", 64_000, 64_000.0), ("b", 16_000, 40_000.0), (None, 640, 1280.0)], "source string, source_size long, target double")
    quota = {r.source: r.quota for r in M.quotas(sources).collect()}
    assert quota == {"a": 1000, "b": 625, None: 20}
    drawn = M.draws(M.quotas(sources)).collect()
    shards = -(-sum(quota.values()) // 64)
    for s, n in quota.items():
        assert sum(r.slots for r in drawn if r.source == s) == n
    sizes = [sum(r.slots for r in drawn if r.shard == k) for k in range(shards)]
    assert sizes == [64] * (shards - 1) + [sum(quota.values()) - 64 * (shards - 1)]
    p, counts = 1000 / 1645, [r.slots for r in drawn if r.source == "a" and r.shard < shards - 1]
    variance = sum((c - 64 * p) ** 2 for c in counts) / len(counts)
    assert 0.3 < variance / (64 * p * (1 - p)) < 2.5
    # the slots are those of the draw: as many of each source and shard, each block of a pass once
    slots = M.draw(sources).collect()
    times = lambda rows, key: {k: sum(key(r) == k for r in rows) for k in {key(r) for r in rows}}
    assert times(slots, lambda r: (r.source, r.shard)) == {(r.source, r.shard): r.slots for r in drawn}
    assert max(times(slots, lambda r: (r.source, r["pass"], r["index"])).values()) == 1
    assert {(r.source, r["index"]) for r in slots if r.source == "a"} == {("a", i) for i in range(1000)}
    assert M.draws(M.quotas(sources), seed=1).collect() != drawn
