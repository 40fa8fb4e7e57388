import random
import re

import xxhash

from cadenza.llm import components as C
from cadenza.llm import simhash as S


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]).encode(), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {n: find(n) for n in nodes}


def test_fingerprints(rows):
    for _, t, _ in rows:
        assert S.fingerprint(t) == brute_fingerprint(t)


def test_links_equal_brute_force(spark):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(40)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for c in centres for _ in range(8)} | {0, 1, (1 << 64) - 1}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    got = {tuple(r) for r in S.links(spark.createDataFrame([(signed(x),) for x in fps], "fp long")).collect()}
    want = {tuple(sorted((signed(a), signed(b)))) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 3}
    assert got == want


def test_components(spark):
    rng = random.Random(3)
    for edges in ([], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [(rng.randrange(80), rng.randrange(80)) for _ in range(60)]):
        got = {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        want = {n: r for n, r in groups({x for e in edges for x in e}, edges).items() if n != r}
        assert got == want


def test_documents(spark, docs, rows):
    got = S.simhash_components(docs).collect()
    assert len(got) == len(rows)
    fps = {i: brute_fingerprint(t) for i, t, _ in rows if i is not None}
    want = groups(sorted(fps), [(a, b) for a in fps for b in fps if a < b and (fps[a] ^ fps[b]).bit_count() <= 3])
    assert all(r.component_id == want[r.doc_id] for r in got if r.doc_id is not None)
    kept = S.one_of_each(docs)
    # the documents without an id have one row in a component of their own and one among the empty texts
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, *sorted(set(want.values()))] and kept.columns == docs.columns
    assert S.simhash_components(docs.limit(0)).isEmpty()
