import random

from cadenza.llm import near_copies as N

from .conftest import prose


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in (a, b))]
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def replaced(rng, text, *places):
    words = text.split()
    for p in places:
        words[p] = f"new{rng.randrange(10**9)}"
    return " ".join(words)


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_near_copies_are_dropped_and_others_kept(spark):
    rng = random.Random(4)
    texts, want = [], []
    for k in range(150):
        text = prose(100 + k, 100, 10**6)
        near, far = replaced(rng, text, 50), replaced(rng, text, 20, 50, 80)  # 0.90 and 0.73
        assert jaccard(text, near) >= 0.8 > max(jaccard(text, far), jaccard(near, far))
        want += [len(texts), len(texts) + 2]
        texts += [text, near, far, text.upper()]
    kept = {r.doc_id for r in N.one_of_each(frame(spark, texts)).collect()}
    assert kept == set(want)


def test_a_group_larger_than_a_bucket_of_all_pairs(spark):
    rng = random.Random(5)
    text = prose(7, 100, 10**6)
    copies = [replaced(rng, text, rng.randrange(10, 90)) for _ in range(4 * N.ALL_PAIRS)]  # 0.90 to the text, 0.8 and more or less to each other
    kept = N.one_of_each(frame(spark, [*copies, text, prose(8, 100, 10**6)])).collect()
    assert sorted(r.doc_id for r in kept) == [0, len(copies) + 1]


def test_documents(spark, docs):
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    # 2 has one word more than 1, 4 and 5 have no words as 3, 9 is a text of its own, 12 is 11 again
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8, 9, 10, 11]
    assert N.one_of_each(docs.limit(0)).isEmpty()


def edited(seed, n, changes):
    """Copies of one text, each with its own words at a few places; the text itself is not among them."""
    rng = random.Random(seed)
    base = [f"b{seed}x{i}" for i in range(120)]
    out = []
    for c in range(n):
        words = list(base)
        for at in rng.sample(range(120), changes):
            words[at] = f"e{seed}c{c}p{at}"
        out.append(" ".join(words))
    return out


def kept_by_all_pairs(texts):
    """The smallest id of each group, from every pair."""
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return {min(i for i, g in enumerate(group) if g == k) for k in set(group)}


def test_large_buckets_give_the_groups_of_all_pairs(spark, monkeypatch):
    """Clusters without their original, tight and loose ones, and a chain; every bucket is closed in blocks."""
    texts = edited(1, 40, 1) + edited(2, 40, 2) + edited(3, 20, 5)
    words = [f"c{i}" for i in range(400)]
    texts += [" ".join(words[i * 8 : i * 8 + 120]) for i in range(30)]  # each is like its neighbours only
    want = kept_by_all_pairs(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {}
    for most in (10**9, 2):
        monkeypatch.setattr(N, "ALL_PAIRS", most)
        monkeypatch.setattr(N, "BLOCK", 16)
        kept[most] = {r.doc_id for r in N.one_of_each(docs).select("doc_id").collect()}
    assert len(set(map(frozenset, kept.values()))) == 1  # no pair that a bucket holds is lost in the blocks
    assert len(kept[2] ^ want) <= 1  # MinHash itself may miss a link, with a probability of 0.004 at 0.8


def test_blocks_join_what_is_similar():
    import numpy as np

    rng = random.Random(6)
    rows = [{"entry": i, "root": i // 3 * 3, "shingles": np.array(sorted(rng.sample(range(12), rng.randint(1, 12))), np.uint64).tobytes()} for i in range(40)]
    links = N.forest(rows[:15], rows)
    group = {r["entry"]: r["root"] for r in rows}
    want = dict(group)
    for out, pairs in ((group, links), (want, [(a["entry"], b["entry"]) for a in rows[:15] for b in rows if alike(a, b)])):
        for a, b in pairs:
            old, new = out[a], out[b]
            out.update({k: min(old, new) for k, v in out.items() if v in (old, new)})
    assert group == want and len(links) == len({r["root"] for r in rows}) - len(set(want.values()))
    assert N.forest([], rows) == [] and N.forest(rows[:1], []) == []


def alike(a, b):
    x, y = (set(memoryview(r["shingles"]).cast("Q")) for r in (a, b))
    return len(x & y) >= 0.8 * len(x | y)


def test_fingerprints_alone_find_candidates_that_are_verified(spark, monkeypatch):
    """MinHash finds nothing here: bands of a text are its own. What operator 4's search links is compared, and only what is similar goes."""
    from cadenza.llm.simhash import fingerprint_of, shingle_hashes

    from xxhash import xxh64_intdigest

    own = lambda hashes: [xxh64_intdigest(hashes.tobytes(), k) for k in range(N.BANDS)]
    monkeypatch.setattr(N, "bands", own)
    rng, texts, want = random.Random(8), [], set()
    for k in range(12):
        text = prose(300 + k, 400, 10**6)
        texts += [text, replaced(rng, text, 200)]
        a, b = (fingerprint_of(shingle_hashes(t, N.SHINGLE_WORDS)) for t in texts[-2:])
        want |= {2 * k} if (a ^ b).bit_count() <= 3 else {2 * k, 2 * k + 1}
    assert len(want) < len(texts)
    assert {r.doc_id for r in N.one_of_each(frame(spark, texts)).collect()} == want
    monkeypatch.setattr(N, "SIMILARITY", 1.0)
    assert N.one_of_each(frame(spark, texts)).count() == len(texts)
