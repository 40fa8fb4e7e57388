import hashlib
import random
import re

from cadenza.llm import substring_dedup as S

from .conftest import prose


def brute(rows):
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        if i is not None:
            for k in range(len(w) - 12):
                g = tuple(w[k : k + 13])
                first[g] = min(i, first.get(g, i))
    out = []
    for i, w in texts:
        gone = {k + j for k in range(len(w) - 12) for j in range(13) if i is not None and first[tuple(w[k : k + 13])] < i}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i or 0, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def test_equals_brute_force(spark, docs, rows):
    rng = random.Random(1)
    parts = [prose(500 + i, rng.randint(10, 30), 50) for i in range(12)]
    more = [(100 + i, " ".join(rng.choices(parts, k=rng.randint(1, 6)))) for i in range(40)] + [(200, "x " * 60), (201, "x " * 13), (202, "x " * 12)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = S.parse(df, texts=True).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in got) == brute([(i, t) for i, t, _ in rows] + more)
    for r in got:
        assert all(f.words >= S.WINDOW and f.reference < r.doc_id for f in r.factors)
        assert len({k for f in r.factors for k in range(f.start, f.start + f.words)}) == r.n_removed
    # a factor is one passage of its reference, at the given position
    words = {i: (t or "").split() for i, t in [*((i, t) for i, t, _ in rows), *more]}
    for r in got:
        for f in r.factors:
            assert words[r.doc_id][f.start : f.start + f.words] == words[f.reference][f.position : f.position + f.words]


def test_the_parse_is_greedy_and_ends_where_the_reference_does(spark):
    a, b = prose(1, 30).split(), prose(2, 30).split()
    docs = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a[5:25] + ["new"] + b[:20] + a[10:]))]
    got = {r.doc_id: [tuple(f) for f in r.factors] for r in S.parse(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {1: [], 2: [], 3: [(0, 20, 1, 5), (21, 20, 2, 0), (41, 20, 1, 10)]}


def test_a_full_table_of_anchors_loses_nothing(spark, docs, rows, monkeypatch):
    monkeypatch.setattr(S, "SKETCH_BITS", 7)
    monkeypatch.setattr(S, "DOCUMENT_BITS", 7)
    monkeypatch.setattr(S, "PACKED_BITS", 0)
    got = S.parse(docs).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in got) == [x[:4] for x in brute([(i, t) for i, t, _ in rows])]


def test_anchors_are_a_matter_of_the_window_alone():
    a, b = prose(1, 40), prose(2, 30)
    h, g = S.Hashed(a), S.Hashed(b + " " + a + " " + b)
    assert (h.windows() == g.windows()[30:58]).all() and (h.anchors() == g.anchors()[30:58]).all()


def test_no_documents(spark, docs):
    assert S.parse(docs.limit(0)).isEmpty()
