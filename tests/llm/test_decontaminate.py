import random

import numpy as np
import pyarrow as pa

from cadenza.llm import decontaminate as D

from .conftest import prose


def brute_edits(item, text):
    before = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        now = [i]
        for j, b in enumerate(text, 1):
            now.append(min(before[j] + 1, now[j - 1] + 1, before[j - 1] + (a != b)))
        before = now
    return min(before)


def test_least_edits():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randint(1, 4) for _ in range(rng.randint(low, 20))] for low in (1, 0))
        assert D.least_edits(len(a), D.masks_of(np.array(a)), np.array(b, np.int64)) == brute_edits(a, b)


ITEMS = [(i, prose(100 + i, 8 + 3 * i, 3000)) for i in range(15)] + [(20, "one two"), (21, "Alone"), (22, ""), (23, None), (24, "... !!")]


def test_recall_against_brute_force():
    rng, found, planted = random.Random(2), 0, 0
    detector = D.Detector(ITEMS)
    for n in range(300):
        i, text = rng.choice(ITEMS[:15])
        words = text.split()
        for _ in range(rng.randint(0, int(D.EDITS * len(words)))):
            at, kind = rng.randrange(len(words)), rng.random()
            if kind < 0.4:
                words[at] = f"new{rng.randrange(99)}"
            elif kind < 0.7:
                words.insert(at, f"new{rng.randrange(99)}")
            else:
                del words[at]
        host = prose(1000 + n, 60, 3000).split()
        at = rng.randrange(len(host))
        text = " ".join(host[:at] + [w.upper() + "," for w in words] + host[at:])
        got = {m[0]: m[1] for m in detector.matches(pa.array([text]))[0]}
        ids = [w for w in D.words_of(text)]
        want = {j: e for j, t in ITEMS if (w := D.words_of(t)) and (e := brute_edits(w, ids)) <= int(D.EDITS * len(w))}
        assert got.keys() <= want.keys()  # and no fewer edits than there are; a smaller window may cost more
        assert all(e >= want[j] for j, e in got.items())
        planted += len(want)
        found += len(want.keys() & got.keys())
    assert found >= 0.98 * planted and planted >= 300


def test_documents(spark, docs, rows):
    benchmark = spark.createDataFrame([(i, t, 1) for i, t in ITEMS] + [(99, rows[0][1], 1)], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id, r.edits) for r in D.contaminated(docs, benchmark).collect()}
    assert {(1, 99, 0), (2, 99, 0)} <= got
    kept = D.without_contaminated(docs, benchmark)
    assert kept.columns == docs.columns and not {1, 2} & {r.doc_id for r in kept.collect()} and {3, 4, 11, 12} <= {r.doc_id for r in kept.collect()}
    assert D.contaminated(docs.limit(0), benchmark).isEmpty()
    assert D.contaminated(docs, benchmark.limit(0)).isEmpty() and D.without_contaminated(docs, benchmark.limit(0)).count() == len(rows)


def edited(rng, words, how):
    """The most edits that still match: anywhere, or replacements spread as evenly as can be."""
    words, n = list(words), len(words)
    for j in range(int(D.EDITS * n)):
        if how == "even":
            words[(j + 1) * n // (int(D.EDITS * n) + 1)] = "zz"
            continue
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[at] = "zz"
        elif kind < 0.7:
            words.insert(at, "zz")
        else:
            del words[at]
    return words


def test_recall_by_length_and_kind_of_edits():
    rng = random.Random(7)
    for n in (1, 2, 3, 5, 6, 9, 15, 20, 40):
        items = [(i, prose(1000 * n + i, n, 3000)) for i in range(40)]
        detector = D.Detector(items)
        for how in ("even", "any"):
            texts = [prose(rng.random(), 50, 3000) + " " + " ".join(edited(rng, t.split(), how)) + " " + prose(rng.random(), 50, 3000) for _, t in items for _ in range(5)]
            got = detector.matches(pa.array(texts))
            assert sum(i // 5 in {m[0] for m in found} for i, found in enumerate(got)) >= 0.95 * len(texts), (n, how)


def test_the_tables_find_the_windows():
    detector = D.Detector(ITEMS)
    text = pa.array(["x " + ITEMS[5][1] + " y"])
    assert [m[0] for m in detector.matches(text)[0]] == [5]
    detector.tables = []
    assert detector.matches(text) == [[]]


def test_ids_stay_as_they_are(spark):
    item = prose(3, 20)
    docs = spark.createDataFrame([(None, item), (2**60 + 1, "a " + item)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, item), (2**60 + 3, item), (2**60 + 3, item), (4, None)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.edits, r.start) for r in D.contaminated(docs, benchmark).collect()), key=str)
    assert got == sorted([(d, i, 0, s) for d, s in ((None, 0), (2**60 + 1, 1)) for i in (None, 2**60 + 3, 2**60 + 3)], key=str)
    assert D.without_contaminated(docs, benchmark).isEmpty()


def test_groups_of_items(spark, docs, monkeypatch):
    benchmark = spark.createDataFrame(ITEMS + [(99, prose(2, 80))], "item_id long, text string")
    want = sorted(D.contaminated(docs, benchmark).collect())
    monkeypatch.setattr(D, "ITEMS", 3)
    assert want and sorted(D.contaminated(docs, benchmark).collect()) == want
