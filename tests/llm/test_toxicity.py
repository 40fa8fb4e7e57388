import random
import zlib

from pyspark.sql import functions as F

from cadenza.llm import toxicity as T

INSULTS = ("blorgtor", "blorgwim", "fnazzle", "quibbox")


def corpus(n=900, seed=4):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("aeioustrn", k=rng.randint(3, 8)))
    out, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 80))]
        toxic = i % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        out.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    return out, labels


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus()
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in T.toxicity(d, l).withColumn("held", T.held_out(F.col("doc_id"))).collect()}
    truth = dict(labels)
    assert all(r.held == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(r.toxicity >= T.CUT, truth[i]) for i, r in got.items() if r.held]
    assert sum(p == bool(y) for p, y in held) / len(held) > 0.98
    assert all(0 <= r.toxicity <= 1 for r in got.values())
    # labels that are held out change nothing
    flipped = spark.createDataFrame([(i, 1 - y if got[i].held else y) for i, y in labels], "doc_id long, toxic int")
    assert {r.doc_id: r.toxicity for r in T.toxicity(d, flipped).collect()} == {i: r.toxicity for i, r in got.items()}
    kept = {r.doc_id for r in T.without_toxic(d, l).collect()}
    assert kept == {i for i, r in got.items() if r.toxicity < T.CUT}


def test_clauses():
    g = T.Grammar({"fool$": 4.0})
    plain = g.score("such a fool here.")
    assert plain == 4.0
    assert g.score("not a fool here.") < plain < g.score("you are a fool here.")
    assert g.score("he said: fool.") == plain  # the clause ends before it
    assert g.score("the paper said a fool came.") < plain
    assert g.score("i will kill you.") == 0.0 < g.score("you, beware. you i will kill.")
    assert g.score("fool") + g.score("fool.") == g.score("fool. fool.")
    assert g.score(None) == g.score("") == 0.0


def test_edges(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for labels in (none, spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, toxic int")):
        got = T.toxicity(docs, labels)
        assert got.columns == [*docs.columns, "_toxicity"] and got.count() == docs.count()
        assert got.where("_toxicity is null").isEmpty()
    assert T.toxicity(docs.limit(0), none).isEmpty()
