import hashlib
import random
import zlib

import duckdb
import pytest

from cadenza.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n string, fa string, chunk string, h string, first string, start string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", "n", "f", "c", "h", "f", "s") for r in rows], SCHEMA)


def brute(rows):
    """The rows of op13, from rebuilt texts."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in convs.items()}
    nodes = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        all_ = tuple(own.get(c - c % 5, [])[:h] + ts[h:])
        for d in range(len(all_) + 1):
            nodes.setdefault(all_[:d], []).append((c, d == len(all_)))
    kids = {}
    for p in nodes:
        if p:
            kids[p[:-1]] = kids.get(p[:-1], 0) + 1
    leaves, saved = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c, e in sorted(members) if e)
        parent = min(nodes[p[:-1]])[0] if p else None
        out.append((min(members)[0], len(p), parent, len(members), kids.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def found(spark, rows):
    return sorted((tuple(r) for r in T.prefix_trie(frame(spark, rows)).select(*COLUMNS).collect()), key=str)


def talk(seed, convs, words=3, turns=14):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        for t in range(rng.randint(1, turns)):
            rows.append((c, t, rng.choice(["user", "assistant"][t % 2 : t % 2 + 1]), "é" * rng.randrange(words)))
    return rows


def test_nodes_are_those_of_brute_force(spark):
    rows = talk(1, [*range(60), 10**12, 10**12 + 3])
    rows += [(70, None, None, None), (70, 0, "user", None), (71, 1, None, ""), (72, 0, "user", "x" * 100_000), (73, 3, "a", "b"), (73, 3, "a", "b"), (73, 3, "0", "b")]
    rows += [(None, 0, "user", "none's"), *((c, t, "user", "é") for c in range(100, 160) for t in range(9))]  # copies
    random.Random(2).shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_a_conversation_over_many_chunks(spark, monkeypatch):
    rows = talk(3, range(10)) + [(5, t, "user", "é" * (t % 3)) for t in range(20, 300)] + [(6, t, "user", "é" * (t % 3)) for t in range(20, 150)]
    for n in (1, 40):
        monkeypatch.setattr(T, "TURNS_PER_CHUNK", -(-len(rows) // n))
        assert found(spark, rows) == brute(rows)


def test_hot_parents_and_empty_tables(spark, monkeypatch):
    rows = [(c, t, "user", f"{c}" if t else "hi") for c in range(0, 300, 5) for t in range(2)]
    for hot in (1, 10, 10_000):
        monkeypatch.setattr(T, "HOT", hot)
        assert found(spark, rows) == brute(rows)
    monkeypatch.setattr(T, "IDS_PER_RUN", 3)
    same = [(c, 0, "user", "hi") for c in range(0, 200, 5)] + [(c, 0, "user", "") for c in range(0, 200, 7) if c % 5]
    assert found(spark, same) == brute(same)
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []


def test_products_compose():
    rng, base = random.Random(4), T.bases(0)[0]
    xs = [rng.randrange(-(2**63), 2**63) for _ in range(9)]
    for i in range(10):
        assert T.composed((i, T.product(xs[:i], base)), (9 - i, T.product(xs[i:], base)), base) == (9, T.product(xs, base))


def test_collisions_are_seen_and_done_again(spark, monkeypatch):
    """With a tiny prime most products collide; the checks must throw these nodes away."""
    rows, seeds, real = talk(5, range(40), words=9), [], T.bases
    monkeypatch.setattr(T, "PRIME", 7)
    monkeypatch.setattr(T, "bases", lambda seed: (3, 5))
    occ = T.occurrences(*(lambda p: (p, T.placed(p, 0)))(T.pieces(T.stored_turns(frame(spark, rows), 0), 0)), 0)
    assert not T.grouped(occ).where("not agrees").isEmpty()
    monkeypatch.undo()
    hold = T.references_hold
    monkeypatch.setattr(T, "references_hold", lambda turns: seeds.append(1) or (len(seeds) > 2 and hold(turns)))
    monkeypatch.setattr(T, "bases", lambda seed: real(seed))
    assert found(spark, rows) == brute(rows) and len(seeds) == 3


def test_references_to_different_texts_are_seen(spark):
    rows = spark.createDataFrame([("user", "a", 1, 2), ("user", "a", 1, 2), ("user", "b", 1, 3)], "role string, text string, ta long, tb long")
    assert T.references_hold(rows)
    assert not T.references_hold(rows.selectExpr("role", "text", "ta", "2L tb"))


def test_the_query_and_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = brute(rows)
    assert sorted((tuple(r) for r in T.op13_prefix_trie(spark, folder).select(*COLUMNS).collect()), key=str) == want
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    assert sorted(con.sql(f"select {', '.join(COLUMNS)} from ({T.OP13_SQL})").fetchall(), key=str) == want
