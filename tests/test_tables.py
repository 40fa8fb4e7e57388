"""The commit protocol and growing buckets."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from cadenza.operators import tables as T


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def content(table):
    return {r.k: r.v for r in table.read().collect()}


def meets(table, other):
    """``table`` with another write between its work and its pointer."""
    commit, done = table._commit, []

    def late(new):
        if not done:
            done.append(1)
            other()
        return commit(new)

    table._commit = late
    return table


def test_two_writers_of_one_number_both_count(spark, tmp_path):
    root = str(tmp_path / "t")
    first, second = (T.KeyedTable(spark, root, ["k"], 10_000) for _ in range(2))
    meets(first, lambda: second.upsert(frame(spark, [(2, "b"), (3, "b")])))
    change = first.upsert(frame(spark, [(1, "a"), (2, "a")]))
    assert content(second) == {1: "a", 2: "a", 3: "b"} and (change.before.seq, change.after.seq) == (0, 1)


def test_writers_of_other_buckets_only_point_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    big = [(k, f"{random.Random(k).random()}") for k in range(2000)]
    T.KeyedTable(spark, root, ["k"], 4000).upsert(frame(spark, big))
    table = T.KeyedTable(spark, root, ["k"], 4000)
    place = {r.k: r._bucket for r in table.placed(frame(spark, big), set(table.snapshot().buckets)).collect()}
    far = next(k for k in place if place[k] != place[0])
    writes, write = [], table._write
    table._write = lambda *a: writes.append(1) or write(*a)
    meets(table, lambda: T.KeyedTable(spark, root, ["k"], 4000).upsert(frame(spark, [(far, "theirs")])))
    table.upsert(frame(spark, [(0, "ours")]))
    assert len(writes) == 1 and content(table) == {**dict(big), 0: "ours", far: "theirs"} and table.snapshot().seq == 2
    # the same bucket: the work is done again on what the other left
    table, writes = T.KeyedTable(spark, root, ["k"], 4000), []
    write = table._write
    table._write = lambda *a: writes.append(1) or write(*a)
    near = next(k for k in place if k and place[k] == place[0])
    meets(table, lambda: T.KeyedTable(spark, root, ["k"], 4000).upsert(frame(spark, [(near, "theirs")])))
    table.upsert(frame(spark, [(0, "again")]))
    assert len(writes) == 2 and content(table) == {**dict(big), 0: "again", far: "theirs", near: "theirs"}


def test_many_writers_at_once_lose_nothing(spark, tmp_path):
    root, failed = str(tmp_path / "t"), []

    def work(i):
        try:
            T.KeyedTable(spark, root, ["k"], 10_000).upsert(frame(spark, [(i, str(i)), (100, str(i))]))
        except Exception as e:
            failed.append(e)

    threads = [threading.Thread(target=work, args=(i,)) for i in range(5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    got = content(T.KeyedTable(spark, root, ["k"]))
    assert not failed and got.pop(100) in "01234" and got == {i: str(i) for i in range(5)}
    assert T.snapshot(spark, root).seq == 4


def test_a_pointer_is_created_once(spark, tmp_path):
    one, two = T.Snapshot(0, "a", None, "{}"), T.Snapshot(0, "b", None, "{}")
    assert T.commit(spark, str(tmp_path), one) and not T.commit(spark, str(tmp_path), two)
    assert T.snapshot(spark, str(tmp_path)).version == "a" and len(list((tmp_path / "_pointers").glob("*.json"))) == 1


def test_a_replacement_keeps_what_others_publish(spark, tmp_path):
    root = str(tmp_path / "t")
    T.publish(spark, frame(spark, [(1, "a")]), root, "0")
    base, met = T.snapshot(spark, root), []

    def change(table):
        if not met:  # another writer comes first
            met.append(1)
            T.replace(spark, root, lambda t: t.unionByName(frame(spark, [(2, "b")])))
        return table.unionByName(frame(spark, [(3, "c")]))

    T.replace(spark, root, change)
    assert sorted(r.k for r in T.published(spark, root).collect()) == [1, 2, 3]
    with pytest.raises(T.Conflict):
        T.publish(spark, frame(spark, []), root, "late", base)


def test_buckets_split_as_the_table_grows(spark, tmp_path):
    table = T.KeyedTable(spark, str(tmp_path / "t"), ["k"], 20_000)
    sizes = []
    for n in (200, 2_000, 20_000):
        table.upsert(spark.range(n).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")))
        buckets = table.snapshot().buckets
        sizes.append(len(buckets))
        assert max(b for _, b in buckets.values()) <= 40_000 and table.read().count() == n
        names = sorted(b[1:] for b in buckets)  # every key has one bucket
        assert sum(2.0 ** -len(b) for b in names) == 1 and not any(b.startswith(a) for a, b in zip(names, names[1:]) if a != b)
    assert sizes[0] < sizes[1] < sizes[2] and sizes[2] >= 50
    assert table.upsert(frame(spark, [])) is None


def test_keys_of_several_columns_and_nulls(spark, tmp_path):
    table = T.KeyedTable(spark, str(tmp_path / "t"), ["a", "b"], 600)
    rows = [(a, b, f"{a}{b}") for a in (None, 1, 2, 3, 4, 5) for b in (None, "x", "y", "z")]
    table.upsert(spark.createDataFrame(rows, "a int, b string, v string"))
    table.upsert(spark.createDataFrame([(None, None, "new"), (9, "x", "new")], "a int, b string, v string"))
    held = table.read().collect()
    got = {(r.a, r.b): r.v for r in held}
    assert len(held) == len(got)  # null keys are equal too
    assert got == {(a, b): v for a, b, v in rows} | {(None, None): "new", (9, "x"): "new"}
