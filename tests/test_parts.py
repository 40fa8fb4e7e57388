"""Merges that read the parts their keys are in."""

from pyspark.sql import functions as F

from cadenza.operators.parts import RangedTable


def frame(spark, rows):
    return spark.createDataFrame(rows, "k long, v string")


def content(table):
    rows = table.read().collect()
    assert len(rows) == len({r.k for r in rows})
    return {r.k: r.v for r in rows}


def test_a_merge_reads_the_parts_it_hits(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"), ["k"], 500)
    old = {k: f"old{k}" for k in range(0, 20_000, 2)}
    first = table.upsert(frame(spark, list(old.items())))
    assert first.read == set() and 18 <= len(first.written) <= 24
    # two neighbouring rows and one far off: two or three of some twenty parts
    change = table.upsert(frame(spark, [(4000, "a"), (4002, "a"), (15000, "a")]))
    assert 2 <= len(change.read) <= 3
    files = table.read(change.before, change.read).inputFiles()
    assert len(files) == len(change.read) and len(table.read(change.before).inputFiles()) == len(first.written)
    kept = set(change.before.buckets) - change.read
    assert all(change.after.buckets[p] == change.before.buckets[p] for p in kept)
    assert content(table) == old | {4000: "a", 4002: "a", 15000: "a"}
    # keys that are new, among old ones: ranges hold them, filters don't
    new = {k: "new" for k in range(101, 20_000, 2000)}
    change = table.upsert(frame(spark, list(new.items())))
    assert len(change.read) <= 2 and content(table) == old | {4000: "a", 4002: "a", 15000: "a"} | new
    # beyond all ranges
    assert table.upsert(frame(spark, [(50_000, "end"), (-5, "start")])).read == set()
    small = {p for p, (_, n) in table.snapshot().buckets.items() if n < 250}
    change = table.compact()
    assert change.read == small and content(table) == old | {4000: "a", 4002: "a", 15000: "a"} | new | {50_000: "end", -5: "start"}
    assert table.upsert(frame(spark, [])) is None


def test_no_part_with_a_key_is_missed(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"), ["a", "b"], 100)
    rows = spark.range(2000).select(F.sha1(F.col("id").cast("string")).alias("a"), (F.col("id") % 7).alias("b"), F.lit(0).alias("v"))
    table.upsert(rows)
    at = table.snapshot()
    assert table.hit(rows, at) == set(at.buckets)
    some = rows.where("b = 3")
    table.upsert(some.withColumn("v", F.lit(1)).unionByName(some.withColumn("v", F.lit(2))))  # of equal keys the largest row
    got = table.read().groupBy("b").agg(F.count("*").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")).collect()
    assert sum(r.n for r in got) == 2000 and all(r.least == r.most == (2 if r.b == 3 else 0) for r in got)


def test_two_writers_of_the_same_new_key_leave_one_row(spark, tmp_path):
    one, two = (RangedTable(spark, str(tmp_path / "t"), ["k"], 500) for _ in range(2))
    commit, done = one._commit, []

    def late(new):
        if not done:
            done.append(two.upsert(frame(spark, [(1, "theirs"), (2, "theirs")])))
        return commit(new)

    one._commit = late
    change = one.upsert(frame(spark, [(1, "ours"), (3, "ours")]))
    assert change.read == done[0].written and content(two) == {1: "ours", 2: "theirs", 3: "ours"}


def test_filters_lie_in_few_files_however_many_the_parts(spark, tmp_path, monkeypatch):
    table = RangedTable(spark, str(tmp_path / "t"), ["k"], 50)
    change = table.upsert(spark.range(0, 2000, 2).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    assert len(change.written) >= 18 and len(list(tmp_path.glob("t/_filters/**/*.parquet"))) <= 4  # the tests' number of tasks
    keys = frame(spark, [(100, "a"), (1500, "a")])
    few = table.hit(keys, table.snapshot())
    monkeypatch.setattr("cadenza.operators.parts.FEW", 0)
    assert table.hit(keys, table.snapshot()) == few and 2 <= len(few) <= 3


def test_null_keys_are_equal(spark, tmp_path):
    table = RangedTable(spark, str(tmp_path / "t"), ["a", "b"], 500)
    rows = lambda v: spark.createDataFrame([(None, None, v), (1, None, v), (None, "x", v), (1, "x", v)], "a int, b string, v string")
    table.upsert(rows("old"))
    table.upsert(rows("new").where("b is null"))
    assert sorted((str(r.a), str(r.b), r.v) for r in table.read().collect()) == [("1", "None", "new"), ("1", "x", "old"), ("None", "None", "new"), ("None", "x", "old")]
