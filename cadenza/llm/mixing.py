"""Operator 2: mix sources to target weights, in fixed-length blocks drawn by index. DataFrame functions only.

Words of each source's documents form one stream, cut into blocks of ``block`` words. A source's target
is its weighted share of all words; targets stop at ``most`` times the source's size and the excess goes to
the others by weight. Targets become quotas of blocks. Then three steps follow:

1. Draw: every output shard of ``SLOTS_PER_SHARD`` slots gets a number of slots of each source, a multinomial draw given
   the quotas that the other shards leave (a multivariate hypergeometric one), so that targets are met whatever the draw. A
   pseudorandom permutation deals the quotas' units to the shards and each (source, shard) counts its own: ``draws``.
2. Slots: the counts of a source over its shards, in order, number its slots. The j-th slot takes the block that the
   permutation of pass (j div blocks) gives for (j mod blocks), so a block comes back only when all others of its
   source have come once more: ``slots``, with their shard.
3. Join: blocks and slots are joined by (source, block).

The permutations are Feistel networks on a rectangle of at least n cells; a value beyond n is sent
through again until it is below.

A null text has size 0; a null source is a source of its own, the last one. Rows with equal doc_id are
apart. Sources without words have target 0. An empty table gives no rows. Reruns agree, whatever the
partitions, up to the order of rows with equal source, doc_id and text. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table, written

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK = 64
SEED = 7
SLOTS_PER_SHARD = 4096
ROUNDS = 4
#: A value leaves the range with a probability below 1/sqrt(n) a step, and at most sqrt(n) times in a row.
WALK = 32
ROWS_PER_BUCKET = 100_000
#: A row's number, where rows with equal doc_id and source must be told apart.
ROW = "_row"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), a row per source.

    Caps are reached in ascending order of cap by weight. With the first k sources capped, the others get
    (total - caps) * weight / (their weights); k is the first for which the next source stays below its cap.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int")).cast("double")
    s = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    s = s.withColumn("level", F.when(level * F.col("weight") <= F.col("cap"), level))
    # the level of the first source that stays below its cap holds for it and all after it
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(everything))
    return s.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A pseudorandom permutation of 0..n-1, chosen by ``key``, at ``index``."""
    seed = F.xxhash64(*key)

    def once(x: Column, wide: Column, high: Column) -> Column:
        a, b = F.floor(x / high).cast("long"), F.pmod(x, high)
        for r in range(ROUNDS):
            if r % 2:
                b = F.pmod(b + F.pmod(F.xxhash64(a, seed, F.lit(r)), high), high)
            else:
                a = F.pmod(a + F.pmod(F.xxhash64(b, seed, F.lit(r)), wide), wide)
        return a * high + b

    wide = F.ceil(F.sqrt(n.cast("double"))).cast("long")
    high = F.ceil(n / wide).cast("long")
    first = once(index.cast("long"), wide, high)
    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALK)),
        F.struct(first.alias("x"), F.lit(False).alias("done")),
        lambda acc, _: F.when(acc.done, acc).otherwise(_stepped(once(acc.x, wide, high), n)),
    )
    # few values leave the range at once, and only these walk
    return F.when(first < n, first).when(walk.done, walk.x).otherwise(F.raise_error(F.lit("a permutation left its range too often")).cast("long"))


def _stepped(x: Column, n: Column) -> Column:
    return F.struct(x.cast("long").alias("x"), F.coalesce(x < n, F.lit(True)).alias("done"))


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, source, tag, size) with ``at``: words of the source's stream before the document.

    The stream's order is by bucket of the hash of doc_id and text (so rows with an equal or null id are spread, too),
    then doc_id. Counts within buckets and the sum over buckets are separate, so no
    task holds a source.
    """
    buckets = max(256, docs.count() // ROWS_PER_BUCKET)
    d = docs.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(buckets)))
    inside = Window.partitionBy("source", "bucket").orderBy("doc_id", "size", "tag").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = d.groupBy("source", "bucket").agg(F.sum("size").alias("words")).withColumn("bucket_at", F.coalesce(F.sum("words").over(over), F.lit(0)))
    starts = starts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "bucket_at")
    d = d.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = d.join(starts, d.source.eqNullSafe(starts.s) & (d.bucket == starts.b))
    return d.drop("s", "b", "bucket").withColumn("at", F.col("bucket_at") + F.col("inside")).drop("bucket_at", "inside")


def quotas(sources: DataFrame, block: int = BLOCK, most: int = MOST) -> DataFrame:
    """(source, blocks, quota, first_unit), from (source, source_size, target); units are numbered over all sources."""
    s = sources.where("source_size > 0").withColumn("blocks", F.ceil(F.col("source_size") / block))
    # a source's last block may be short, so quotas count blocks of the source's mean length
    quota = F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), F.col("blocks") * most)
    after = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, 0)  # a row per source
    return s.withColumn("quota", quota).where("quota > 0").select("source", "blocks", "quota", (F.sum("quota").over(after) - F.col("quota")).alias("first_unit"))


def _numbered(df: DataFrame, count: str, *columns: str) -> DataFrame:
    """A row for each number below ``count``, as ``k``; made in two steps, so that no task makes many more than another."""
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / SLOTS_PER_SHARD).cast("long"))
    runs = df.select(*columns, count, F.explode(runs).alias("run")).repartition(df.sparkSession.sparkContext.defaultParallelism * 4, *columns, "run")
    last = F.least(F.col(count), (F.col("run") + 1) * SLOTS_PER_SHARD) - 1
    return runs.select(*columns, F.explode(F.sequence(F.col("run") * SLOTS_PER_SHARD, last)).alias("k"))


def draws(quota: DataFrame, seed: int = SEED) -> DataFrame:
    """(source, blocks, first_unit, shard, slots): how many slots of each shard a source gets."""
    total = quota.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    units = _numbered(quota, "quota", "source", "blocks", "first_unit")
    shard = F.floor(permuted(F.col("first_unit") + F.col("k"), F.lit(total), F.lit(seed)) / SLOTS_PER_SHARD).cast("long")
    return units.groupBy("source", "blocks", "first_unit", shard.alias("shard")).agg(F.count("*").alias("slots"))


def draw(sources: DataFrame, block: int = BLOCK, seed: int = SEED, most: int = MOST) -> DataFrame:
    """The slots of the mix: (source, shard, pass, index), from (source, source_size, target)."""
    drawn = written(draws(quotas(sources, block, most), seed), "draws")
    # numbers of slots before a shard: inside of a thousand shards, and before these
    some = drawn.withColumn("thousand", F.floor(F.col("shard") / 1000))
    inside = Window.partitionBy("source", "thousand").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("source").orderBy("thousand").rowsBetween(Window.unboundedPreceding, -1)
    starts = some.groupBy("source", "thousand").agg(F.sum("slots").alias("n")).select(F.col("source").alias("s"), F.col("thousand").alias("t"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("before"))
    some = some.withColumn("inside", F.coalesce(F.sum("slots").over(inside), F.lit(0)))
    some = some.join(starts, some.source.eqNullSafe(starts.s) & (some.thousand == starts.t)).withColumn("first", F.col("before") + F.col("inside"))
    slots = _numbered(some, "slots", "source", "blocks", "first_unit", "shard", "first")
    j = F.col("first") + F.col("k")
    again = F.floor(j / F.col("blocks")).cast("int")
    return slots.select("source", "shard", again.alias("pass"), permuted(F.pmod(j, F.col("blocks")), F.col("blocks"), F.lit(seed), F.col("first_unit"), again).alias("index"))


def pieces(placed_docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row for each block that a document has words in: (..., index, from_word, words)."""
    p = placed_docs.where("size > 0").withColumn("index", F.explode(F.sequence(F.floor(F.col("at") / block).cast("long"), F.floor((F.col("at") + F.col("size") - 1) / block).cast("long"))))
    start, end = F.greatest(F.col("index") * block, F.col("at")), F.least((F.col("index") + 1) * block, F.col("at") + F.col("size"))
    return p.withColumn("from_word", start - F.col("at")).withColumn("words", end - start)


def _sized(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    row = [c for c in docs.columns if c == ROW]
    sized = written(docs.select("doc_id", "source", *row, F.xxhash64("text").alias("tag"), size_of(F.col("text")).alias("size")), "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    return sized, written(sources, "sources")


def mix(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, first_shard) of each document: the words that the mix takes, and
    the first output shard that has some of them."""
    sized, sources = _sized(docs)
    here = placed(sized)
    times = draw(sources, block, seed).groupBy("source", "index").agg(F.count("*").alias("times"), F.min("shard").alias("shard")).select(F.col("source").alias("s"), F.col("index").alias("i"), "times", "shard")
    p = pieces(here, block)
    # planners take an exploded table for as small as what it came from; a merge join needs no estimate
    taken = p.join(times.hint("merge"), p.source.eqNullSafe(times.s) & (p.index == times.i)).groupBy("doc_id", "source", "at").agg(F.sum(F.col("words") * F.col("times")).alias("taken"), F.min("shard").alias("first_shard"))
    taken = taken.select(F.col("doc_id").alias("d"), F.col("source").alias("s"), F.col("at").alias("a"), "taken", "first_shard")
    joined = here.join(taken, here.doc_id.eqNullSafe(taken.d) & here.source.eqNullSafe(taken.s) & (here.at == taken.a) & (here.size > 0), "left")
    named = sources.select(F.col("source").alias("of"), "source_size", "target")
    return joined.join(named, joined.source.eqNullSafe(named.of)).select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mixed_documents(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """The mix as documents: for each document and pass one row with the words taken then, in order.

    A document taken whole keeps its text as it is; the words of one taken in part are joined by spaces.
    The columns are those of ``docs``; n_chars, if there, is counted anew. Rows are numbered and written first, so
    that rows with equal (or null) doc_id stay apart.
    """
    rows = written(docs.select(F.monotonically_increasing_id().alias(ROW), F.struct("*").alias("doc")), "rows")
    sized, sources = _sized(rows.select(ROW, "doc.doc_id", "doc.source", "doc.text"))
    here = placed(sized)
    slots = draw(sources, block, seed).select(F.col("source").alias("s"), F.col("index").alias("i"), "pass")
    p = pieces(here, block)
    chosen = p.join(slots.hint("merge"), p.source.eqNullSafe(slots.s) & (p.index == slots.i)).groupBy(ROW, "pass").agg(F.array_sort(F.collect_set(F.struct("from_word", "words"))).alias("parts"), F.first("size").alias("whole"))
    joined = rows.join(chosen, ROW)
    words = F.regexp_extract_all("doc.text", F.lit(f"({WORD})"))
    taken = F.aggregate("parts", F.lit(0).cast("long"), lambda acc, x: acc + x.words)
    cut = F.array_join(F.flatten(F.transform("parts", lambda x: F.slice(words, x.from_word.cast("int") + 1, x.words.cast("int")))), " ")
    joined = joined.select(F.col("doc").withField("text", F.when(taken == F.col("whole"), F.col("doc.text")).otherwise(cut)).alias("doc"))
    if "n_chars" in docs.columns:
        joined = joined.select(F.col("doc").withField("n_chars", F.length("doc.text").cast("long")).alias("doc"))
    return joined.select("doc.*")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "first_shard")
