"""The pipeline's near duplicates: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Words, hashes, fingerprints and their search are those of operator 4, over five words: texts whose fingerprints are linked
by steps of 3 bits or fewer are candidates. That radius finds only a small part of the pairs at 0.8, whose fingerprints are about 10 of 64 bits
apart, a radius that no segment table holds at scale. So candidates also
come from MinHash: 14 bands of 5 minima meet for a pair at 0.8 with a probability of 0.996, for one at 0.9
with 0.99999. A fingerprint's class is one more band, and each candidate's similarity is then computed exactly from both sets of hashes, and
verified pairs are joined to components, which makes likeness transitive.

Texts with the same words, whatever their case and white space, are one entry, however many documents hold them. In a
bucket of a band with up to ``ALL_PAIRS`` entries all pairs are candidates. In a larger bucket, whose pairs would grow
with the square of its size, each entry first meets the one that shares most buckets with others (a group's
original, as copies are closer to it than to each other) and one that is drawn by a hash in each band. The groups that result are then
closed: a pair inside a group can add nothing, so a bucket is done when its entries are all in one group. Otherwise the entries outside of its
largest group are compared with all others of the bucket, exactly, in blocks: common bits of two blocks' shingles are counted inside a task, which
gives no more links than it takes to join their groups. So groups are those that all pairs of all buckets would give. A bucket of near copies
costs a pass or two over its entries; one of many texts that are alike but not similar enough costs comparisons in the square of its number of blocks.

A null text counts as empty; texts without words are one group. A text of fewer than five words is one shingle. Very long texts are hashed in
parts; memory follows the longest text's number of distinct shingles. A group's document is the one with the smallest id (of equal ids, with the
smallest hash of its text, then of the whole row; one without an id only where no other has one). An empty table gives no rows. Other columns, whatever
their names, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import components
from .simhash import fingerprint_of, links, only, shingle_hashes

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 14, 5
ALL_PAIRS = 64
#: Entries of a block, in which the rest of a large bucket is compared.
BLOCK = 128
_RNG = np.random.default_rng(5)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def bands(hashes: np.ndarray) -> list[int]:
    """A number for each band's minima; equal numbers of two sets mean equal minima of the same band."""
    from xxhash import xxh64_intdigest

    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 1 << 12):  # bounded memory for long texts
        least = np.minimum(least, (hashes[None, at : at + (1 << 12)] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1))
    return [xxh64_intdigest(m.tobytes(), k) for k, m in enumerate(least.reshape(BANDS, ROWS))]


def signed(docs: DataFrame) -> DataFrame:
    """A row per document: tag is a hash of the text, entry one of its words, fp the fingerprint of its shingles."""
    from xxhash import xxh64_intdigest

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                texts = part.column("text").to_pylist()
                entry = [xxh64_intdigest(b" ".join((t or "").encode("utf-8", "replace").lower().split()), 1) for t in texts]
                fps, keys = [], []
                for t in texts:
                    hashes = shingle_hashes(t, SHINGLE_WORDS)
                    fps.append(fingerprint_of(hashes))
                    keys.append(np.array(bands(np.unique(hashes)) if len(hashes) else [], np.uint64).view(np.int64))
                columns = [part.column("doc_id"), part.column("tag"), *(pa.array(np.array(c, np.uint64).view(np.int64)) for c in (entry, fps)), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "tag", "entry", "fp", "bands"])

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("tag"), "text").mapInArrow(hashed, "doc_id long, tag long, entry long, fp long, bands array<long>")


def with_classes(entries: DataFrame) -> DataFrame:
    """Entries whose bands hold one more: the class of their fingerprint, found as operator 4 finds its components."""
    member = components(links(entries.where("size(bands) > 0").select("fp").distinct()))
    rooted = entries.hint("merge").join(member, entries.fp == member.node, "left")
    own = F.array(F.xxhash64(F.coalesce("root", "fp"), F.lit("simhash")))
    return rooted.withColumn("bands", F.when(F.size("bands") > 0, F.concat("bands", own)).otherwise(F.col("bands"))).select(*entries.columns)


def shingled(texts: DataFrame) -> DataFrame:
    """(entry, shingles): the sorted distinct hashes, from (entry, text)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [np.unique(shingle_hashes(t, SHINGLE_WORDS)).tobytes() for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("entry"), pa.array(sets, pa.binary())], ["entry", "shingles"])

    return texts.select("entry", "text").mapInArrow(hashed, "entry long, shingles binary")


def buckets(entries: DataFrame) -> DataFrame:
    """(band, entry, n) of the entries that meet others in a band, from (entry, bands); n is the bucket's size."""
    held = entries.select("entry", F.explode("bands").alias("band"))
    shared = held.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # planners take an exploded table for as small as what it came from; a merge join needs no estimate
    return held.hint("merge").join(shared, "band")


def candidates(met: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b: all of the small buckets, and each entry of the large ones with two of its bucket."""
    few, many = met.where(F.col("n") <= ALL_PAIRS), met.where(F.col("n") > ALL_PAIRS)
    one, two = few.select("band", F.col("entry").alias("a")), few.select("band", F.col("entry").alias("b"))
    pairs = one.join(two.hint("merge"), "band").where("a < b").select("a", "b")
    weighed = many.join(many.groupBy("entry").agg(F.sum("n").alias("meets")).hint("merge"), "entry")
    centre = F.max(F.struct("meets", "entry")).getField("entry")
    drawn = F.min(F.struct(F.xxhash64("entry", "band").alias("h"), "entry")).getField("entry")
    pivots = weighed.groupBy("band").agg(F.array(centre, drawn).alias("pivots"))
    spread = many.select("band", "entry").hint("merge").join(pivots, "band").select("entry", F.explode("pivots").alias("pivot")).where("entry <> pivot")
    return pairs.unionByName(spread.select(F.least("entry", "pivot").alias("a"), F.greatest("entry", "pivot").alias("b"))).distinct()


def grouped(many: DataFrame, member: DataFrame) -> DataFrame:
    """(band, entry, n, root, main, rest) of the buckets ``many`` that hold several groups: an entry's group, the bucket's largest one,
    and the number of entries outside of it."""
    rooted = many.select("band", "entry", "n").join(member.select(F.col("node").alias("entry"), "root").hint("merge"), "entry", "left").withColumn("root", F.coalesce("root", "entry"))
    sizes = rooted.groupBy("band", "root").agg(F.count("*").alias("k"))
    largest = F.max(F.struct("k", "root"))
    open_ = sizes.groupBy("band").agg(largest.getField("root").alias("main"), (F.sum("k") - largest.getField("k")).alias("rest")).where("rest > 0")
    return rooted.hint("merge").join(open_, "band")


def blocks(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(band, i, asking, held): pairs of blocks of about ``BLOCK`` entries (entry, root, shingles) of an open bucket, ``asking`` those
    outside of the largest group, ``held`` any. A bucket's pairs are spread over tasks by the asking block's number."""
    entry = F.struct("entry", "root", "shingles")
    with_sets = rows.hint("merge").join(sets, "entry")
    asking = with_sets.where("root <> main").withColumn("i", F.pmod(F.xxhash64("entry"), F.ceil(F.col("rest") / BLOCK)).cast("int"))
    asking = asking.groupBy("band", "i").agg(F.collect_list(entry).alias("asking"))
    j = F.pmod(F.xxhash64("entry"), F.ceil(F.col("n") / BLOCK)).cast("int")
    held = with_sets.withColumn("j", j).groupBy("band", "j", "rest").agg(F.collect_list(entry).alias("held"))
    held = held.withColumn("i", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("rest") / BLOCK) - 1).cast("int"))))
    return asking.hint("merge").join(held.select("band", "i", "held"), ["band", "i"]).select("asking", "held")


def forest(asking: list[dict], held: list[dict]) -> list[tuple[int, int]]:
    """Links that join the groups of two blocks as all their similar pairs do, no more than it takes."""
    sets = [[np.frombuffer(e["shingles"], np.uint64) for e in side] for side in (asking, held)]
    sizes = [np.array([len(x) for x in side], np.int64) for side in sets]
    tokens, at = np.unique(np.concatenate([x for side in sets for x in side] or [np.empty(0, np.uint64)]), return_inverse=True)
    row = np.repeat(np.arange(len(asking) + len(held)), np.concatenate(sizes))
    common = np.zeros((len(asking), len(held)), np.int64)
    for lo in range(0, len(tokens), 1 << 14):  # bounded memory for long texts
        part = (at >= lo) & (at < lo + (1 << 14))
        holds = np.zeros((len(asking) + len(held), 1 << 14), bool)
        holds[row[part], at[part] - lo] = True
        bits = np.packbits(holds, axis=1).view(np.uint64)
        for i in range(len(asking)):  # bits and counts: a product of matrices would start the linear algebra library's threads and their buffers
            common[i] += np.bitwise_count(bits[len(asking) :] & bits[i]).sum(axis=1, dtype=np.int64)
    close = common >= SIMILARITY * (sizes[0][:, None] + sizes[1][None, :] - common)
    roots, group, out = [[e["root"] for e in side] for side in (asking, held)], {}, []

    def top(x: int) -> int:
        while group.get(x, x) != x:
            x = group[x]
        return x

    for i, j in zip(*np.nonzero(close)):
        one, two = top(roots[0][i]), top(roots[1][j])
        if one != two:
            group[max(one, two)] = min(one, two)
            out.append((asking[i]["entry"], held[j]["entry"]))
    return out


def closed(many: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, root) of the groups by ``links`` and by all similar pairs of the buckets ``many``."""
    member = components(links)
    rows = written(grouped(many, member), "open")
    if rows.isEmpty():
        return member

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                found = forest(row["asking"], row["held"])
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], ["a", "b"])

    more = written(blocks(rows, sets).mapInArrow(compared, "a long, b long").distinct(), "links")
    tree = member.select(F.col("node").alias("a"), F.col("root").alias("b"))  # as good as the links, and fewer
    return components(tree.unionByName(more))


def verified(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """The pairs (a, b) with a similarity of at least ``SIMILARITY``, from the entries' sets of hashes."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y, keep = batch.column("x"), batch.column("y"), []
            for i in range(batch.num_rows):
                p, q = (np.frombuffer(c[i].as_py(), np.uint64) for c in (x, y))
                both = np.concatenate((p, q))
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(common >= SIMILARITY * (len(both) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = pairs.hint("merge").join(entries.select(F.col("entry").alias("a"), F.col("shingles").alias("x")), "a")
    pairs = pairs.hint("merge").join(entries.select(F.col("entry").alias("b"), F.col("shingles").alias("y")), "b")
    # sizes that differ by more than a similar pair's can't pass
    small, large = F.least(F.length("x"), F.length("y")), F.greatest(F.length("x"), F.length("y"))
    return pairs.where(small >= SIMILARITY * large).select("a", "b", "x", "y").mapInArrow(alike, "a long, b long")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each group of near copies."""
    rows = written(signed(docs), "signed")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "tag"))
    # rows with the same entry have the same bands, so a copy's bands may be any row's
    bare = rows.groupBy("entry").agg(least.alias("k"), F.first("fp").alias("fp"), F.first("bands").alias("bands"))
    bare = written(with_classes(written(bare, "bare")).drop("fp"), "entries")
    met = written(buckets(bare.select("entry", "bands")), "buckets")
    pairs = written(candidates(met), "candidates")
    named = pairs.select(F.explode(F.array("a", "b")).alias("entry")).distinct()
    first = bare.select("entry", F.col("k.none").alias("none"), F.col("k.id").alias("id"), F.col("k.tag").alias("tag")).hint("merge").join(named, "entry")
    # only the texts that are in a pair are hashed again; sets of all texts would take more room than the texts
    row = [F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("none")]
    texts = docs.select(*row, F.xxhash64("text").alias("tag"), "text").hint("merge").join(first, ["none", "id", "tag"])
    sets = written(shingled(texts.dropDuplicates(["entry"])), "sets")
    many, links = met.where(F.col("n") > ALL_PAIRS), verified(pairs, sets)
    member = components(links) if many.isEmpty() else closed(many, written(links, "links"), sets)
    rooted = bare.hint("merge").join(member, bare.entry == member.node, "left").select(F.coalesce("root", "entry").alias("root"), "k")
    return only(docs, rooted.groupBy("root").agg(F.min("k").alias("k")).select("k.*"))
