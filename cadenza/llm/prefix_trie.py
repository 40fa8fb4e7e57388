"""Operator 13: the trie of conversations' shared beginnings, from fingerprints that compose.

Every conversation c is rebuilt as the first h turns of conversation c - c % 5 (a remainder with the sign of c, as in SQL), then its own turns after
its first h, with h = crc32(c) % 9. No rebuilt text is made. A stored turn is known by a reference, two 64-bit hashes of role and text. A run of
turns has a length n and a hash product S, the sum of x_i * B**i over its references x_i modulo a prime; runs compose by
(n, S)(m, T) = (n + m, S + B**n T), and this can be undone, as B has an inverse. So a conversation's prefixes are known from its
prefix products alone: the base's product up to h, times the own product with its first h turns divided off.

Steps: turns without their texts are put into ordered chunks by range, so that a conversation of any length is spread over tasks; each
(conversation, chunk) is a piece with its product. Running sums over the pieces give each piece's place and the product before it.
Pieces then give a row for each rebuilt prefix; equal products of equal depth are a node.

Verified, not assumed: every reference must name one (role, text) among all stored turns, and all members of every node must have one
parent and one last reference. By induction over the depth a node's members then begin with equal turns. If a
check fails, which 122 bits make unlikely, all is done again with other hashes.

A node belongs to its smallest member; so an ancestor 2**k steps up is that conversation's prefix, found by the unique key
(conversation, depth). Subtree sums double their reach in each round, so a trie of depth d takes log2(d) rounds. A parent with many children
is sent to all tasks, if it has more than 1 / HOT of all nodes (there are fewer than HOT of those). The digest of a node's ends, sequential by its
nature, is fed from joined runs of ids in order, in constant memory.

Null role or text count as empty. A null turn comes first; turns of equal number are ordered by role, then by a hash of the text;
repeated rows are repeated turns. Rows with a null conv_id belong to no conversation. Very long texts are only hashed and measured. An
empty table gives no rows (no root). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

GROUP, LONGEST_HEAD = 5, 8
PRIME = (1 << 61) - 1
TURNS_PER_CHUNK, IDS_PER_RUN, HOT = 100_000, 50_000, 10_000
NODE = ["depth", "fa", "fb"]
_OCC = "conv_id long, depth long, fa long, fb long, pa long, pb long, ta long, tb long, octets long, ends boolean"
_NODE = "depth long, fa long, fb long"


def bases(seed: int) -> tuple[int, int]:
    rng = np.random.default_rng([13, seed])
    return tuple(int(b) for b in rng.integers(1 << 32, PRIME, 2))


def composed(one: tuple[int, int], two: tuple[int, int], base: int) -> tuple[int, int]:
    """The (length, product) of a run followed by another."""
    return one[0] + two[0], (one[1] + pow(base, one[0], PRIME) * two[1]) % PRIME


def product(xs: list[int], base: int) -> int:
    out = 0
    for x in reversed(xs):
        out = (out * base + x) % PRIME
    return out


def stored_turns(conversations: DataFrame, seed: int) -> DataFrame:
    """(conv_id, turn, role, text, ta, tb): the turns with their references."""
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")))
    return rows.withColumns({"ta": F.xxhash64(F.lit(2 * seed), "role", "text"), "tb": F.xxhash64(F.lit(2 * seed + 1), "text", "role")})


def references_hold(turns: DataFrame) -> bool:
    """Does each reference name only one role and text?"""
    return turns.groupBy("role", "text").agg(F.min("ta").alias("ta"), F.min("tb").alias("tb")).groupBy("ta", "tb").count().where("count > 1").isEmpty()


def pieces(turns: DataFrame, seed: int) -> DataFrame:
    """(conv_id, chunk, turns, n, ga, gb): what a chunk holds of a conversation, in order, with its products."""
    spark, (a, b) = turns.sparkSession, bases(seed)
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-turns.count() // TURNS_PER_CHUNK))
    at = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", "role", F.xxhash64("text").alias("h"), "ta", "tb", F.monotonically_increasing_id().alias("row"))
    rows = turns.select("conv_id", at.alias("at"), F.octet_length("text").cast("long").alias("octets"))
    chunks = rows.repartitionByRange(n, "conv_id", "at.numbered", "at.turn", "at.role", "at.h", "at.row").withColumn("chunk", F.spark_partition_id())
    held = chunks.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("at", "octets"))).alias("rows"))
    held = held.select("conv_id", "chunk", F.transform("rows", lambda r: F.struct(r.at.ta.alias("ta"), r.at.tb.alias("tb"), r.octets.alias("octets"))).alias("turns"))

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("turns")
            ends, values = lists.offsets.to_numpy(), lists.values
            xs, ys = (values.field(i).to_pylist() for i in (0, 1))
            spans = list(zip(ends.tolist(), ends[1:].tolist()))
            ga, gb = [product(xs[s:e], a) for s, e in spans], [product(ys[s:e], b) for s, e in spans]
            sizes = pa.array(np.diff(ends).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, sizes, pa.array(ga, pa.int64()), pa.array(gb, pa.int64())], ["conv_id", "chunk", "turns", "n", "ga", "gb"])

    return held.mapInArrow(multiplied, "conv_id long, chunk int, turns array<struct<ta:long,tb:long,octets:long>>, n long, ga long, gb long")


def placed(parts: DataFrame, seed: int) -> DataFrame:
    """(conv_id, chunk, total, start, sa, sb): turns of the conversation, turns and products before each piece."""
    a, b = bases(seed)
    small = parts.select("conv_id", "chunk", "n", "ga", "gb")  # at most a row a chunk for any conversation
    by = Window.partitionBy("conv_id")
    before = by.orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    small = small.withColumns({"total": F.sum("n").over(by), "start": F.coalesce(F.sum("n").over(before), F.lit(0))})

    def weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = batch.column("start").to_pylist()
            own = [pa.array([composed((s, 0), (0, g), base)[1] for s, g in zip(starts, batch.column(c).to_pylist())], pa.int64()) for c, base in (("ga", a), ("gb", b))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "chunk", "total", "start")), *own], ["conv_id", "chunk", "total", "start", "wa", "wb"])

    small = small.mapInArrow(weighted, "conv_id long, chunk int, total long, start long, wa long, wb long")
    sums = {f"s{c}": (F.coalesce(F.sum(F.col(f"w{c}").cast("decimal(19,0)")).over(before), F.lit(0)) % F.lit(PRIME)).cast("long") for c in "ab"}
    return small.withColumns(sums).drop("wa", "wb")


def heads(parts: DataFrame, places: DataFrame) -> DataFrame:
    """(conv_id, h, head, skipped): the h or fewer turns that each conversation takes, and those of its own that it gives up."""
    first = parts.select("conv_id", "chunk", F.slice("turns", 1, LONGEST_HEAD).alias("turns")).join(places.where(F.col("start") < LONGEST_HEAD).select("conv_id", "chunk", "start"), ["conv_id", "chunk"])
    first = first.groupBy("conv_id").agg(F.slice(F.flatten(F.array_sort(F.collect_list(F.struct("start", "turns"))).getField("turns")), 1, LONGEST_HEAD).alias("first"))
    first = written(first, "first")
    own = first.select("conv_id", F.col("first").alias("own"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"), (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST_HEAD + 1)).cast("int").alias("h"))
    taken = own.join(first.select(F.col("conv_id").alias("base"), F.col("first").alias("head")), "base", "left")
    return taken.select("conv_id", "h", F.slice(F.coalesce("head", F.expr("array()").cast(first.schema["first"].dataType)), F.lit(1), F.col("h")).alias("head"), F.slice("own", F.lit(1), F.col("h")).alias("skipped"))


def occurrences(parts: DataFrame, places: DataFrame, seed: int) -> DataFrame:
    """A row for each prefix of each rebuilt conversation: its products, its parent's, its last turn; does the conversation end there?"""
    base = bases(seed)
    known = written(places.join(heads(parts, places), "conv_id"), "known")

    def prefixes(row: dict) -> Iterator[tuple]:
        conv, h, head, start = row["conv_id"], row["h"], row["head"], row["start"]
        length = len(head) + max(0, row["total"] - h)
        refs = [[t["ta"], t["tb"]] for t in head], [[t["ta"], t["tb"]] for t in row["skipped"]]
        f, at = [0, 0], 0
        if not start:
            yield conv, 0, 0, 0, None, None, None, None, None, not length
        for t, ref in zip(head, refs[0]):
            g = [composed((at, v), (1, x), b)[1] for v, x, b in zip(f, ref, base)]
            at += 1
            if not start:
                yield conv, at, *g, *f, *ref, t["octets"], at == length
            f = g
        # the own product without its first h turns, put behind the head: shift * (s - skipped)
        lane = list(zip(*refs[1])) or [(), ()]
        skipped = [product(list(x), b) for x, b in zip(lane, base)]
        shift = [pow(b, at - h, PRIME) for b in base]
        s, power = [row["sa"], row["sb"]], [pow(b, start, PRIME) for b in base]
        last = [(v + m * (x - k)) % PRIME for v, m, x, k in zip(f, shift, s, skipped)] if start > h else f
        for i, t in enumerate(row["turns"], start):
            ref = [t["ta"], t["tb"]]
            s = [(v + x * p) % PRIME for v, x, p in zip(s, ref, power)]
            power = [p * b % PRIME for p, b in zip(power, base)]
            if i >= h:
                g = [(v + m * (x - k)) % PRIME for v, m, x, k in zip(f, shift, s, skipped)]
                yield conv, at + i - h + 1, *g, *last, *ref, t["octets"], at + i - h + 1 == length
                last = g

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = zip(*(c.split() for c in _OCC.split(", ")))
        types = [pa.bool_() if t == "boolean" else pa.int64() for t in types]

        def full(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], list(names))

        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                for r in prefixes(row):
                    out.append(r)
                    if len(out) == 20_000:
                        yield full(out)
                        out = []
            if out:
                yield full(out)

    return parts.select("conv_id", "chunk", "turns").join(known, ["conv_id", "chunk"]).mapInArrow(listed, _OCC)


def grouped(occ: DataFrame) -> DataFrame:
    """The nodes, with their smallest member, and whether their members agree on parent and last turn."""
    ends = [f(c).alias(f"{c}_{n}") for c in ("pa", "pb", "ta", "tb") for n, f in (("min", F.min), ("max", F.max))]
    nodes = occ.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("octets").alias("octets"), *ends)
    same = reduce(Column.__and__, [F.col(f"{c}_min").eqNullSafe(F.col(f"{c}_max")) for c in ("pa", "pb", "ta", "tb")])
    return nodes.select(*NODE, "conv_id", "n_convs", "octets", F.col("pa_min").alias("pa"), F.col("pb_min").alias("pb"), F.col("ta_min").alias("ta"), F.col("tb_min").alias("tb"), same.alias("agrees"))


def verified_nodes(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(occurrences, nodes) by the first seed under which all checks hold."""
    seed = 0
    while True:
        turns = stored_turns(conversations, seed)
        if references_hold(turns):
            parts = written(pieces(turns, seed), "pieces")
            places = written(placed(parts, seed), "places")
            occ = written(occurrences(parts, places, seed), "occurrences")
            nodes = written(grouped(occ), "nodes")
            if nodes.where("not agrees").isEmpty():
                return occ, nodes.drop("agrees")
        seed += 1


def subtree_sums(nodes: DataFrame, occ: DataFrame, columns: list[str]) -> DataFrame:
    """Each node's ``columns``, summed over its subtree."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    up = occ.select("conv_id", *NODE)
    sums, step = nodes.select("conv_id", *NODE, *columns), 1
    while step <= deepest:
        below = sums.select("conv_id", (F.col("depth") - step).alias("depth"), *columns).where("depth >= 0")
        given = below.join(up, ["conv_id", "depth"]).select(F.lit(None).cast("long").alias("conv_id"), *NODE, *columns)
        both = sums.unionByName(given).groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in columns))
        sums, step = written(both.select("conv_id", *NODE, *columns), "sums"), 2 * step
    return sums.drop("conv_id")


def ends_digests(occ: DataFrame) -> DataFrame:
    """The SHA-256 of the ascending ids, joined by commas, of the conversations that end in a node."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []

        def close():
            if ids:
                out.append((*node, ids[0], ",".join(map(str, ids))))

        def full() -> pa.RecordBatch:
            columns = [pa.array(c, pa.string() if i == 4 else pa.int64()) for i, c in enumerate(zip(*out))]
            return pa.RecordBatch.from_arrays(columns, [*NODE, "first", "run"])

        for batch in batches:
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key != node or len(ids) >= IDS_PER_RUN:
                    close()
                    node, ids = key, []
                ids.append(conv)
            if out:
                yield full()
                out = []
        close()
        if out:
            yield full()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []

        def full() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 3 else pa.int64()) for i, c in enumerate(zip(*out))], [*NODE, "ends_sha256"])

        for batch in batches:
            for *key, run in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    sha.update(b"," + run.encode())
                    continue
                if node:
                    out.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(run.encode())
            if out:
                yield full()
                out = []
        if node:
            out.append((*node, sha.hexdigest()))
            yield full()

    ended = occ.where("ends").select(*NODE, "conv_id")
    runs = ended.repartitionByRange(*NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id").mapInArrow(joined, f"{_NODE}, first long, run string")
    return runs.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "run").mapInArrow(digested, f"{_NODE}, ends_sha256 string")


def with_parents(nodes: DataFrame, children: DataFrame) -> DataFrame:
    """``nodes`` with parent_conv_id; a parent of more than 1 / HOT of all nodes comes by broadcast."""
    n = nodes.count()
    key = [F.col("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb")]
    owners = nodes.join(children, NODE).select(*key, F.col("conv_id").alias("parent_conv_id"), "n_children").withColumn("depth", F.col("depth") + 1)
    hot = owners.where(F.col("n_children") * HOT > n).drop("n_children")  # fewer than HOT rows
    near = nodes.join(F.broadcast(hot), ["depth", "pa", "pb"], "left")
    cold = owners.where(F.col("n_children") * HOT <= n).drop("n_children")
    rest = near.where("parent_conv_id is null and depth > 0").drop("parent_conv_id").join(cold.hint("merge"), ["depth", "pa", "pb"])
    return near.where("parent_conv_id is not null or depth = 0").unionByName(rest)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row for each node: depth, its products fa and fb, its last turn's reference ta and tb, conv_id, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256."""
    occ, nodes = verified_nodes(conversations)
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb")).agg(F.count("*").alias("n_children"))
    children = written(children, "children")
    own = nodes.join(children, NODE, "left").select("conv_id", *NODE, F.col("n_children").isNull().cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.coalesce("octets", F.lit(0))).alias("saved_tokens"))
    sums = subtree_sums(written(own, "own"), occ, ["n_leaves", "saved_tokens"])
    out = with_parents(nodes, children).join(children, NODE, "left").join(sums, NODE).join(ends_digests(occ), NODE, "left")
    none = hashlib.sha256(b"").hexdigest()
    filled = {"n_children": F.coalesce("n_children", F.lit(0)).cast("long"), "ends_sha256": F.coalesce("ends_sha256", F.lit(none))}
    return out.withColumns(filled).select(*NODE, "ta", "tb", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = prefix_trie(table(spark, sf_dir, "conversations"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


OP13_SQL = """
WITH own AS (
    SELECT conv_id AS c, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, '')) AS ts
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), headed AS (
    -- crc32 of the decimal id, bit by bit
    SELECT c, ts, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)),
        lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda v, k: xor(v >> 1, 3988292384::BIGINT * (v & 1)))), 4294967295::BIGINT) % 9 AS h
    FROM own
), rebuilt AS (
    SELECT o.c, list_concat(coalesce(b.ts[1:o.h], []), o.ts[o.h + 1:]) AS ts FROM headed o LEFT JOIN own b ON b.c = o.c - o.c % 5
), prefixes AS (
    SELECT c, d, ts[1:d] AS p, len(ts) = d AS ends FROM (SELECT c, ts, unnest(range(len(ts) + 1)) AS d FROM rebuilt)
), nodes AS (
    SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
    FROM prefixes GROUP BY d, p
), children AS (
    SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), own_sums AS (
    SELECT n.d, n.p, (k.n IS NULL)::BIGINT AS leaf, CASE WHEN n.d = 0 THEN 0 ELSE (n.n_convs - 1) * strlen(n.p[n.d].x) END AS saved
    FROM nodes n LEFT JOIN children k ON k.p = n.p
), sums AS (
    SELECT p[1:u] AS p, sum(leaf) AS leaves, sum(saved) AS saved FROM (SELECT p, leaf, saved, unnest(range(d + 1)) AS u FROM own_sums) GROUP BY 1
)
SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
    s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.p = n.p LEFT JOIN children k ON k.p = n.p LEFT JOIN nodes q ON n.d > 0 AND q.p = n.p[1:n.d - 1]
"""
