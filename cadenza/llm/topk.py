"""Operator 7: exact top-k inner products over an impact-ordered index, score at a time.

Vectors are integers, floor(256 * x) for each component. The candidates lie in index blocks of ROWS vectors. A
block keeps its postings (vector, component) in order of descending quantised impact, the size of the value: segment by
segment, with what each vector still holds after each segment, as a norm (rounded up). A block of queries reads the
segments in that order and adds each one's products to all scores. By Cauchy and Schwarz the rest of a score is at most
the query's norm times the vector's unread norm. With this bound a vector is given up once k others, or the k-th score
that the query has already had in other blocks of the task, are sure to beat it; reading stops when so few are left that
scoring these possible members exactly is cheaper, at best before the first segment, and at the latest after the last
one. Query blocks meet index blocks by an equi-join on the index block's cell, and each pair passes on at most k rows a query.

Vectors that are null or hold null or non-finite components take no part, nor do null ids. A shorter
vector counts as filled with zeros. Rows with the query's vec_id are not candidates; otherwise repeated
rows take part as they are. Equal scores rank by vec_id. An empty table gives no rows. Other columns are
ignored. Components and scores that are too large for a long, of finite vectors as well, count as the largest long or its
negative; a block that holds such vectors is scored without its index, in whole numbers of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

K, ROWS, QUERIES = 5, 2048, 512
LARGEST = (1 << 63) - 1
#: Least size of a segment's values, as a share of the block's largest.
SEGMENTS = (0.25, 0.08, 0.03, 0.0)
#: Queries and index blocks whose k-th scores a task remembers.
REMEMBERED = 1024
_BLOCK = "block long, n int, width int, ids binary, data binary, postings binary, ends binary, unread binary"


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as longs."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(x, lambda e: F.coalesce(F.abs(e) < float("inf"), F.lit(False)))
    return vectors.where(good).select(F.col("vec_id").cast("long"), F.transform(x, lambda e: F.greatest(F.floor(256 * e).cast("long"), F.lit(-LARGEST))).alias("v"))


def segments(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(postings, ends, unread): places in the flat ``vectors`` by descending impact, the end of each segment, and the norm of
    each vector's values outside of the first 0, 1, ... segments."""
    size = np.abs(vectors).astype(float)
    impact = np.digitize(-size, [-s * size.max(initial=0) for s in SEGMENTS[:-1]], right=True)  # the first segment has the largest
    impact[size == 0] = len(SEGMENTS)  # zeros have no posting
    order = np.argsort(impact, axis=None, kind="stable").astype(np.int32)
    ends = np.searchsorted(impact.ravel()[order], np.arange(len(SEGMENTS)), "right")
    unread = np.stack([np.sqrt((np.where(impact >= i, size, 0.0) ** 2).sum(axis=1)) for i in range(len(SEGMENTS) + 1)])
    return order[: ends[-1]], ends.astype(np.int32), np.nextafter((unread * (1 + 1e-6)).astype(np.float32), np.float32(np.inf)) * (unread > 0)


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of up to ``rows`` vectors of (vec_id, v), each made from rows of one partition."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                lists = part.column("v").to_pylist()
                width = max(map(len, lists))
                data = np.zeros((len(lists), width), "<i8")
                for i, v in enumerate(lists):
                    data[i, : len(v)] = v
                ids = np.array(part.column("vec_id").to_pylist(), "<i8")
                held = [pa.array([x.tobytes()]) for x in (ids, data, *segments(data))]
                yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64()), pa.array([len(lists)], pa.int32()), pa.array([width], pa.int32()), *held], [c.split()[0] for c in _BLOCK.split(", ")])

    return vectors.mapInArrow(packed, _BLOCK).withColumn("block", F.monotonically_increasing_id())


def search(queries: np.ndarray, vectors: np.ndarray, index: tuple[np.ndarray, np.ndarray, np.ndarray], own: np.ndarray, k: int, known: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For each row of ``queries`` (members, scores): its k best rows of ``vectors`` among those that ``own`` (queries x
    vectors) doesn't exclude and whose score reaches ``known``, and maybe more; and how many segments were read."""
    postings, ends, unread = index
    n, width = vectors.shape
    q, norm = queries.astype(float), np.sqrt((queries.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
    whole = int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0)) * max(1, width) < 1 << 53  # then float sums are exact
    scores, possible, read = np.zeros((len(queries), n)), ~own, 0
    while whole:
        rest = norm[:, None] * unread[read][None, :].astype(float)
        floor = known
        if n > k:
            sure = np.where(own, -np.inf, scores - rest)
            floor = np.maximum(known, np.partition(sure, n - k, axis=1)[:, n - k])
        possible &= scores + rest >= floor[:, None]
        if read == len(ends) or np.count_nonzero(possible) <= 4 * k * len(queries):
            break
        here = postings[ends[read - 1] if read else 0 : ends[read]]
        part = np.zeros(n * width)
        part[here] = vectors.ravel()[here]
        scores += q @ part.reshape(n, width).T
        read += 1
    out = []
    for i in range(len(queries)):
        members = np.flatnonzero(possible[i])
        if whole:
            out.append((members, vectors[members] @ queries[i]))
        else:
            exact = vectors[members].astype(object) @ queries[i].astype(object)
            out.append((members, np.array([min(max(int(s), -LARGEST), LARGEST) for s in exact], np.int64)))
    return out, read


def top_k(vectors: DataFrame, wanted: Column, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows for each row for which ``wanted`` holds."""
    v = written(integers(vectors), "integers")
    index = written(blocks(v, ROWS), "index")
    asked = blocks(v.where(wanted), QUERIES).select(*(F.col(c).alias(f"q_{c}") for c in ("block", "n", "width", "ids", "data")))
    # every query block goes to every cell; the index blocks are dealt over as many cells as there are blocks
    cells = max(1, index.count())
    index = index.withColumn("cell", F.pmod(F.xxhash64("block"), F.lit(cells)))
    asked = asked.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long"))))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_known: dict[int, np.ndarray] = {}  # of each query block its queries' k best scores in this task
        for batch in batches:
            for i in range(batch.num_rows):
                r = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                x, q = (np.frombuffer(r[f"{p}data"], "<i8").reshape(r[f"{p}n"], r[f"{p}width"]) for p in ("", "q_"))
                # a query's further components meet zeros
                q = np.pad(q, ((0, 0), (0, max(0, x.shape[1] - q.shape[1]))))[:, : x.shape[1]]
                ids, q_ids = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["q_ids"], "<i8")
                index = np.frombuffer(r["postings"], np.int32), np.frombuffer(r["ends"], np.int32), np.frombuffer(r["unread"], np.float32).reshape(-1, r["n"])
                if r["q_block"] not in best_known and len(best_known) >= REMEMBERED:
                    best_known.pop(next(iter(best_known)))
                top = best_known.setdefault(r["q_block"], np.full((len(q_ids), k), -np.inf))
                out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                for j, (members, scores) in enumerate(search(q, x, index, q_ids[:, None] == ids[None, :], k, top.min(axis=1))[0]):
                    best = np.lexsort((ids[members], -scores))[:k]
                    out.append((np.full(len(best), q_ids[j]), ids[members][best], scores[best]))
                    top[j] = np.sort(np.concatenate((top[j], scores[best].astype(float))))[-k:]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])

    found = asked.join(index.hint("merge"), "cell").select("n", "width", "ids", "data", "postings", "ends", "unread", "q_block", "q_n", "q_width", "q_ids", "q_data").mapInArrow(answer, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP7_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
