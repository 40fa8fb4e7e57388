"""Operator 3: toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause side by side (their composition is the tuple of their
states): insult, threat, target, negation and reported speech. The insult transducer's arcs are words
and word beginnings with weights; the other four read closed word classes. A clause's score is the sum
of its insult and threat weights, each lowered while the negation transducer is in scope, and the whole
raised if the clause names a target and lowered if it reports what others said. A document's score is
the sum over its clauses, mapped to 0..1 by a logistic curve that also knows the text's length.

The insult arcs and the curve are learned from labelled rows that are not held out (crc32 of the doc_id
as text, modulo 3, is not 1), at most ``MAX_TRAIN`` of them, drawn by hash; of rows with equal doc_id one is taken.
The arcs and the curve come to the driver; both are bounded by the training rows. An arc is kept if
its share of toxic documents would be too unlikely by chance (by the Chernoff bound); its weight is the
logarithm of the ratio of its frequencies in toxic and other documents. The curve is
fitted on scores from arcs learned on the other half of the rows. Only the text enters a score.

A null or empty text has the score of a text without any match. Without labels no insult arcs are known
and only threats score. Rows with equal doc_id are scored apart; of several labels for a document
the largest counts; null labels are left out. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table, written

MAX_TRAIN = 10_000
CUT = 0.7
BEGINNINGS = (3, 4, 5, 6, 7)
MOST, LEAST = 8.0, 2.5
THREAT, NEGATED, TARGETED, REPORTED = 3.0, 0.3, 1.5, 0.5
SCOPE = 3
PURE = 0.7
PRIOR = (2.5, 0.0, -4.0)
CACHED_WORDS = 150_000

# Closed classes in the four languages of the tables.
CLASSES = {
    "threat": "kill hurt destroy beat murder töten umbringen vernichten tuer détruire frapper matar destruir golpear",
    "target": "you your yourself u he she they him her them du dich dir ihr euch er sie tu te toi vous il elle ils tú ti usted ellos ella",
    "negation": "not no never nobody neither isn't aren't wasn't don't nicht kein keine nie niemals ne pas jamais nunca jamás tampoco",
    "report": "said says say told claimed called reported wrote quoted sagte sagt behauptete nannte dit disait écrit appelé dijo dice llamó escribió",
}
CLASS_OF = {w: k for k, words in CLASSES.items() for w in words.split()}
_EDGE = re.compile(r"^\W+|\W+$")
_ENDS = frozenset(".!?;,:")


def patterns(word: str) -> list[str]:
    """The insult arcs that could read ``word``: itself ("word$") and its beginnings."""
    return [word + "$", *(word[:n] for n in BEGINNINGS if len(word) >= n)]


class Grammar:
    """arcs: pattern -> weight."""

    def __init__(self, arcs: dict[str, float]):
        self.arcs = arcs
        self.known: dict[str, tuple[str, float] | None] = {}

    def read(self, token: str) -> tuple[str, float] | None:
        """What the transducers read in a token: (insult, weight), (another class, 0) or nothing."""
        word = _EDGE.sub("", token)
        if word in CLASS_OF:
            return CLASS_OF[word], 0.0
        weight = max((self.arcs.get(p, 0.0) for p in patterns(word)), default=0.0) if word else 0.0
        return ("insult", weight) if weight else None

    def clause(self, read: list[tuple[str, float] | None]) -> float:
        negation = target = report = 0  # the states of three transducers; insult and threat only put out weights
        total = 0.0
        for symbol in read:
            kind, weight = symbol or ("", 0.0)
            if kind == "threat":
                weight = THREAT if target else 0.0
            total += weight * (NEGATED if negation else 1.0)
            negation = SCOPE if kind == "negation" else max(0, negation - 1)
            target |= kind == "target"
            report |= kind == "report"
        return total * (TARGETED if target else 1.0) * (REPORTED if report else 1.0)

    def score(self, text: str | None) -> float:
        tokens = (text or "").lower().split()
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for t in set(tokens).difference(known):
            known[t] = self.read(t)
        read = list(map(known.__getitem__, tokens))
        total, done = 0.0, -1
        for i, symbol in enumerate(read):
            if symbol is None or i <= done or symbol[0] not in ("insult", "threat"):
                continue
            start = end = i
            while start > 0 and tokens[start - 1][-1] not in _ENDS:
                start -= 1
            while end + 1 < len(tokens) and tokens[end][-1] not in _ENDS:
                end += 1
            total += self.clause(read[max(start, done + 1) : end + 1])
            done = end
        return total


def _weights(counts: list[tuple[str, int, int]], toxic: int, clean: int, tried: int) -> dict[str, float]:
    """tried: patterns that were counted; the more, the rarer by chance an arc must be."""
    least = max(LEAST, math.log10(max(1, tried)))
    base = min(max(toxic / max(1, toxic + clean), 1e-6), 1 - 1e-6)
    found = {}
    for pattern, t, c in counts:
        share = t / (t + c)
        if t >= 2 and share > PURE:
            k = share * math.log(share / base) + ((1 - share) * math.log((1 - share) / (1 - base)) if share < 1 else 0.0)
            if (t + c) * k / math.log(10) >= least:
                found[pattern] = min(MOST, math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)))
    return found


def _features(scores: list[float], texts: list[str | None]) -> np.ndarray:
    """What the curve reads: the score and the length, as logarithms. A text's length in characters stands for its words."""
    return np.stack([np.log1p(np.array(scores, float)), np.log1p(np.array([len(t or "") for t in texts], float)), np.ones(len(scores))], axis=1)


def _curve(design: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Coefficients of a logistic curve, pulled slightly towards PRIOR."""
    prior = theta = np.array(PRIOR)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + 0.1 * np.eye(3), design.T @ (p - y) + 0.1 * (theta - prior))
        theta = theta - step
        if np.abs(step).max() < 1e-6:
            break
    return theta


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def fit(docs: DataFrame, labels: DataFrame) -> tuple[dict[str, float], np.ndarray]:
    """(arcs, curve), learned from at most MAX_TRAIN labelled rows that are not held out."""
    by_id = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    train = by_id.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN)
    train = docs.sparkSession.createDataFrame(train.toPandas(), "doc_id long, toxic int")  # bounded by MAX_TRAIN
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(train), "doc_id")
    rows = rows.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))  # one of repeated ids, so MAX_TRAIN holds
    rows = written(rows, "training").select("text", "toxic", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0).cast("int").alias("half"))

    def counts(found: list[Counter]) -> Iterator[pa.RecordBatch]:
        for kind, n in enumerate(found):
            if n:
                yield pa.RecordBatch.from_arrays([pa.array(list(n)), pa.array([kind] * len(n), pa.int32()), pa.array(list(n.values()), pa.int64())], ["pattern", "kind", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[Counter] = [Counter() for _ in range(4)]
        for batch in _parts(batches, 100):
            for text, toxic, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half"))):
                words = {_EDGE.sub("", t) for t in set((text or "").lower().split())} - {""}
                here = found[toxic + 2 * half]
                here.update({p for w in words for p in patterns(w)})
                here[""] += 1
            if sum(map(len, found)) > CACHED_WORDS:  # bounded memory; the counts are summed later
                yield from counts(found)
                found = [Counter() for _ in range(4)]
        yield from counts(found)

    counted = rows.mapInArrow(count, "pattern string, kind int, n long").groupBy("pattern").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(4)))
    counted = written(counted, "patterns")
    tried = counted.where("n0 + n1 + n2 + n3 >= 2").count()
    # arcs have at least two toxic documents, mostly toxic ones: few rows, bounded by the training rows
    few = counted.where("pattern = '' or (n1 + n3 >= 2 and n1 + n3 > n0 + n2) or (n1 >= 2 and n1 > n0) or (n3 >= 2 and n3 > n2)").collect()
    totals = next(((r.n0, r.n1, r.n2, r.n3) for r in few if r.pattern == ""), (0, 0, 0, 0))
    few = [r for r in few if r.pattern]
    arcs = _weights([(r.pattern, r.n1 + r.n3, r.n0 + r.n2) for r in few], totals[1] + totals[3], totals[0] + totals[2], tried)
    halves = [_weights([(r.pattern, r.n1, r.n0) for r in few if r.n1], totals[1], totals[0], tried), _weights([(r.pattern, r.n3, r.n2) for r in few if r.n3], totals[3], totals[2], tried)]
    shared = docs.sparkSession.sparkContext.broadcast(halves)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammars = [Grammar(x) for x in shared.value]
        for batch in _parts(batches):
            texts = batch.column("text").to_pylist()
            x = _features([grammars[1 - half].score(t) for t, half in zip(texts, batch.column("half").to_pylist())], texts)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("toxic")], ["score", "length", "toxic"])

    scored = rows.mapInArrow(score, "score double, length double, toxic int").toPandas()  # a row for each training row
    if scored.empty:
        return arcs, np.array(PRIOR)
    return arcs, _curve(np.column_stack([scored["score"], scored["length"], np.ones(len(scored))]), scored["toxic"].to_numpy(float))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``toxicity`` (0..1)."""
    arcs, curve = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(arcs)
    name = "toxicity"
    while name in docs.columns:
        name = f"_{name}"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(shared.value)
        for batch in _parts(batches):
            texts = batch.column("text").to_pylist()
            x = _features([grammar.score(t) for t in texts], texts)
            yield batch.append_column(name, pa.array(1 / (1 + np.exp(-np.clip(x @ curve, -30, 30))), pa.float64()))

    return docs.mapInArrow(score, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents whose score is below ``cut``."""
    scored = toxicity(docs, labels)
    return scored.where(F.col(scored.columns[-1]) < cut).select(*docs.columns)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= CUT).cast("int").alias("predicted"))
