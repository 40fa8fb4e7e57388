"""Operator 8: benchmark decontamination by edit distance, with CGK embeddings and bit-sampling LSH.

A passage of a document matches a benchmark item of n words if at most floor(0.2 n) word insertions, deletions
and replacements turn one into the other. Words are runs of non-white-space, in lower case and without
the punctuation marks of _MARKS at their ends; tokens of marks alone are left out.

1. CGK: a random walk copies each word of a window one or more times and goes on, by bits that depend on the step and
   the word only; after an edit, two walks soon copy the same words again, so few edits show as few unequal places. The
   walk starts anew at each word of an item-sized window, so one walk a word of the document serves all windows.
2. Bit sampling: each table samples a few places of a walk's first steps (TABLES: the steps; short items
   have tables of their own). All items' samples, from each of their words, are held in a sorted table; a document's
   samples are looked up there, and each hit votes for an item and a diagonal (place in the document less place in
   the item). A passage of six or more words with the most edits always keeps three unedited words in a row, and a
   table of three steps sees them if its walk moves on twice; a window goes on with votes from one in VOTES of
   the item's words (at least one) on diagonals no further apart than twice the allowed edits. Walks that see too few
   words, which say little, are left out on both sides. Recall is measured in the tests.
3. A window that goes on is verified: the exact least edit distance between the item and any part of the
   window widened by the allowed edits (bit-parallel dynamic programming).

The result has one row for each document row and item that matches: doc_id, item_id, edits (the least),
similarity (1 - edits / n) and start (the first word, from 0, on the diagonal with most votes).

Null or empty texts and items without words match nothing. Repeated documents or items stay apart; a null doc_id
or item_id stays null in the result. Empty tables give no rows. Other columns are ignored. Items are read in
groups of about ITEMS, each a pass over the documents, so what a task holds of them is bounded (some 5 MB of samples
for items of 40 words).
"""

from __future__ import annotations

import string
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, table, written

EDITS = 0.2
ITEMS = 4096
#: For items of at least so many words: tables of (sampled places, steps that they are drawn from).
TABLES = {1: ((1, 1),), 2: ((2, 2),) * 8, 6: ((3, 3),) * 6 + ((3, 4),) * 3 + ((3, 5),) * 3}
VOTES = 6
MATCH = "doc_id long, item_id long, edits int, similarity double, start int"
_MARKS = string.punctuation + "“”„‘’‚«»‹›¿¡…–—·•"


def words_of(text: str | None) -> list[str]:
    return [w for t in (text or "").lower().split() if (w := t.strip(_MARKS))]


class Table:
    """Samples of CGK walks: ``places`` of the first steps, of which the first place is always one."""

    def __init__(self, sampled: int, steps: int, seed: int):
        rng = np.random.default_rng(seed)
        self.places = {0, *rng.choice(np.arange(1, steps), sampled - 1, replace=False).tolist()} if sampled > 1 else {0}
        self.factors = rng.integers(1, 1 << 62, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts, samples) of the walks that see as many words as places are sampled, and whose sampled places all hold
        words: ids above 0. ``ids`` ends in zeros."""
        at, key, last, moves = starts, np.zeros(len(starts), np.uint64), max(self.places), len(self.places) - 1
        for t in range(last + 1):
            w = ids[at]
            held = (at - starts) >= moves - (last - t)  # walks that can still see enough words
            if t in self.places:
                held &= w > 0
            at, starts, w, key = at[held], starts[held], w[held], key[held]
            if t in self.places:
                key = (key ^ w) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(29)
            if t < last:
                at = np.minimum(at + ((w + np.uint64(1)) * self.factors[t] >> np.uint64(63)).astype(np.int64), len(ids) - 1)
        return starts, key


def masks_of(item: np.ndarray) -> dict[int, int]:
    equal: dict[int, int] = defaultdict(int)
    for i, w in enumerate(item.tolist()):
        equal[w] |= 1 << i
    return dict(equal)


def least_edits(n: int, equal: dict[int, int], text: np.ndarray) -> int:
    """The least edit distance between an item of n words, given by ``masks_of``, and any part of ``text``."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best = full, 0, n, n
    for w in text.tolist():
        eq = equal.get(w, 0)
        across = (((eq & up) + up) ^ up) | eq
        more, less = (down | ~(across | up)) & full, up & across
        score += bool(more & top) - bool(less & top)
        best = min(best, score)
        more, less, vertical = more << 1 & full, less << 1 & full, eq | down
        up, down = (less | ~(vertical | more)) & full, more & vertical
    return best


class Detector:
    """Finds items in texts. Words of items are numbered from 1; all other words are 0."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        found = [(i, w) for i, t in items if (w := words_of(t))]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in found for w in ws}), 1)}
        self.names = [i for i, _ in found]
        self.items = [np.array([self.vocabulary[w] for w in ws], np.int64) for _, ws in found]
        self.lengths = np.array([len(x) for x in self.items], np.int64)
        self.masks = [masks_of(x) for x in self.items]
        self.vocabulary[""] = -1
        self.verified: dict[tuple[int, bytes], int] = {}
        self.tables = []
        least = sorted(TABLES)
        for low, high in zip(least, [*least[1:], 1 << 62]):
            some = np.flatnonzero((self.lengths >= low) & (self.lengths < high))
            if len(some):
                gap = np.zeros(1 + max(steps for _, steps in TABLES[low]), np.int64)
                ids = np.concatenate([x for k in some for x in (self.items[k], gap)])
                of = np.repeat(some, self.lengths[some] + len(gap))
                place = np.concatenate([np.arange(self.lengths[k] + len(gap)) for k in some])
                for i, (sampled, steps) in enumerate(TABLES[low]):
                    table = Table(sampled, steps, 100 * low + i)
                    starts, keys = table.samples(ids.astype(np.uint64), np.flatnonzero(ids))
                    order = np.argsort(keys, kind="stable")
                    known, first, count = np.unique(keys[order], return_index=True, return_counts=True)
                    maybe = np.zeros(1 << 20, bool)  # most samples of a document are not there: a small table says so at once
                    maybe[(known >> np.uint64(44)).astype(np.int64)] = True
                    self.tables.append((table, known, first, count, of[starts[order]], place[starts[order]], maybe))

    def edits(self, k: int) -> int:
        return int(EDITS * self.lengths[k])

    def numbered(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): the numbers of all texts' words with a zero after each text, and where each text begins."""
        split = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
        bounds = split.offsets.to_numpy().astype(np.int64)
        words = split.values.slice(int(bounds[0]), int(bounds[-1] - bounds[0])).dictionary_encode()
        get = self.vocabulary.get
        number = np.array([get(w.lower().strip(_MARKS), 0) for w in words.dictionary.to_numpy(zero_copy_only=False).tolist()], np.int64)
        ids = number[words.indices.to_numpy()] if len(number) else np.zeros(0, np.int64)
        ends = np.concatenate(([0], np.cumsum(ids >= 0)))[bounds - bounds[0]]
        out = np.zeros(ends[-1] + len(texts), np.int64)
        keep = ids[ids >= 0]
        out[np.arange(len(keep)) + np.repeat(np.arange(len(texts)), np.diff(ends))] = keep
        return out, ends + np.arange(len(texts) + 1)

    def _votes(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, place in ``ids``, place in the item), once each, of the hits of all tables, as item and a pair of columns."""
        padded = np.concatenate((ids, np.zeros(1, np.int64))).astype(np.uint64)
        words, found = np.flatnonzero(ids > 0), []
        for table, known, first, count, of, place, maybe in self.tables:
            starts, keys = table.samples(padded, words)
            held = maybe[(keys >> np.uint64(44)).astype(np.int64)]
            starts, keys = starts[held], keys[held]
            at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            held = known[at] == keys
            starts, at = starts[held], at[held]
            n = count[at]
            rows = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            found.append(np.stack((of[rows], np.repeat(starts, n), place[rows])))
        if not found:
            return np.zeros(0, np.int64), np.zeros((2, 0), np.int64)
        item, at, of = np.concatenate(found, axis=1)
        order = np.lexsort((of, at, item))
        item, at, of = item[order], at[order], of[order]
        new = np.concatenate(([True], (np.diff(item) != 0) | (np.diff(at) != 0) | (np.diff(of) != 0)))[: len(item)]
        return item[new], np.stack((at[new], of[new]))

    def matches(self, texts: pa.Array) -> list[list[tuple[int | None, int, float, int]]]:
        """For each text (item_id, edits, similarity, start) of each item with a match in it."""
        ids, bounds = self.numbered(texts)
        item, (at, place) = self._votes(ids)
        text = np.searchsorted(bounds, at, "right") - 1
        diagonal = at - place
        order = np.lexsort((diagonal, item, text))
        item, text, diagonal = item[order], text[order], diagonal[order]
        wide = 2 * (EDITS * self.lengths[item]).astype(np.int64) if len(item) else item
        # votes of a text and item on diagonals no further apart than ``wide`` belong together
        new = np.concatenate(([True], (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(diagonal) > wide[1:]))) if len(item) else np.zeros(0, bool)
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(item)))
        enough = sizes >= np.maximum(1, self.lengths[item[starts]] // VOTES) if len(starts) else starts
        best: list[dict[int, tuple[int, int]]] = [{} for _ in range(len(texts))]
        for s, n in zip(starts[enough].tolist(), sizes[enough].tolist()):
            k, t, d = int(item[s]), int(text[s]), diagonal[s : s + n]
            length, edits = int(self.lengths[k]), self.edits(k)
            low, high = int(bounds[t]), int(bounds[t + 1]) - 1
            window = ids[max(low, d[0] - edits) : min(high, d[-1] + length + edits)]
            key = (k, window.tobytes())
            if key not in self.verified:
                if len(self.verified) > 10_000:
                    self.verified.clear()
                self.verified[key] = least_edits(length, self.masks[k], window)
            e = self.verified[key]
            if e <= edits and (k not in best[t] or e < best[t][k][0]):
                values, counts = np.unique(d, return_counts=True)
                best[t][k] = e, max(0, int(values[counts.argmax()]) - low)
        return [[(self.names[k], e, 1 - e / len(self.items[k]), start) for k, (e, start) in sorted(found.items())] for found in best]


def _groups(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows, "items")
    groups = max(1, -(-rows.count() // ITEMS))
    for g in range(groups):
        found = rows.where(F.pmod(F.xxhash64("row"), F.lit(groups)) == g).select("item_id", "text").toArrow()
        yield list(zip(found["item_id"].to_pylist(), found["text"].to_pylist()))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The matches of ``docs`` (doc_id, text) with ``benchmark`` (item_id, text)."""
    spark, out = docs.sparkSession, None
    names, types = zip(*(c.split() for c in MATCH.split(", ")))
    arrow = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    for items in _groups(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            detector = Detector(shared.value)
            for part in (x for batch in batches for x in slices(batch, "text")):
                rows = [(d, *m) for d, found in zip(part.column("doc_id").to_pylist(), detector.matches(part.column("text"))) for m in found]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, arrow[t]) for c, t in zip(zip(*rows), types)], names)

        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(find, MATCH)
        out = found if out is None else out.unionByName(found)
    return out


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that match no item."""
    for items in _groups(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            detector = Detector(shared.value)
            for part in (x for batch in batches for x in slices(batch, "text")):
                yield part.filter(pa.array([not found for found in detector.matches(part.column("text"))], pa.bool_()))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
