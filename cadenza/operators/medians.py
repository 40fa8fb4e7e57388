"""Exact running medians: for each row the number and the median of its key's earlier values.

A key of up to ``longest`` rows is one piece of work. Longer ones are ranked over all rows and cut into chunks of so many rows. While a chunk of x
values goes by, the median moves over at most x of the m values before it, those from rank (m - x) / 2 to (m + x) / 2: its band. Values are counted by
bins of ``longest`` distinct values; from the counts of the chunks before it a chunk learns which bins hold its band and how many values lie below them,
and these bins' values come to it, each once with its count so far. So a chunk's task holds its own rows and at most some four times as many values,
whatever the key's length, and equal values don't add up.

Within a task all medians are found together, bit by bit of the values' ranks, by array operations (a wavelet matrix); no Python runs for a row.

Null values don't count, but their rows get a median too; NaN counts as infinite. ``order`` should end in a unique column. The counts of
bins pass through one task a key, as a stream: one row a bin and chunk, not one a value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .chunks import apart, long_keys, ranked
from .stored import stored

LONGEST = 1 << 17
#: The rows of one bin go to so many tasks.
SALTS = 16


def kth(own: np.ndarray, base: np.ndarray, before: np.ndarray, k: np.ndarray) -> np.ndarray:
    """For each query the k-th smallest (from 0) of ``base``, counts by rank, and the first ``before`` of the ranks ``own``."""
    sums = np.concatenate(([0], np.cumsum(base)))
    left, right, low = np.zeros_like(before), before, np.zeros_like(before)
    for level in reversed(range(max(1, (len(base) - 1).bit_length()))):
        zero = (own >> level) & 1 == 0
        zeros = np.concatenate(([0], np.cumsum(zero)))
        zl, zr, middle = zeros[left], zeros[right], low + (1 << level)
        lower = zr - zl + sums[np.minimum(middle, len(base))] - sums[np.minimum(low, len(base))]
        up = k >= lower
        k = np.where(up, k - lower, k)
        left, right = np.where(up, zeros[-1] + left - zl, zl), np.where(up, zeros[-1] + right - zr, zr)
        low = np.where(up, middle, low)
        own = np.concatenate((own[zero], own[~zero]))
    return low


def prior_medians(starts: np.ndarray, values: np.ndarray, band: np.ndarray, counts: np.ndarray, below: int, earlier: int) -> tuple[np.ndarray, np.ndarray]:
    """(number, median) of the earlier values of each row's key; NaN for no value and no median.

    ``starts`` marks the first row of each key. The first key goes on from before: it had ``earlier`` values, of which ``below`` lie under
    the values of ``band``, which came ``counts`` times.
    """
    there = ~np.isnan(values)
    seen = np.cumsum(there) - there
    key = np.cumsum(starts) - 1
    first = seen[starts][key]
    prior = seen - first + np.where(key == 0, earlier, 0)
    keys, every = np.concatenate((key[there], np.zeros(len(band), np.int64))), np.concatenate((values[there], band))
    median = np.full(len(values), np.nan)
    asked = np.flatnonzero(prior > 0)
    if not len(asked):
        return prior, median
    order = np.lexsort((every, keys))
    new = np.concatenate(([True], (np.diff(keys[order]) != 0) | (every[order][1:] != every[order][:-1])))
    ranks = np.empty(len(every), np.int64)
    ranks[order] = np.cumsum(new) - 1
    own, base = ranks[: int(there.sum())], np.zeros(int(new.sum()), np.int64)
    base[ranks[len(own) :]] = counts
    skipped = np.where(key == 0, -below, first + counts.sum())[asked]  # values that lie under all of the key's, less those not at hand
    n = prior[asked]
    found = kth(own, base, np.tile(seen[asked], 2), np.concatenate(((n - 1) // 2 + skipped, n // 2 + skipped)))
    a, b = np.split(every[order][new][found], 2)
    median[asked] = np.where(a == b, a, 0.5 * a + 0.5 * b)
    return prior, median


def _with_medians(rows: pa.Table, band: pa.Table | None, columns: list[str]) -> pa.Table:
    keys = rows["_key"].combine_chunks()
    starts = np.concatenate(([True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))).astype(bool)
    values = pc.fill_null(rows["_v"], float("nan")).to_numpy()
    below = earlier = 0
    held, counts = np.zeros(0), np.zeros(0, np.int64)
    if band is not None and band.num_rows:
        told = band.filter(pc.is_valid(band["_earlier"]))
        below, earlier = told["_below"][0].as_py(), told["_earlier"][0].as_py()
        band = band.filter(pc.is_null(band["_earlier"]))
        held, counts = band["_value"].to_numpy(), band["_count"].to_numpy()
    prior, median = prior_medians(starts, values, held, counts, below, earlier)
    out = rows.select(columns)
    return out.append_column("prior", pa.array(prior, pa.int64())).append_column("prior_median", pa.array(median, pa.float64(), mask=np.isnan(median) & (prior == 0)))


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts by (key, chunk, bin), in order, to each bin's runs of chunks whose band it holds, and to what a chunk must know:
    (key, bin, from, to, null, null) and (key, null, chunk, chunk, below, earlier)."""
    names = ["_key", "_bin", "_from", "_to", "_below", "_earlier"]
    types = [pa.string(), *[pa.int64()] * 5]
    cells = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("_key", "_chunk", "_bin", "_n"))))

    def rows() -> Iterator[tuple]:
        for key, of_key in groupby(cells, key=itemgetter(0)):
            low, counts, opened, last = None, np.zeros(0, np.int64), {}, None
            for chunk, of_chunk in groupby(of_key, key=itemgetter(1)):
                bins, n = (np.array(c, np.int64) for c in zip(*((b, n) for _, _, b, n in of_chunk)))
                bins, n = bins[bins >= 0], n[bins >= 0]
                if last is not None:
                    m, x = int(counts.sum()), int(n.sum())
                    at, below = range(0), 0
                    if m:
                        sums = np.cumsum(counts)
                        lowest, highest = np.searchsorted(sums, [max(0, (m - x - 1) // 2), min(m - 1, (m + x) // 2)], "right").tolist()
                        at, below = range(low + lowest, low + highest + 1), int(sums[lowest] - counts[lowest])
                    yield key, None, chunk, chunk, below, m
                    for b in [b for b in opened if b not in at]:
                        yield key, b, opened.pop(b), last, None, None
                    for b in at:
                        opened.setdefault(b, chunk)
                if len(bins):
                    low = int(bins.min()) if low is None else low
                    under, over = max(0, low - int(bins.min())), max(0, int(bins.max()) - low - len(counts) + 1)
                    counts, low = np.pad(counts, (under, over)), low - under
                    np.add.at(counts, bins - low, n)
                last = chunk
            for b, since in opened.items():
                yield key, b, since, last, None, None

    out = []
    for row in rows():
        out.append(row)
        if len(out) == 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _bands(rows: DataFrame, longest: int) -> DataFrame:
    """(_chunk, _value, _count, null, null) for the values of each chunk's band and (_chunk, null, null, _below, _earlier)."""
    tied = rows.where("_v is not null").groupBy("_key", "_chunk", "_v").agg(F.count("*").alias("_n"))
    bins = ranked(tied.select("_key", "_v").distinct(), [F.col("_key"), F.col("_v")]).select("_key", "_v", F.floor(F.col("_rank") / longest).alias("_bin"))
    tied = stored(tied.join(bins, ["_key", "_v"]), "tied")
    cells = tied.groupBy("_key", "_chunk", "_bin").agg(F.sum("_n").alias("_n"))
    every = rows.groupBy("_key", "_chunk").agg(F.lit(-1).cast("long").alias("_bin"), F.lit(0).cast("long").alias("_n"))  # chunks without values too
    walked = cells.unionByName(every).repartition("_key").sortWithinPartitions("_key", "_chunk", "_bin")
    walked = stored(walked.mapInArrow(_walk, "_key string, _bin long, _from long, _to long, _below long, _earlier long"), "walked")
    told = walked.where("_bin is null").select(F.col("_from").alias("_chunk"), F.lit(None).cast("double").alias("_value"), F.lit(None).cast("long").alias("_count"), "_below", "_earlier")
    runs = walked.where("_bin is not null").select("_key", "_bin", "_from", "_to", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("_salt"))
    times = Window.partitionBy("_key", "_v").orderBy("_chunk")  # at most a row a chunk
    so_far = tied.withColumn("_count", F.sum("_n").over(times)).withColumn("_until", F.coalesce(F.lead("_chunk").over(times), F.lit((1 << 62))))
    met = so_far.withColumn("_salt", F.col("_chunk") % SALTS).join(runs.hint("merge"), ["_key", "_bin", "_salt"]).where("_from <= _until and _to > _chunk")
    chunk = F.explode(F.sequence(F.greatest(F.col("_chunk") + 1, "_from"), F.least("_until", "_to")))
    none = F.lit(None).cast("long")
    return met.select(chunk.alias("_at"), "_v", "_count").select(F.col("_at").alias("_chunk"), F.col("_v").alias("_value"), "_count", none.alias("_below"), none.alias("_earlier")).unionByName(told)


def running_median(df: DataFrame, key: list[str], order: list[str], value: str, longest: int = LONGEST) -> DataFrame:
    """``df`` with ``prior`` and ``prior_median``: number and median of the key's earlier values in ``order``."""
    columns = df.columns
    schema = StructType([*df.schema.fields, StructField("prior", LongType()), StructField("prior_median", DoubleType())])
    v = F.col(value).cast("double")
    keyed = df.withColumn("_key", F.to_json(F.struct(*key))).withColumn("_v", F.when(F.isnan(v), F.lit(float("inf"))).otherwise(v))
    hot = long_keys(keyed, ["_key"], longest)

    def whole_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Batches of whole keys, together no longer than two long keys."""
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= longest:
                rows = pa.Table.from_batches(held)
                cut = pc.index(rows["_key"], rows["_key"][-1]).as_py()
                if cut:
                    yield from _with_medians(rows.slice(0, cut), None, columns).to_batches()
                    held = rows.slice(cut).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield from _with_medians(pa.Table.from_batches(held), None, columns).to_batches()

    plain = lambda rows: rows.repartition("_key").sortWithinPartitions("_key", *order).mapInArrow(whole_keys, schema)
    if hot is None:
        return plain(keyed)
    some, rest = apart(keyed, hot, ["_key"])
    rows = ranked(some, [F.col("_key"), *(F.col(c) for c in order)]).withColumn("_chunk", F.floor(F.col("_rank") / longest))

    def filled(own: pa.Table, band: pa.Table) -> pa.Table:
        return _with_medians(own.sort_by("_rank"), band, columns)

    chunks = rows.groupBy("_chunk").cogroup(_bands(rows, longest).groupBy("_chunk")).applyInArrow(filled, schema)
    return chunks.unionByName(plain(rest))
