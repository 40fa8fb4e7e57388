"""Rolling best efforts, running records, and other ordered operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import LONGEST, apart, long_keys, ranked, with_halo


def latest_per_key(df: DataFrame, keys: list[str], order_desc: list[str]) -> DataFrame:
    """The row with the largest order of each key; a partial aggregate, so a hot key meets in one row a task."""
    columns = [c for c in df.columns if c not in keys]
    best = F.max(F.struct(*(F.col(c).alias(f"_{i}") for i, c in enumerate(order_desc)), *columns)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *(F.col("_best")[c].alias(c) for c in columns)).select(*df.columns)


def first_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """Spark keeps n rows a key and task before it moves them."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_n") <= n).drop("_n")


def adjacent_delta(df: DataFrame, key: str, order: list[str], end: str, start: str) -> DataFrame:
    """``delta``: the next row's start less this row's end; null for the last."""
    return df.withColumn("delta", F.lead(start).over(Window.partitionBy(key).orderBy(*order)) - F.col(end))


#: Values from here on count as missing: their sums would not be exact.
_TOO_LARGE = 1e18


def _zero() -> Column:
    return F.lit(0).cast("decimal(38,10)")


def _exact(column: str) -> Column:
    return F.when(F.abs(F.col(column).cast("double")) < _TOO_LARGE, F.col(column).cast("double").cast("decimal(28,10)"))


def _in_chunks(samples: DataFrame, key: str, order: list[str], halo: int, longest: int, work) -> DataFrame:
    """``work(rows, by, order)`` of all keys: whole keys in a window, those of more than ``longest`` rows in chunks with a halo.

    ``rows`` have ``_own``, false for a halo's rows; ``work`` ends in an aggregate of the key, in which its chunks meet.
    """
    hot = long_keys(samples, [key], longest)
    plain = lambda rows: work(rows.withColumn("_own", F.lit(True)), [key], order)
    if hot is None:
        return plain(samples)
    some, rest = apart(samples, hot, [key])
    chunked = with_halo(ranked(some, [F.col(key), *(F.col(c) for c in order)]), max(longest, halo + 1), halo)
    return work(chunked, ["_chunk", key], ["_rank"]).unionByName(plain(rest))


def best_efforts(samples: DataFrame, key: str, order: list[str], metrics: dict[str, str], durations: list[int], provenance: list[str] = (), longest: int = LONGEST) -> DataFrame:
    """The highest mean of each metric over exactly N rows in a row, for each key and N.

    A window of N rows counts only if all its N values are present; NaN and infinite values count as missing. Ties go to
    the first window. Sums and counts run over a key once; a window's are differences of two of these, so the cost
    is one sort whatever N is. Sums are of decimals with ten places, so they don't drift and equal windows tie; a
    value of 10**18 or more counts as missing. ``provenance`` columns are reported for the window's first and last row.
    A key of more than ``longest`` rows goes through several tasks, in chunks that begin with the N - 1 rows before them.

    Output: key, metric_name, duration_seconds, peak_value, start_<order>, end_<order>,
    start_<p> and end_<p> for each provenance column, sample_count.
    """
    fields = list(dict.fromkeys([*order, *provenance]))

    def peaks(rows: DataFrame, by: list[str], at: list[str]) -> DataFrame:
        ordered = Window.partitionBy(*by).orderBy(*at)
        upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.select(*dict.fromkeys([*by, *at, "_own"]), F.struct(*fields).alias("_place"), *(_exact(c).alias(f"_v_{m}") for m, c in metrics.items()))
        rows = rows.withColumn("_n", F.row_number().over(ordered))
        rows = rows.withColumns({f"_s_{m}": F.coalesce(F.sum(f"_v_{m}").over(upto), _zero()) for m in metrics} | {f"_c_{m}": F.count(f"_v_{m}").over(upto) for m in metrics})
        place = F.col("_rank") if at == ["_rank"] else F.col("_n").cast("long")
        found = []
        for n in durations:
            start = F.lag("_place", n - 1).over(ordered)
            for m in metrics:
                total = F.col(f"_s_{m}") - F.coalesce(F.lag(f"_s_{m}", n).over(ordered), _zero())
                valid = F.col(f"_c_{m}") - F.lag(f"_c_{m}", n, 0).over(ordered)
                whole = F.col("_own") & (F.col("_n") >= n) & (valid == n)
                found.append(F.when(whole, F.struct((total.cast("double") / n).alias("peak"), (-place).alias("first"), start.alias("start"), F.col("_place").alias("end"), F.lit(m).alias("metric"), F.lit(n).alias("n"))))
        # all durations and metrics come out of one pass; each task keeps one row for each of them and key
        best = rows.select(key, *(f.alias(f"_f{i}") for i, f in enumerate(found)))
        return best.groupBy(key).agg(*(F.max(f"_f{i}").alias(f"_f{i}") for i in range(len(found))))

    k = len(durations) * len(metrics)
    best = _in_chunks(samples, key, order, max(durations) - 1, longest, peaks)
    best = best.select(key, F.explode(F.array(*(F.col(f"_f{i}") for i in range(k)))).alias("_b")).where("_b is not null")
    return best.select(
        key,
        F.col("_b.metric").alias("metric_name"),
        F.col("_b.n").alias("duration_seconds"),
        F.col("_b.peak").alias("peak_value"),
        *(F.col(f"_b.start.{c}").alias(f"start_{c}") for c in fields),
        *(F.col(f"_b.end.{c}").alias(f"end_{c}") for c in fields),
        F.col("_b.n").alias("sample_count"),
    )


def normalised_power(samples: DataFrame, key: str, order: list[str], value: str, window: int = 30, longest: int = LONGEST) -> DataFrame:
    """key, samples, valid_samples, average, normalised, variability_index.

    ``normalised`` is the fourth root of the mean fourth power of the rolling mean over ``window`` rows, of windows whose values are all present (null
    without any); the index is its ratio to the plain mean. Values count as in ``best_efforts``, long keys are spread as there.
    """

    def sums(rows: DataFrame, by: list[str], at: list[str]) -> DataFrame:
        rolling = Window.partitionBy(*by).orderBy(*at).rowsBetween(1 - window, 0)
        rows = rows.withColumn("_v", _exact(value)).withColumns({"_s": F.sum("_v").over(rolling), "_c": F.count("_v").over(rolling)})
        power = F.pow(F.when(F.col("_c") == window, F.col("_s").cast("double") / window), 4)
        return rows.where("_own").groupBy(key).agg(F.count("*").alias("_n"), F.count("_v").alias("_valid"), F.sum("_v").alias("_sum"), F.count(power).alias("_windows"), F.sum(power).alias("_fourth"))

    found = _in_chunks(samples, key, order, window - 1, longest, sums)
    average = F.col("_sum").cast("double") / F.nullif(F.col("_valid"), F.lit(0))
    normalised = F.pow(F.col("_fourth") / F.nullif(F.col("_windows"), F.lit(0)), 0.25)
    out = found.select(key, F.col("_n").alias("samples"), F.col("_valid").alias("valid_samples"), average.alias("average"), normalised.alias("normalised"))
    return out.withColumn("variability_index", F.when(F.col("average") != 0, F.col("normalised") / F.col("average")))


def running_records(sources: DataFrame, key: list[str], order: list[str], value: str, date: str, year: bool = False) -> DataFrame:
    """Rows whose value is strictly above all earlier ones of their key (and, with ``year``, of their year).

    ``order`` ends in a unique column. The best earlier row comes along as ``previous`` (a struct of value and the order
    columns; the first one on ties; null for a first row).

    Keys are few where histories are long, so each key's years are worked on apart: within a year by a
    window, across years by a running maximum over one row a year.
    """
    rows = sources.withColumn("_year", F.year(date))
    ordered = Window.partitionBy(*key, "_year").orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_place", F.row_number().over(ordered))
    entry = F.struct(F.col(value).alias("value"), (-F.col("_year")).alias("_y"), (-F.col("_place")).alias("_p"), *order)
    rows = rows.withColumn("_entry", entry).withColumn("_before", F.max("_entry").over(earlier))
    if not year:
        years = rows.groupBy(*key, "_year").agg(F.max("_entry").alias("_best"))
        before_year = Window.partitionBy(*key).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
        years = years.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(key)), F.col("_year").alias("_ky"), F.max("_best").over(before_year).alias("_older"))
        on = F.col("_year").eqNullSafe(F.col("_ky"))
        for i, k in enumerate(key):
            on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
        rows = rows.join(years, on, "left").withColumn("_before", F.greatest("_before", "_older"))
    record = F.col("_before").isNull() | (F.col(value) > F.col("_before.value"))
    previous = F.when(F.col("_before").isNotNull(), F.struct(F.col("_before.value").alias("value"), *(F.col(f"_before.{c}").alias(c) for c in order)))
    return rows.where(record).select(*sources.columns, previous.alias("previous"))


def latest_prior_ge(records: DataFrame, history: DataFrame, key: list[str], order: list[str], value: str) -> DataFrame:
    """For each row of ``records``: ``prior``, the latest row of ``history`` before it with at least its value.

    ``order`` starts with a date or a timestamp. The row looked for lies in the record's own month or in the latest earlier
    month whose maximum reaches its value, so a record meets its key's monthly maxima and the rows of two months, not
    the key's whole history.
    """
    month = F.coalesce(F.trunc(order[0], "month"), F.lit("0001-01-01").cast("date"))
    h_key = [f"_k{i}" for i in range(len(key))]
    h = history.select(*(F.col(k).alias(h) for k, h in zip(key, h_key)), F.struct(*order).alias("_ho"), F.col(value).alias("_hv"), month.alias("_hm"))
    peaks = h.groupBy(*h_key, "_hm").agg(F.max("_hv").alias("_peak")).groupBy(*h_key).agg(F.collect_list(F.struct("_hm", "_peak")).alias("_peaks"))

    def on(names: list[str]) -> Column:
        return reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)))

    r = records.withColumns({"_id": F.struct(*order), "_m": month}).join(peaks, on(h_key), "left")
    reached = F.filter("_peaks", lambda p: (p["_hm"] < F.col("_m")) & (p["_peak"] >= F.col(value)))
    r = r.withColumn("_older", F.array_max(F.transform(reached, lambda p: p["_hm"]))).drop("_peaks", *h_key)
    asked = r.select(*key, "_id", F.col(value).alias("_v"), F.explode(F.array_distinct(F.array_compact(F.array("_m", "_older")))).alias("_m"))
    near = asked.join(h, on(h_key) & (F.col("_m") == F.col("_hm")) & (F.col("_hv") >= F.col("_v")) & (F.col("_ho") < F.col("_id")))
    near = near.groupBy(*key, "_id").agg(F.max(F.struct("_ho", "_hv")).alias("_near"))
    near = near.select(*(F.col(k).alias(f"_n{i}") for i, k in enumerate(key)), F.col("_id").alias("_nid"), "_near")
    prior = F.when(F.col("_near").isNotNull(), F.struct(F.col("_near._hv").alias("value"), *(F.col(f"_near._ho.{c}").alias(c) for c in order)))
    return r.join(near, on([f"_n{i}" for i in range(len(key))]) & (F.col("_id") == F.col("_nid")), "left").select(*records.columns, prior.alias("prior"))
