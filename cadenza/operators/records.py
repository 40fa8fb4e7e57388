"""Records kept up from a state: what later evaluations need of a history is a small part of its rows.

Whether a row is a record, what it beat and which row last reached its value depend on two kinds of earlier rows only: the first row with
the highest value, and rows that no later row equals or exceeds (the front). Of a key and month both are few, they can be
found in any split of the rows and merged again, and an evaluation over them and the new rows gives the new rows' records.

Rows without a date or a value take no part.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: A key's month is thinned in so many parts before these meet.
PARTS = 16


def _descending(order: list[str]) -> list:
    return [F.col(c).desc_nulls_last() for c in order]


def _front(rows: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    window = Window.partitionBy(*by)
    later = F.max(value).over(window.orderBy(*_descending(order)).rowsBetween(Window.unboundedPreceding, -1))
    best = F.row_number().over(window.orderBy(F.col(value).desc(), *(F.col(c).asc_nulls_first() for c in order)))
    return rows.withColumns({"_later": later, "_best": best}).where(F.col("_later").isNull() | (F.col(value) > F.col("_later")) | (F.col("_best") == 1)).drop("_later", "_best")


def fold(rows: DataFrame, key: list[str], order: list[str], value: str, date: str) -> DataFrame:
    """The state of ``rows``, or of a state and rows together: some of the rows, with their ``state_month``."""
    kept = rows.where(F.col(date).isNotNull() & F.col(value).isNotNull()).withColumn("state_month", F.trunc(date, "month"))
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS))
    kept = _front(kept.withColumn("_part", part), [*key, "state_month", "_part"], order, value).drop("_part")
    return _front(kept, [*key, "state_month"], order, value)


def month_start(date: dt.date | str) -> dt.date:
    return (dt.date.fromisoformat(str(date)[:10])).replace(day=1)


def before(state: DataFrame, start: dt.date | str) -> DataFrame:
    """The state's rows of the months before the one of ``start``."""
    return state.where(F.col("state_month") < F.lit(month_start(start)))


def appended(state: DataFrame, new: DataFrame, key: list[str], order: list[str], value: str, date: str) -> DataFrame:
    """The state after ``new`` rows, at any dates, none of them in it yet: only the months that they fall into are folded again."""
    months = new.where(F.col(date).isNotNull()).select(F.trunc(date, "month").alias("state_month")).distinct()  # as many as the new rows' months
    old = state.join(F.broadcast(months), "state_month", "left_semi").select(*new.columns)
    return state.join(F.broadcast(months), "state_month", "left_anti").unionByName(fold(old.unionByName(new), key, order, value, date))


def refolded(state: DataFrame, rows: DataFrame, start: dt.date | str, key: list[str], order: list[str], value: str, date: str) -> DataFrame:
    """The state after changes from ``start`` on: its month and later ones are folded from ``rows``, of which no others are read."""
    return before(state, start).unionByName(fold(rows.where(F.col(date) >= F.lit(month_start(start))), key, order, value, date))


def needed(state: DataFrame, rows: DataFrame, start: dt.date | str, date: str) -> DataFrame:
    """What an evaluation of the rows from ``start`` on has to read: the state before that month, and that month's and later rows."""
    return before(state, start).select(*rows.columns).unionByName(rows.where(F.col(date) >= F.lit(month_start(start))))


def year_records(rows: DataFrame, key: list[str], order: list[str], value: str, date: str) -> DataFrame:
    """Rows strictly above all earlier ones of their key and year, each with ``prior``: the latest earlier row (a struct of value
    and order columns) of at least its value, null if there is none.

    Nothing in a record's own year reaches it, so ``prior`` lies on the front of the latest earlier year whose maximum does; there it is the row
    with the smallest value that reaches. One window over all rows of a key and year finds records and fronts; what follows
    works on these alone, by windows, in which null keys are one key. Nothing is joined and no group meets itself.
    """
    kept = rows.where(F.col(date).isNotNull() & F.col(value).isNotNull()).withColumn("_year", F.year(date))
    window = Window.partitionBy(*key, "_year")
    earlier = F.max(value).over(window.orderBy(*(F.col(c).asc_nulls_first() for c in order)).rowsBetween(Window.unboundedPreceding, -1))
    later = F.max(value).over(window.orderBy(*_descending(order)).rowsBetween(Window.unboundedPreceding, -1))
    kept = kept.withColumns({"_earlier": earlier, "_later": later})
    above = lambda c: F.col(c).isNull() | (F.col(value) > F.col(c))
    kept = kept.withColumns({"_record": above("_earlier"), "_front": above("_later")}).where("_record or _front").drop("_earlier", "_later")
    # a key's earlier years with their maxima: as many as it has years
    top = F.max(F.when(F.col("_front"), F.col(value))).over(window)
    peak = F.when(F.col("_front") & (F.col(value) == top), F.struct(F.col("_year").alias("y"), F.col(value).alias("v")))
    kept = kept.withColumn("_peak", peak)
    older = F.collect_list("_peak").over(Window.partitionBy(*key).orderBy("_year").rangeBetween(Window.unboundedPreceding, -1))
    reached = F.array_max(F.transform(F.filter(older, lambda p: p["v"] >= F.col(value)), lambda p: p["y"]))
    kept = kept.withColumn("_target", F.when(F.col("_record"), reached)).drop("_peak")
    sides = F.array(F.struct(F.lit(False).alias("asks"), F.col("_year").alias("at"), F.col("_front").alias("takes")), F.struct(F.lit(True).alias("asks"), F.col("_target").alias("at"), F.col("_record").alias("takes")))
    both = kept.withColumn("_side", F.explode(sides)).where("_side.takes")
    held = F.when(~F.col("_side.asks"), F.struct(F.col(value).alias("value"), *(F.col(c).alias(c) for c in order)))
    reaching = Window.partitionBy(*key, "_side.at").orderBy(F.col(value).desc(), F.col("_side.asks")).rowsBetween(Window.unboundedPreceding, 0)
    prior = F.when(F.col("_side.at").isNotNull(), F.last(held, ignorenulls=True).over(reaching))
    return both.withColumn("prior", prior).where("_side.asks").select(*rows.columns, "prior")
