"""Many checks of a table in one scan.

Checks that judge a row by itself, and checks of unique keys, are data: an SQL condition or a list of columns. All rules of a table are compiled into one
aggregate: each row goes out once for each condition that it breaks and once for each key, the conditions shrink to a few rows a task before
the shuffle, and keys are counted there. So a table is read once, whatever the number of its rules, and all tables make one job. Every
issue is counted; up to ``SAMPLES`` examples are kept, the smallest of as many hash classes, so a sample is the same in every run.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .runner import RESULT, SAMPLE_LENGTH

SAMPLES = 5
FOUND = "check_name string, issue_count long, details string"


@dataclass(frozen=True)
class Rule:
    """``bad``: rows for which this SQL condition is true are issues; or ``unique``: repeated values of these columns are, null keys too."""

    name: str
    table: str
    severity: str = "ERROR"
    bad: str = ""
    unique: tuple[str, ...] = ()
    show: tuple[str, ...] = ()
    stage: str = "silver"
    scope: str = "publication"


def _value(v) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(v, str) else repr(v)


def required(name: str, table: str, columns: list[str], valid: str = "true", **rest) -> Rule:
    nulls = " or ".join(f"`{c}` is null" for c in columns)
    return Rule(name, table, bad=f"({nulls}) or not coalesce({valid}, false)", **rest)


def accepted(name: str, table: str, column: str, values: list, **rest) -> Rule:
    """A null is accepted; ask for it with ``required``."""
    return Rule(name, table, bad=f"`{column}` not in ({', '.join(map(_value, values))})", **rest)


def in_order(name: str, table: str, start: str, end: str, strict: bool = False, **rest) -> Rule:
    return Rule(name, table, bad=f"`{end}` {'<=' if strict else '<'} `{start}`", **rest)


def implied(name: str, table: str, condition: str, then: str, **rest) -> Rule:
    return Rule(name, table, bad=f"coalesce({condition}, false) and not coalesce({then}, false)", **rest)


def unique(name: str, table: str, columns: list[str], **rest) -> Rule:
    return Rule(name, table, unique=tuple(columns), **rest)


def _text(columns, held: dict[str, str] | None = None) -> F.Column:
    """The columns' names and values; ``held``: the names under which the values lie."""
    at = held or {c: c for c in columns}
    shown = F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{at[c]}`").cast("string"), F.lit("<NA>"))) for c in columns))
    return F.substring(shown, 1, SAMPLE_LENGTH)


def _one_table(table: DataFrame, rules: list[Rule]) -> DataFrame:
    """Each row gives an entry for each condition that it breaks, with the hash class and text of a sample, and one for each key,
    with its values as they are: a key's entry is its values and a count and no more, and its text is made of them when they have been counted."""
    rows, keys = [r for r in rules if r.bad], [r for r in rules if r.unique]
    names = list(dict.fromkeys(c for r in keys for c in r.unique))
    kinds = {c: table.select(F.col(f"`{c}`")).schema[0].dataType.simpleString() for c in names}
    value = {c: F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in k or "variant" in k else F.col(f"`{c}`") for c, k in kinds.items()}  # others can be grouped
    held = {c: f"_k{i}" for i, c in enumerate(names)}

    def entry(rule: int, text: F.Column, columns: tuple[str, ...] = ()) -> F.Column:
        part = F.lit(-1) if columns else F.pmod(F.xxhash64(text), F.lit(SAMPLES)).cast("int")
        return F.struct(F.lit(rule).alias("rule"), part.alias("part"), text.alias("text"), *(F.when(F.lit(c in columns), value[c]).alias(h) for c, h in held.items()))

    sides = [F.when(F.coalesce(F.expr(r.bad), F.lit(False)), entry(i, _text(r.show or table.columns))) for i, r in enumerate(rows)]
    sides += [entry(i, F.lit(None).cast("string"), r.unique) for i, r in enumerate(keys, len(rows))]
    each = table.select(F.inline(F.array_compact(F.array(*sides))))
    groups = each.groupBy("rule", "part", *held.values()).agg(F.count("*").alias("n"), F.min("text").alias("text")).where("part >= 0 or n > 1")
    shown = F.col("text")
    for i, r in enumerate(keys, len(rows)):
        shown = F.when(F.col("rule") == i, _text(r.unique, held)).otherwise(shown)
    sampled = groups.select("rule", F.when(F.col("part") < 0, 1).otherwise(F.col("n")).alias("n"), shown.alias("text"))
    samples = [F.min(F.when(F.pmod(F.xxhash64("text"), F.lit(SAMPLES)) == k, F.col("text"))) for k in range(SAMPLES)]
    by = sampled.groupBy("rule").agg(F.sum("n").alias("issue_count"), F.array_join(F.array_compact(F.array(*samples)), " | ").alias("details"))
    # rules without issues have no row there
    every = table.sparkSession.createDataFrame([(i, r.name) for i, r in enumerate((*rows, *keys))], "rule int, check_name string")
    return every.join(F.broadcast(by), "rule", "left").select("check_name", F.coalesce("issue_count", F.lit(0)).cast("long").alias("issue_count"), F.coalesce("details", F.lit("")).alias("details"))


def _fault(table: DataFrame | None, rule: Rule) -> str | None:
    """Why a rule can't be asked: its table is missing, or its condition or columns don't fit."""
    if table is None:
        return f"missing tables: {rule.table}"
    try:
        table.select(F.expr(rule.bad or "true").cast("boolean"), *(F.col(f"`{c}`") for c in (*rule.unique, *rule.show)))
    except AnalysisException as e:
        return f"AnalysisException: {str(e)[:SAMPLE_LENGTH]}"
    return None


def fused(spark: SparkSession, rules: list[Rule], tables: dict[str, DataFrame]) -> DataFrame:
    """(check_name, issue_count, details) of all rules: as many scans as there are tables, one job. A rule that can't be asked is an issue of its own."""
    faults = {r.name: f for r in rules if (f := _fault(tables.get(r.table), r))}
    good: dict[str, list[Rule]] = {}
    for r in rules:
        if r.name not in faults:
            good.setdefault(r.table, []).append(r)
    parts = [_one_table(tables[t], rs) for t, rs in good.items()]
    parts.append(spark.createDataFrame([(n, 1, f) for n, f in faults.items()], FOUND))
    return reduce(DataFrame.unionByName, parts)


def fused_results(spark: SparkSession, rules: list[Rule], tables: dict[str, DataFrame]) -> DataFrame:
    """The outcome of all rules in the form of the check runner's results."""
    about = spark.createDataFrame([(r.name, r.scope, r.stage, r.severity) for r in rules], "check_name string, scope string, stage string, severity string")
    out = fused(spark, rules, tables).join(F.broadcast(about), "check_name")
    out = out.withColumns({"passed": F.col("issue_count") == 0, "duration_seconds": F.lit(0.0)})
    return out.select(*(c.split()[0] for c in RESULT.split(", ")))
