"""Check families. Each returns the offending rows; no rows means that the check passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.aggregates import multiple_values_per_key
from ..operators.incremental import repair_plan


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")


def required(df: DataFrame, columns: list[str], valid: Column | None = None, show: list[str] | None = None) -> DataFrame:
    """Rows where a column is null or ``valid`` doesn't hold."""
    bad = reduce(lambda a, c: a | F.col(c).isNull(), columns, F.lit(False))
    if valid is not None:
        bad = bad | ~F.coalesce(valid, F.lit(False))
    return df.where(bad).select(*(show or df.columns))


def ordered(df: DataFrame, start: str, end: str, strict: bool = False) -> DataFrame:
    """Rows whose end is before their start (or, strictly, not after it)."""
    return df.where(F.col(end) <= F.col(start) if strict else F.col(end) < F.col(start))


def orphans(child: DataFrame, parent: DataFrame, child_key: list[str], parent_key: list[str] | None = None) -> DataFrame:
    """Child rows without a parent; a null key has none and is no orphan."""
    p = parent.select(*(F.col(b).alias(a) for a, b in zip(child_key, parent_key or child_key))).distinct()
    return child.where(reduce(lambda a, c: a & F.col(c).isNotNull(), child_key, F.lit(True))).join(p, child_key, "left_anti")


def missing_downstream(upstream: DataFrame, downstream: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    u = upstream if where is None else upstream.where(where)
    return u.select(*keys).distinct().join(downstream.select(*keys).distinct(), keys, "left_anti")


def flag_vs_exists(df: DataFrame, flag: str, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose flag says otherwise than the other table."""
    found = other.select(*keys).distinct().withColumn("_found", F.lit(True))
    return df.join(found, keys, "left").where(~F.col(flag).eqNullSafe(F.col("_found").isNotNull())).select(*keys, flag, F.col("_found").isNotNull().alias("found"))


def count_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    counts = a.agg(F.count("*").alias("left_rows")).crossJoin(b.agg(F.count("*").alias("right_rows")))
    return counts.where("left_rows <> right_rows").withColumn("issue_count", F.abs(F.col("left_rows") - F.col("right_rows")))


def expected_count(expected: DataFrame, actual: DataFrame, keys: list[str]) -> DataFrame:
    return repair_plan(expected, actual, keys)


def column_matches(df: DataFrame, pairs: dict[str, Column], keys: list[str]) -> DataFrame:
    """Rows where a column differs from what is computed for it, with the names of such columns."""
    wrong = F.array_compact(F.array(*(F.when(~F.col(c).eqNullSafe(v), F.lit(c)) for c, v in pairs.items())))
    return df.select(*keys, wrong.alias("columns")).where(F.size("columns") > 0)


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(~F.coalesce(F.col(column).isin(*values), F.lit(False))).groupBy(column).agg(F.count("*").alias("issue_count"))


def version_current(df: DataFrame, column: str, current: str) -> DataFrame:
    return df.where(~F.col(column).eqNullSafe(F.lit(current))).groupBy(column).agg(F.count("*").alias("issue_count"))


def agrees(left: DataFrame, right: DataFrame, keys: list[str], pairs: dict[str, str]) -> DataFrame:
    """Rows of ``left`` whose columns differ from the columns of their row in ``right``, which may be missing."""
    r = right.select(*keys, *(F.col(b).alias(f"_{i}") for i, b in enumerate(pairs.values())))
    differs = reduce(lambda x, y: x | y, (~F.col(a).eqNullSafe(F.col(f"_{i}")) for i, a in enumerate(pairs)))
    return left.join(r, keys, "left").where(differs).select(*left.columns)


def implies(df: DataFrame, condition: Column, then: Column) -> DataFrame:
    return df.where(F.coalesce(condition, F.lit(False)) & ~F.coalesce(then, F.lit(False)))


def log_state(log: DataFrame, entity: str, wanted: str = "SUCCESS") -> DataFrame:
    """One row if the entity's latest run is not in the wanted state, or there is none."""
    last = log.where(F.col("entity") == entity).agg(F.max(F.struct("started_at", "status")).alias("l")).select(F.lit(entity).alias("entity"), F.col("l.status").alias("status"))
    return last.where(~F.col("status").eqNullSafe(F.lit(wanted)))


def recent_success(log: DataFrame, entity: str, as_of: str, days: int) -> DataFrame:
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    good = log.where((F.col("entity") == entity) & (F.col("status") == "SUCCESS") & (F.col("started_at") >= since)).agg(F.count("*").alias("successes"))
    return good.where("successes = 0").withColumn("entity", F.lit(entity))


def recent_failures(log: DataFrame, entities: list[str], as_of: str, days: int) -> DataFrame:
    since = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    return log.where(F.col("entity").isin(*entities) & (F.col("status") == "FAILED") & (F.col("started_at") >= since)).groupBy("entity").agg(F.count("*").alias("issue_count"))


def stale(log: DataFrame, entity: str, upstream: list[str]) -> DataFrame:
    from ..operators.incremental import up_to_date

    return up_to_date(log, entity, upstream).where("not is_current")


def coverage(counts: DataFrame, key: str, count: str, actual: DataFrame, durations: list[int], duration: str = "duration_seconds") -> DataFrame:
    """Expected (key, duration) rows, for durations up to the key's count, that are not there."""
    from ..operators.joins import range_expand

    return range_expand(counts.select(key, count), count, durations, duration).select(key, duration).join(actual.select(key, duration).distinct(), [key, duration], "left_anti")


def multi_source(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    return multiple_values_per_key(df, keys, value)


def domain_overlap(domains: dict[str, DataFrame], day: str) -> DataFrame:
    """A row for each day of any domain, and which domains have it."""
    union = reduce(lambda a, b: a.unionByName(b), (d.select(F.col(day).alias("day"), F.lit(n).alias("domain")).distinct() for n, d in domains.items()))
    has = [F.coalesce(F.bool_or(F.col("domain") == n), F.lit(False)).alias(f"has_{n}") for n in domains]
    return union.where("day is not null").groupBy("day").agg(*has)


def partial_coverage(domains: dict[str, DataFrame], day: str) -> DataFrame:
    """Days that some domains have and others lack."""
    everywhere = reduce(lambda a, n: a & F.col(f"has_{n}"), domains, F.lit(True))
    return domain_overlap(domains, day).where(~everywhere)


def no_overlap(domains: dict[str, DataFrame], day: str) -> DataFrame:
    """One row if no day is in all domains."""
    everywhere = reduce(lambda a, n: a & F.col(f"has_{n}"), domains, F.lit(True))
    return domain_overlap(domains, day).agg(F.count_if(everywhere).alias("shared_days")).where("shared_days = 0")


def unresolved_refs(df: DataFrame, column: str, known: DataFrame, known_key: str, attempts: DataFrame | None = None) -> DataFrame:
    """References that the other table lacks, with uses and the last attempt to look them up."""
    k = known.select(F.col(known_key).alias(column)).distinct()
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("uses")).join(k, column, "left_anti")
    if attempts is not None:
        out = out.join(attempts.groupBy(column).agg(F.max("attempted_at").alias("last_attempt")), column, "left")
    return out


def status_vs_data(df: DataFrame, status: str, data: DataFrame, key: str, since: tuple[str, str, int] | None = None) -> DataFrame:
    """(key, status, finding): SUCCESS without data, data without SUCCESS and, with ``since`` (column, as_of, days), stale PENDING."""
    found = data.select(key).distinct().withColumn("_d", F.lit(True))
    s, there = F.col(status), F.col("_d").isNotNull()
    finding = F.when((s == "SUCCESS") & ~there, "success_without_data").when((s == "NOT_FOUND") & there, "not_found_with_data").when(there & (s != "SUCCESS"), "data_without_success")
    if since:
        column, as_of, days = since
        finding = finding.when((s == "PENDING") & (F.col(column) < F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))), "stale_pending")
    return df.join(found, key, "left").select(key, status, finding.alias("finding")).where("finding is not null")


def index_continuity(df: DataFrame, key: str, index: str) -> DataFrame:
    """Keys whose indexes are no unbroken run, or repeat."""
    g = df.groupBy(key).agg(F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count(index).alias("rows"), F.count_distinct(index).alias("indexes"))
    return g.where("last_index - first_index + 1 <> indexes or rows <> indexes")


def parent_summary(child: DataFrame, parent: DataFrame, key: str, sums: dict[str, tuple[Column, str]], tolerance: float) -> DataFrame:
    """(key, name_children, name_parent, name_difference): sums of child rows that differ from the parent's value."""
    totals = child.groupBy(key).agg(*(F.sum(c).alias(f"{n}_children") for n, (c, _) in sums.items()))
    both = totals.join(parent.select(key, *(F.col(p).alias(f"{n}_parent") for n, (_, p) in sums.items())), key)
    both = both.withColumns({f"{n}_difference": F.abs(F.col(f"{n}_children") - F.col(f"{n}_parent")) for n in sums})
    return both.where(reduce(lambda a, b: a | b, (F.col(f"{n}_difference") > tolerance for n in sums)))


def outside_range(intervals: DataFrame, samples: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """Intervals that begin before their key's first sample or end after its last."""
    r = samples.groupBy(key).agg(F.min(at).alias("first_sample"), F.max(at).alias("last_sample"))
    return intervals.join(r, key).where((F.col(start) < F.col("first_sample")) | (F.col(end) - 1 > F.col("last_sample")))


def adjacent_boundaries(intervals: DataFrame, key: str, order: str, start: str, end: str) -> DataFrame:
    """How often the next interval starts by how much after the last one's end."""
    w = Window.partitionBy(key).orderBy(order)
    delta = F.lead(start).over(w) - F.col(end)
    return intervals.select(delta.alias("delta")).where("delta is not null and delta <> 0").groupBy("delta").agg(F.count("*").alias("issue_count"))


def first_index_distribution(df: DataFrame, key: str, index: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(index).alias("first_index")).groupBy("first_index").agg(F.count("*").alias("keys"))


def expected_tables(tables: dict[str, DataFrame], wanted: dict[str, list[str]], spark) -> DataFrame:
    """(table_name, column_name) that is wanted and not there; a missing table has one row without a column."""
    rows = [(t, None) for t in wanted if t not in tables] + [(t, c) for t, cs in wanted.items() if t in tables for c in cs if c not in tables[t].columns]
    return spark.createDataFrame(rows, "table_name string, column_name string")


def forbidden_names(tables: dict[str, DataFrame], pattern: str, spark) -> DataFrame:
    """Tables whose names look like leftovers of a run."""
    import re

    return spark.createDataFrame([(t,) for t in tables if re.search(pattern, t)], "table_name string")


def schema_contract(df: DataFrame, contract: list[dict], keys: list[str], spark) -> DataFrame:
    """(column_name, finding) of what differs from a contract: a list of name, type and nullable, in order."""
    want, have = {c["name"]: c for c in contract}, {f.name: f for f in df.schema.fields}
    rows = [(n, "missing") for n in want if n not in have] + [(n, "extra") for n in have if n not in want]
    rows += [(n, f"type is {have[n].dataType.simpleString()}, not {c['type']}") for n, c in want.items() if n in have and have[n].dataType.simpleString() != c["type"]]
    shared = [n for n in have if n in want]
    rows += [(n, "out of order") for n, m in zip(shared, [n for n in want if n in have]) if n != m]
    out = spark.createDataFrame(rows, "column_name string, finding string")
    must = [n for n, c in want.items() if n in have and not c.get("nullable", True)]
    if must:
        nulls = df.agg(*(F.count_if(F.col(n).isNull()).alias(n) for n in must)).select(F.explode(F.array(*(F.struct(F.lit(n).alias("column_name"), F.col(n).alias("rows")) for n in must))).alias("x"))
        out = out.unionByName(nulls.where("x.rows > 0").select("x.column_name", F.concat_ws(" ", F.col("x.rows").cast("string"), F.lit("nulls")).alias("finding")))
    if all(k in have for k in keys):
        repeated = unique_key(df, keys).agg(F.count("*").alias("n")).where("n > 0")
        out = out.unionByName(repeated.select(F.lit(",".join(keys)).alias("column_name"), F.concat_ws(" ", F.col("n").cast("string"), F.lit("repeated keys")).alias("finding")))
    return out


def payload_presence(df: DataFrame, payload: str, keys: list[str]) -> DataFrame:
    """Rows whose payload is missing or can't be read."""
    from ..functions.json import parse_state

    return df.select(*keys, parse_state(F.col(payload)).alias("state")).where("state <> 'ok'")


def checksum_matches(df: DataFrame, payload: str, checksum: str, keys: list[str]) -> DataFrame:
    return column_matches(df, {checksum: F.sha2(payload, 256)}, keys)


def coordinate_precision(df: DataFrame, text: str, digits: int, keys: list[str]) -> DataFrame:
    """Rows whose coordinate, as text, has fewer decimal places."""
    return df.where(F.col(text).isNotNull() & ~F.col(text).rlike(rf"^-?\d+\.\d{{{digits},}}$")).select(*keys, text)
