"""Keyed upserts and replacement of affected rows: old table and new rows in, new table out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def split_existing(data: DataFrame, existing_keys: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows to insert, rows to update)."""
    known = existing_keys.select(*keys).distinct()
    return data.join(known, keys, "left_anti"), data.join(known, keys, "left_semi")


def one_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """Of rows with equal keys the one with the largest remaining columns: which one doesn't depend on partitions."""
    rest = [c for c in source.columns if c not in keys]
    if not rest:
        return source.distinct()
    return source.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in rest)).select(*source.columns)


def merged(target: DataFrame, source: DataFrame, keys: list[str], touch_only: list[str] | None = None, insert_only: bool = False) -> DataFrame:
    """The merged table with ``action``: inserted, updated, unchanged or kept (not in ``source``).

    A matched row takes all of the source's values, nulls too. ``touch_only``: where all other columns
    agree, only these are advanced and the row counts as unchanged. ``insert_only``: matched rows stay. Null keys are equal, as in ``one_per_key``.
    """
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_t"))
    s = one_per_key(source.select(*target.columns), keys).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.struct(*rest).alias("_s"))
    both = t.join(s, reduce(lambda a, c: a & c, (same(t[k], s[f"_k{i}"]) for i, k in enumerate(keys))), "full_outer")
    both = both.select(*(F.coalesce(t[k], s[f"_k{i}"]).alias(k) for i, k in enumerate(keys)), "_t", "_s")
    compared = [c for c in rest if c not in (touch_only or [])]
    equal = reduce(lambda a, c: a & same(F.col(f"_t.{c}"), F.col(f"_s.{c}")), compared, F.lit(True))
    action = (
        F.when(F.col("_t").isNull(), "inserted").when(F.col("_s").isNull(), "kept").when(F.lit(insert_only) | equal, "unchanged").otherwise("updated")
    )
    row = F.when(F.col("_s").isNull() | (F.lit(insert_only) & F.col("_t").isNotNull()), F.col("_t")).otherwise(F.col("_s"))
    return both.withColumn("action", action).withColumn("_row", row).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest), "action").select(*target.columns, "action")


def upsert(target: DataFrame, source: DataFrame, keys: list[str], touch_only: list[str] | None = None, insert_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(table, counts by action)."""
    out = merged(target, source, keys, touch_only, insert_only)
    return out.drop("action"), out.groupBy("action").agg(F.count("*").alias("rows"))


def observation_upsert(target: DataFrame, source: DataFrame, keys: list[str], refine: dict[str, str], advance: list[str]) -> DataFrame:
    """Observations by content: a known one only advances ``advance``, and a column of ``refine`` that holds the
    given placeholder takes the source's value."""
    rest = [c for c in target.columns if c not in keys]
    t = target.select(*keys, F.struct(*rest).alias("_t"))
    s = one_per_key(source.select(*target.columns), keys).select(*keys, F.struct(*rest).alias("_s"))
    both = t.join(s, keys, "full_outer")

    def column(c: str) -> Column:
        old, new = F.col(f"_t.{c}"), F.col(f"_s.{c}")
        known = F.col("_t").isNotNull() & F.col("_s").isNotNull()
        value = F.when(F.col("_t").isNull(), new).otherwise(old)
        if c in advance:
            value = F.when(known, F.greatest(old, new)).otherwise(value)
        if c in refine:
            value = F.when(known & (old == refine[c]), new).otherwise(value)
        return value.alias(c)

    return both.select(*keys, *(column(c) for c in rest)).select(*target.columns)


def apply_status(df: DataFrame, updates: DataFrame, key: str, status: str, attempted: str | None = None) -> DataFrame:
    """``updates`` (key, status and, if given, attempted) overwrite the columns of the same names."""
    columns = [status] + ([attempted] if attempted else [])
    u = one_per_key(updates.select(key, *columns), [key]).select(key, *(F.col(c).alias(f"_u_{c}") for c in columns), F.lit(True).alias("_hit"))
    out = df.join(u, key, "left")
    return out.select(*(F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns))


def failed_from(ids: DataFrame, key: str, failed_at) -> DataFrame:
    """After a failed batch: its first id and all later ones are FAILED."""
    return ids.where(F.col(key) >= failed_at).select(key, F.lit("FAILED").alias("status"))


def pending(df: DataFrame, key: str, status: str, wanted: tuple[str, ...] = ("PENDING", "FAILED")) -> DataFrame:
    return df.where(F.col(status).isin(*wanted)).orderBy(key)


def replace_keys(existing: DataFrame, new: DataFrame, keys: list[str], affected: DataFrame) -> DataFrame:
    """The table with all rows of the affected keys replaced by ``new``."""
    return existing.join(affected.select(*keys).distinct(), keys, "left_anti").unionByName(new)


def tree_actions(declared: DataFrame, published: DataFrame, keys: list[str], fields: list[str], parent: list[str] | None = None) -> DataFrame:
    """(keys, action): inserted, updated, unchanged or deleted. With ``parent``, a published row is deleted only
    if its parent is declared."""
    d = one_per_key(declared.select(*keys, *fields), keys).select(*keys, F.struct(*fields).alias("_d"))
    p = published.select(*keys, F.struct(*fields).alias("_p"))
    both = d.join(p, keys, "full_outer")
    action = F.when(F.col("_p").isNull(), "inserted").when(F.col("_d").isNull(), "deleted").when(same(F.col("_d"), F.col("_p")), "unchanged").otherwise("updated")
    out = both.select(*keys, action.alias("action"))
    if parent:
        here = out.where("action <> 'deleted'")
        gone = out.where("action = 'deleted'").join(declared.select(*parent).distinct(), parent, "left_semi")
        out = here.unionByName(gone)
    return out


def append_only(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Append to a table that exists and has the same columns and types."""
    have = spark.read.parquet(path).schema
    plain = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    if plain(have) != plain(df.schema):
        raise ValueError(f"the table at {path} has other columns: {have.simpleString()} and not {df.schema.simpleString()}")
    df.write.mode("append").parquet(path)


def publish_staged(spark: SparkSession, rows: DataFrame, expected: DataFrame, keys: list[str], staging: str) -> DataFrame:
    """Write ``rows`` to ``staging`` and return them from there if each key has its expected number of rows.

    ``expected``: keys and expected_rows. The table a reader sees changes only when the caller points it to the
    new path, so a run that fails here leaves nothing behind but an unused folder.
    """
    rows.write.parquet(staging)
    staged = spark.read.schema(rows.schema).parquet(staging)
    counts = staged.groupBy(*keys).agg(F.count("*").alias("rows"))
    wrong = expected.join(counts, keys, "full_outer").where(~same(F.coalesce("rows", F.lit(0)), F.coalesce("expected_rows", F.lit(0).cast("long"))))
    bad = wrong.limit(5).toPandas()
    if len(bad):
        raise ValueError(f"staged rows differ from what was expected: {bad.to_dict('records')}")
    return staged
