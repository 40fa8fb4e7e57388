"""Reports over raw, silver, gold, stage and log tables, and profiles of payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import parse_state
from ..functions.text import gear_name
from ..operators.aggregates import densify_daily, row_counts
from ..operators.stored import stored
from ..operators.windows import first_n_per_key, latest_per_key


def payload_fields(df: DataFrame, payload: str, row: str) -> DataFrame:
    """(row, path, type, is_null) of every field of an object, nested ones by dotted path; an array is one field.

    Level by level, until a level has no more objects. Each level is written, so a payload is parsed once, however deep it is.
    """
    level = stored(df.select(row, F.try_parse_json(payload).alias("_v"), F.lit("").alias("_p")).where(F.schema_of_variant("_v").startswith("OBJECT")), "level")
    out = None
    while out is None or not level.isEmpty():
        fields = level.lateralJoin(level.sparkSession.tvf.variant_explode(F.col("_v").outer()))
        kind = F.schema_of_variant("value")
        named = fields.select(row, F.concat(F.when(F.col("_p") == "", "").otherwise(F.concat("_p", F.lit("."))), "key").alias("path"), kind.alias("_k"), "value")
        simple = F.when(F.col("_k").startswith("OBJECT"), "object").when(F.col("_k").startswith("ARRAY"), "array").when(F.col("_k") == "VOID", "null").when(F.col("_k") == "STRING", "string").when(F.col("_k") == "BOOLEAN", "boolean").otherwise("number")
        found = named.select(row, "path", simple.alias("type"), (F.col("_k") == "VOID").alias("is_null"))
        out = found if out is None else out.unionByName(found)
        level = stored(named.where(F.col("_k").startswith("OBJECT")).select(row, F.col("value").alias("_v"), F.col("path").alias("_p")), "level")
    return out


def payload_coverage(df: DataFrame, payload: str, row: str) -> DataFrame:
    """(path, coverage_percent, types, null_frequency) over the rows whose payload can be read."""
    fields = payload_fields(df, payload, row)
    total = df.where(parse_state(F.col(payload)) == "ok").agg(F.count_distinct(row).alias("_total"))
    by_path = fields.groupBy("path").agg(F.count_distinct(row).alias("_rows"), F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"), F.avg(F.col("is_null").cast("double")).alias("null_frequency"))
    return by_path.crossJoin(F.broadcast(total)).select("path", (100.0 * F.col("_rows") / F.col("_total")).alias("coverage_percent"), "types", "null_frequency")


def nested_value(payload: Column, path: str, default: Column) -> Column:
    """The value at a dotted path as text, or the default."""
    return F.coalesce(F.try_variant_get(F.try_parse_json(payload), "$." + path, "string"), default)


def one_payload(df: DataFrame, payload: str, seed: int) -> DataFrame:
    """(key, value) of a payload drawn by seed."""
    one = df.where(parse_state(F.col(payload)) == "ok").orderBy(F.rand(seed)).limit(1)
    one = one.select(F.parse_json(payload).alias("_v"))
    return one.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer())).select("key", F.col("value").cast("string").alias("value"))


def gear_resolution(activities: DataFrame, gear: DataFrame) -> DataFrame:
    """Each gear id that activities refer to: its name for display, uses, and whether it is resolved."""
    g = gear.select("gear_id", F.col("gear_name").alias("_name"))
    uses = activities.groupBy("gear_id").agg(F.count("*").alias("activities"), F.max("start_date_local").alias("last_used"))
    return uses.join(g, "gear_id", "left").select("gear_id", gear_name(F.col("gear_id"), F.col("_name")).alias("display_name"), "activities", "last_used", F.col("_name").isNotNull().alias("is_resolved"))


def gear_history(observations: DataFrame) -> DataFrame:
    """The latest observation of each gear with first and last sight and whether it was ever current."""
    spans = observations.groupBy("gear_id").agg(F.min("first_observed_at").alias("first_seen_at"), F.max("last_observed_at").alias("last_seen_at"), F.bool_or("observed_in_current_collection").alias("was_current"))
    return latest_per_key(observations, ["gear_id"], ["last_observed_at"]).join(spans, "gear_id")


def excluded_against_eligible(efforts: DataFrame) -> DataFrame:
    """For each duration the best excluded and the best eligible power effort, and the difference in watts."""
    power = efforts.where("metric_name = 'watts'")
    best = lambda ok, name: first_n_per_key(power.where(F.col("is_record_eligible") == ok), ["duration_seconds"], [F.col("peak_value").desc(), F.col("activity_id")], 1).select("duration_seconds", F.col("activity_id").alias(f"{name}_activity_id"), F.col("peak_value").alias(f"{name}_watts"))
    both = best(False, "excluded").join(best(True, "eligible"), "duration_seconds", "full_outer")
    return both.withColumn("watt_difference", F.col("excluded_watts") - F.col("eligible_watts"))


def power_audit(activities: DataFrame, efforts: DataFrame, facts: DataFrame) -> DataFrame:
    """Each activity with flags that show where its classification needs a look."""
    has = lambda df, name: df.select("activity_id").distinct().withColumn(name, F.lit(True))
    a = activities.join(has(efforts.where("metric_name = 'watts'"), "_e"), "activity_id", "left").join(has(facts.where("achievement_type = 'power_best_effort'"), "_f"), "activity_id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    kind, eligible = F.col("power_source_type"), F.col("is_power_record_eligible")
    flags = {
        "is_virtual": kind == "virtual",
        "is_measured": kind == "measured",
        "is_estimated": kind == "estimated",
        "is_unknown": kind == "unknown",
        "is_ambiguous": F.col("power_source_status") == "ambiguous",
        "is_overridden": F.col("power_classification_method").contains("override"),
        "has_power_efforts": F.col("_e"),
        "has_power_record": F.col("_f"),
        "record_without_eligibility": F.col("_f") & ~eligible,
        "eligible_without_efforts": eligible & F.col("_e").isNull(),
    }
    return a.select("activity_id", *(flag(c).alias(n) for n, c in flags.items()))


def raw_status(tables: dict[str, DataFrame], activities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of each table, activities by child and status)."""
    children = ("stream", "details", "laps")
    pairs = F.array(*(F.struct(F.lit(c).alias("child"), F.col(f"{c}_status").alias("status")) for c in children))
    return row_counts(tables), activities.select(F.explode(pairs).alias("p")).groupBy("p.child", "p.status").agg(F.count("*").alias("activities"))


def latest_transforms(runs: DataFrame, batches: DataFrame) -> DataFrame:
    """The latest run of each entity with failed batches, rows and rows a second."""
    last = latest_per_key(runs, ["entity"], ["started_at", "run_id"])
    b = batches.groupBy("run_id").agg(F.count_if(F.col("status") == "FAILED").alias("failed_batches"), F.sum("rows_written").alias("rows_written"), F.sum("duration_seconds").alias("seconds"))
    return last.join(b, "run_id", "left").withColumn("rows_per_second", F.when(F.col("seconds") > 0, F.col("rows_written") / F.col("seconds"))).fillna(0, ["failed_batches"])


def orphaned_stage(stage: DataFrame, runs: DataFrame) -> DataFrame:
    """Staged rows by run whose run is unknown or no longer running."""
    r = runs.select("run_id", F.col("status").alias("_status"))
    return stage.groupBy("run_id").agg(F.count("*").alias("rows"), F.min("staged_at").alias("oldest")).join(r, "run_id", "left").where("_status is null or _status <> 'RUNNING'").withColumnRenamed("_status", "run_status")


def old_stage(stage: DataFrame, as_of: str, hours: int) -> DataFrame:
    return stage.where(F.col("staged_at") < F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(hours=F.lit(hours))).groupBy("run_id").agg(F.count("*").alias("rows"), F.min("staged_at").alias("oldest"))


def without_runs(stage: DataFrame, runs: DataFrame) -> DataFrame:
    return stage.join(runs.select("run_id").distinct(), "run_id", "left_anti")


def tree_findings(declared: DataFrame, published: DataFrame, keys: list[str], fields: list[str], name: str) -> DataFrame:
    """(code, object_key, message) of what differs between declared and published rows; no rows if nothing does."""
    d, p = declared.select(*keys, F.struct(*fields).alias("_d")), published.select(*keys, F.struct(*fields).alias("_p"))
    both = d.join(p, keys, "full_outer").where(~F.col("_d").eqNullSafe(F.col("_p")))
    code = F.when(F.col("_p").isNull(), f"{name}_missing").when(F.col("_d").isNull(), f"{name}_undeclared").otherwise(f"{name}_differs")
    return both.select(code.alias("code"), F.concat_ws("/", *keys).alias("object_key")).withColumn("message", F.concat_ws(": ", "object_key", "code"))


def recovery_against_work(recovery: DataFrame, measure: str, activities: DataFrame) -> DataFrame:
    """(day, series, value): a recovery measure and the work of each day, days without work being 0."""
    r = recovery.groupBy(F.col("activity_date").alias("day")).agg(F.avg(F.col(measure).cast("double")).alias("value")).select("day", F.lit(measure).alias("series"), "value")
    w = densify_daily(activities, "start_date_local", "energy_kilojoules").select("day", F.lit("work_kilojoules").alias("series"), F.col("value").cast("double").alias("value"))
    return r.unionByName(w)


def lap_grain(laps: DataFrame, n: int) -> DataFrame:
    """The activities with the most laps."""
    return laps.groupBy("activity_id").agg(F.count("*").alias("laps"), F.count_distinct("lap_index").alias("lap_indexes")).orderBy(F.col("laps").desc(), "activity_id").limit(n)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.csv(path, header=True)
