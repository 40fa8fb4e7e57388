"""The daily run as one composition: raw tables in, silver and gold tables and the gate's verdict out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import incremental, records
from ..operators.tables import publish, published
from ..operators.upsert import replace_keys
from ..quality import gate as gates
from ..quality.runner import Check
from . import gold, silver


@dataclass(frozen=True)
class Raw:
    activities: DataFrame
    streams: DataFrame
    laps: DataFrame
    details: DataFrame
    gear: DataFrame
    runs: DataFrame


def saved(df: DataFrame, path: str) -> DataFrame:
    """Each layer is written and read again, so plans stay short and what follows reads columns, not queries."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_silver(raw: Raw, manual: DataFrame, overrides: DataFrame, gear_id: str, root: str) -> dict[str, DataFrame]:
    """All silver tables and the power control row, written under ``root``."""
    keep = lambda name, df: saved(df, f"{root}/{name}")
    evidence = keep("power_evidence", silver.power_evidence(raw.activities, raw.streams, raw.laps, raw.details))
    control = keep("power_source_classification", silver.power_cutover(silver.cutover_candidates(evidence, gear_id), manual))
    laps, rejects = silver.type_laps(raw.laps, raw.activities)
    tables = {
        "silver_activities": silver.silver_activities(silver.classify_power(evidence, control, overrides)),
        "silver_activity_streams": silver.widen_streams(raw.streams),
        "silver_activity_laps": laps,
        "silver_activity_laps_rejects": rejects,
        "silver_gear": silver.silver_gear(raw.gear, raw.runs),
    }
    return {n: keep(n, t) for n, t in tables.items()} | {"power_source_classification": control}


def build_gold(tables: dict[str, DataFrame], root: str, durations=gold.DURATIONS) -> dict[str, DataFrame]:
    """Everything evaluated anew, written under ``root``."""
    activities = tables["silver_activities"]
    efforts = saved(gold.activity_best_efforts(tables["silver_activity_streams"], activities, durations), f"{root}/gold_activity_best_efforts")
    sources = saved(gold.achievement_sources(efforts, activities, durations), f"{root}/achievement_sources")
    return {"gold_activity_best_efforts": efforts, "gold_activity_achievements": saved(gold.achievements(sources), f"{root}/gold_activity_achievements")}


def publish_gold(tables: dict[str, DataFrame], root: str, version: str, checks: list[Check], durations=gold.DURATIONS) -> dict[str, DataFrame]:
    """Everything evaluated anew and published, each table behind its gate: achievements are made from efforts that have passed theirs.
    If one is refused, readers keep the version before, and nothing after it is made."""
    spark, activities = tables["silver_activities"].sparkSession, tables["silver_activities"]
    out = dict(tables)

    def put(name: str, rows: DataFrame, names: tuple[str, ...]) -> None:
        publish(spark, rows, f"{root}/{name}", version, gate=gates.gate(name, checks, out, names))
        out[name] = published(spark, f"{root}/{name}")

    put("gold_activity_best_efforts", gold.activity_best_efforts(tables["silver_activity_streams"], activities, durations), gates.EFFORTS)
    sources = gold.achievement_sources(out["gold_activity_best_efforts"], activities, durations)
    put("gold_activity_achievements", gold.achievements(sources), gates.ACHIEVEMENTS + (gates.STATE if "activity_achievement_evaluation_state" in tables else ()))
    return {n: out[n] for n in ("gold_activity_best_efforts", "gold_activity_achievements")}


def update_efforts(existing: DataFrame, streams: DataFrame, activities: DataFrame, affected: DataFrame, durations=gold.DURATIONS) -> DataFrame:
    """The efforts table with the affected activities' rows computed again, from their samples alone."""
    part = streams.join(affected.select("activity_id").distinct(), "activity_id", "left_semi")
    return replace_keys(existing, gold.activity_best_efforts(part, activities, durations), ["activity_id"], affected)


def evaluation_state(sources: DataFrame) -> DataFrame:
    """The state from which achievements are kept up, of a whole history; written once, then updated."""
    return records.fold(sources, gold.RECORD_KEY, gold.RECORD_ORDER, "value", "activity_date")


def update_achievements(existing: DataFrame, sources: DataFrame, activities: DataFrame, plan: incremental.Plan, new_ids: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The facts after a day's changes, equal to those of a full evaluation.

    An append evaluates the new activities only; a closure all from the start date on; facts before it can't
    have changed, as a record depends on earlier activities only. With ``state``, that of the sources before the change, an
    append reads it and the new activities' sources, and a closure reads it and the sources from the start's month on.
    """
    if plan.mode == "no_change":
        return existing
    if plan.mode == "fallback":
        return gold.achievements(sources)
    if plan.mode == "latest_append":
        if state is not None:
            new = sources.join(new_ids.select("activity_id").distinct(), "activity_id", "left_semi").select(*sources.columns)
            sources = state.select(*sources.columns).unionByName(new)
        return replace_keys(existing, gold.achievements(sources, new_ids), ["activity_id"], new_ids)
    ids = activities.where(F.col("start_date_local") >= F.lit(plan.start_date)).select("activity_id")
    gone = existing.select("activity_id").distinct().join(activities.select("activity_id"), "activity_id", "left_anti")
    if state is not None:
        sources = records.needed(state, sources, plan.start_date, "activity_date")
    return replace_keys(existing, gold.achievements(sources, ids), ["activity_id"], ids.unionByName(gone))


def update_state(state: DataFrame, sources: DataFrame, plan: incremental.Plan, new_ids: DataFrame) -> DataFrame:
    """The state after the change that ``plan`` describes; ``sources`` are those after it."""
    how = (gold.RECORD_KEY, gold.RECORD_ORDER, "value", "activity_date")
    if plan.mode == "no_change":
        return state
    if plan.mode == "fallback":
        return evaluation_state(sources)
    if plan.mode == "latest_append":
        new = sources.join(new_ids.select("activity_id").distinct(), "activity_id", "left_semi").select(*sources.columns)
        return records.appended(state, new, *how)
    return records.refolded(state, sources, plan.start_date, *how)
