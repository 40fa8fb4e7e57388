"""Gates: what a transform has written is checked before readers get to see it.

A gate is called with the new version's rows, read from their files; it raises ``Refused`` if a failing check finds issues or gets no answer in time.
``operators.tables.publish`` asks it between the files and the pointer, so a refused version is an unused folder and the table stays what it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from .runner import LIMITS, Check, may_publish, run_checks

#: The checks that a transform's own rows must pass, by table; those of the evaluation state where it is kept.
EFFORTS = (
    "gold_best_efforts_duplicate_primary_key",
    "gold_best_efforts_peak_value_valid",
    "gold_best_efforts_window_indexes_valid",
    "gold_best_efforts_window_times_valid",
    "gold_best_efforts_sample_count_valid",
    "gold_activity_best_efforts_orphaned_activity_ids",
    "gold_activity_best_efforts_metric_names_valid",
    "gold_activity_best_efforts_calculation_version_current",
    "gold_activity_best_efforts_watts_eligibility_matches_silver",
    "gold_activity_best_efforts_non_watts_not_excluded",
    "gold_activity_best_efforts_exclusions_have_reason",
)
ACHIEVEMENTS = (
    "gold_activity_achievements_duplicate_business_key",
    "gold_activity_achievements_orphaned_activity_ids",
    "gold_activity_achievements_types_valid",
    "gold_activity_achievements_scopes_valid",
    "gold_activity_achievements_values_valid",
    "gold_activity_achievements_calculation_version_current",
    "gold_activity_achievements_power_eligible_only",
)
STATE = (
    "activity_achievement_evaluation_state_valid",
    "activity_achievement_evaluation_fact_count_reconciled",
    "activity_achievement_evaluation_state_complete_when_initialized",
    "achievement_facts_have_evaluation_state",
)


class Refused(Exception):
    """A version that may not be published. ``results``: the checks' result rows."""

    def __init__(self, table: str, results: list):
        self.results = results
        bad = [f"{r['check_name']}: {r['issue_count']} ({r['details']})" for r in results if not r["passed"]]
        super().__init__(f"{table} is not published; " + "; ".join(bad))


def gate(table: str, checks: list[Check], tables: dict[str, DataFrame], names: tuple[str, ...] | None = None, limits: tuple[float, float] | None = LIMITS["publication"]) -> Callable[[DataFrame], None]:
    """The gate of ``table`` by all ``checks``, or by those with ``names``, which then must be there. The other tables that
    checks read are ``tables``; one that lacks is an issue. ``limits``: seconds for a check and for all."""
    if names is not None:
        unknown = set(names) - {c.name for c in checks}
        if unknown:
            raise ValueError(f"no such checks: {sorted(unknown)}")
        checks = [c for c in checks if c.name in names]

    def ask(rows: DataFrame) -> None:
        each, whole = limits or (None, None)
        results = run_checks(rows.sparkSession, checks, tables | {table: rows}, stop=False, per_check_seconds=each, overall_seconds=whole)
        if not may_publish(results):
            raise Refused(table, results.collect())

    return ask
