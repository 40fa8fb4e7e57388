"""Running checks: counts and samples, outcome, stages and the publication gate."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Severities that fail a run, and the stages in their order.
FAILING = ("CRITICAL", "ERROR")
STAGES = ("preflight", "silver", "gold")
RESULT = "check_name string, scope string, stage string, severity string, passed boolean, issue_count long, details string, duration_seconds double"
SAMPLE_ROWS, SAMPLE_LENGTH = 5, 180
# Seconds for a check and for all, of the gate before publication and of the deep run.
LIMITS = {"publication": (60, 180), "deep": (900, 7200)}


@dataclass(frozen=True)
class Check:
    """find: tables -> offending rows; a column issue_count, if there, is summed instead of counting rows."""

    name: str
    severity: str
    find: Callable[[dict[str, DataFrame]], DataFrame]
    scope: str = "publication"
    stage: str = "silver"
    tables: tuple[str, ...] = ()


def measured(found: DataFrame) -> tuple[int, str]:
    """(issues, sample): everything is counted; the first rows are shown."""
    amount = F.coalesce(F.sum("issue_count"), F.lit(0)) if "issue_count" in found.columns else F.count("*")
    issues = int(found.agg(amount.alias("n")).first()["n"])
    if not issues:
        return 0, ""
    text = F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("<NA>"))) for c in found.columns))
    rows = found.select(F.substring(text, 1, SAMPLE_LENGTH).alias("t")).limit(SAMPLE_ROWS).collect()
    return issues, " | ".join(r["t"] for r in rows)


class TimedOut(Exception):
    """A check has passed its time limit; its jobs are cancelled."""


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Jobs started inside, broadcasts too, are cancelled after ``seconds``, again and again until the block ends, which raises ``TimedOut``."""
    if seconds is None:
        yield
        return
    sc, group, done, late = spark.sparkContext, f"limit-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        if not done.wait(max(0.0, seconds)):
            late.set()
            while not done.wait(0.1):
                sc.cancelJobGroup(group)

    before = sc.getLocalProperty("spark.jobGroup.id")
    sc.setJobGroup(group, "checks with a time limit", interruptOnCancel=True)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        yield
    except Exception as e:
        if late.is_set():
            raise TimedOut(f"TIMED_OUT after {seconds:.1f} s") from e
        raise
    finally:
        done.set()
        watcher.join()
        sc.setLocalProperty("spark.jobGroup.id", before)


def run_checks(
    spark: SparkSession,
    checks: list[Check],
    tables: dict[str, DataFrame],
    scope: str | None = None,
    stop: bool = True,
    per_check_seconds: float | None = None,
    overall_seconds: float | None = None,
) -> DataFrame:
    """A result row for each check of the scope, stage by stage; after a stage with a failing check the rest don't run.

    A check that raises is a failure with the error as its details. One that runs longer than ``per_check_seconds``, or than what is left of
    ``overall_seconds``, is cancelled and timed out; the next ones run, and those that the overall limit leaves no time for are timed out unrun.
    """
    rows, failed, ends = [], False, None if overall_seconds is None else time.monotonic() + overall_seconds
    for stage in STAGES:
        if failed and stop:
            break
        for c in (c for c in checks if c.stage == stage and scope in (None, c.scope)):
            began = time.monotonic()
            missing = [t for t in c.tables if t not in tables]
            limits = [x for x in (per_check_seconds, None if ends is None else ends - began) if x is not None]
            try:
                if limits and min(limits) <= 0:
                    raise TimedOut("TIMED_OUT: the overall limit was reached before the check")
                with time_limit(spark, min(limits, default=None)):
                    issues, details = (1, f"missing tables: {', '.join(missing)}") if missing else measured(c.find(tables))
            except TimedOut as e:
                issues, details = 1, str(e)
            except Exception as e:  # a broken check must show, not end the run
                issues, details = 1, f"{type(e).__name__}: {str(e)[:SAMPLE_LENGTH]}"
            rows.append((c.name, c.scope, stage, c.severity, issues == 0, issues, details, time.monotonic() - began))
            failed |= issues > 0 and c.severity in FAILING
    return spark.createDataFrame(rows, RESULT)


def outcome(results: DataFrame) -> DataFrame:
    """One row: TIMED_OUT, FAILED, PASSED_WITH_WARNINGS or PASSED, and failures by severity. A failing check counts more than one without an answer."""
    bad = ~F.col("passed")
    by = [F.count_if(bad & (F.col("severity") == s)).alias(f"{s.lower()}_failures") for s in ("CRITICAL", "ERROR", "WARNING", "INFO")]
    late = bad & F.col("details").startswith("TIMED_OUT")
    found = F.count_if(bad & ~late & F.col("severity").isin(*FAILING)).alias("_found")
    one = results.agg(F.count("*").alias("checks"), F.count_if(bad).alias("failures"), *by, found, F.count_if(late).alias("_late"))
    status = F.when(F.col("_found") > 0, "FAILED").when(F.col("_late") > 0, "TIMED_OUT").when(F.col("failures") > 0, "PASSED_WITH_WARNINGS").otherwise("PASSED")
    return one.withColumn("outcome", status).drop("_found", "_late")


def outcome_of_error(text: str) -> str:
    return "TIMED_OUT" if "time" in text.lower() and "out" in text.lower() else "FAILED"


def may_publish(results: DataFrame) -> bool:
    return outcome(results).first()["outcome"] not in ("FAILED", "TIMED_OUT")


def normalised(results: DataFrame) -> DataFrame:
    """Results from elsewhere in the form of RESULT: missing columns get their defaults."""
    defaults = {"scope": "publication", "stage": "silver", "severity": "WARNING", "details": "", "issue_count": 0, "duration_seconds": 0.0}
    out = results
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)) if c in out.columns else F.lit(v))
    if "passed" not in out.columns:
        out = out.withColumn("passed", F.col("issue_count") == 0)
    return out.select(*(F.col(c.split()[0]).cast(c.split()[1]) for c in RESULT.split(", ")))


def slowest(results: DataFrame, n: int) -> DataFrame:
    return results.orderBy(F.col("duration_seconds").desc(), "check_name").limit(n)


def log_results(results: DataFrame, run_id: int, path: str) -> None:
    results.withColumn("validation_run_id", F.lit(run_id).cast("long")).write.mode("append").parquet(path)
