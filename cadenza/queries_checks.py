"""Queries of checks and reports that the other modules don't cover, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from .plans import reports
from .quality import fused as Q
from .queries import query, r

RULES = [
    Q.required("line_quantity", "lineitem", ["l_quantity"], "l_quantity > 2 and l_discount < 0.1", severity="CRITICAL", show=("l_orderkey", "l_linenumber")),
    Q.accepted("line_flag", "lineitem", "l_returnflag", ["A", "N"]),
    Q.implied("returned_is_final", "lineitem", "l_returnflag = 'R'", "l_linestatus = 'F'"),
    Q.unique("line_key", "lineitem", ["l_orderkey", "l_linenumber"], severity="CRITICAL"),
    Q.unique("line_part", "lineitem", ["l_orderkey", "l_partkey"], severity="WARNING"),
    Q.accepted("order_status", "orders", "o_orderstatus", ["F", "O"]),
    Q.unique("order_day", "orders", ["o_custkey", "o_orderdate"]),
    Q.required("event_value", "events", ["value"], "value >= 0"),
    Q.unique("event_id", "events", ["event_id"], severity="CRITICAL"),
]

RULES_SQL = """
SELECT 'line_quantity' AS check_name, count(*) AS issue_count FROM lineitem WHERE l_quantity IS NULL OR NOT coalesce(l_quantity > 2 AND l_discount < 0.1, false)
UNION ALL SELECT 'line_flag', count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL SELECT 'returned_is_final', count(*) FROM lineitem WHERE l_returnflag = 'R' AND NOT coalesce(l_linestatus = 'F', false)
UNION ALL SELECT 'line_key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'line_part', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)
UNION ALL SELECT 'order_status', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'order_day', count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey, o_orderdate HAVING count(*) > 1)
UNION ALL SELECT 'event_value', count(*) FROM events WHERE value IS NULL OR NOT coalesce(value >= 0, false)
UNION ALL SELECT 'event_id', count(*) FROM (SELECT 1 FROM events GROUP BY event_id HAVING count(*) > 1)
"""


@query(RULES_SQL)
def fused_checks(t):
    """Nine rules over three tables, each of which is scanned once; the samples are compared in the tests."""
    return Q.fused(t("orders").sparkSession, RULES, {n: t(n) for n in ("lineitem", "orders", "events")}).select("check_name", "issue_count")




def _runs(t):
    """Orders as runs: a customer is the entity."""
    return t("orders").select(F.col("o_custkey").alias("entity"), F.col("o_orderkey").alias("run_id"), F.col("o_orderdate").alias("started_at"), F.when(F.col("o_orderstatus") == "O", "RUNNING").otherwise("SUCCESS").alias("status"))


def _stage(t):
    """Lines as staged rows of their order's run."""
    return t("lineitem").select(F.col("l_orderkey").alias("run_id"), "l_linenumber", F.col("l_shipdate").cast("timestamp_ntz").alias("staged_at"))


@query("""
WITH r AS (SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
b AS (SELECT l_orderkey, count(*) FILTER (l_returnflag = 'R') AS f, sum(CAST(l_quantity AS BIGINT)) AS w, sum(l_linenumber) AS s FROM lineitem GROUP BY 1)
SELECT o_custkey AS entity, o_orderkey AS run_id, coalesce(f, 0) AS failed_batches, CAST(w AS BIGINT) AS rows_written, round(w / s, 4) AS rows_per_second FROM r LEFT JOIN b ON l_orderkey = o_orderkey
""")
def latest_transforms(t):
    batches = t("lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("l_quantity").cast("long").alias("rows_written"),
        F.col("l_linenumber").alias("duration_seconds"),
    )
    found = reports.latest_transforms(_runs(t), batches)
    return found.select("entity", "run_id", "failed_batches", "rows_written", r("rows_per_second"))


@query("""
SELECT l_orderkey AS run_id, count(*) AS rows, CAST(min(l_shipdate) AS VARCHAR) AS oldest, any_value(CASE WHEN o_orderkey IS NOT NULL THEN 'SUCCESS' END) AS run_status
FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderkey % 5 <> 0 WHERE o_orderkey IS NULL OR o_orderstatus <> 'O' GROUP BY 1
""")
def orphaned_stage(t):
    return reports.orphaned_stage(_stage(t), _runs(t).where("run_id % 5 <> 0")).withColumn("oldest", F.col("oldest").cast("string"))


@query("SELECT l_orderkey AS run_id, count(*) AS rows, CAST(min(l_shipdate) AS VARCHAR) AS oldest FROM lineitem WHERE l_shipdate < TIMESTAMP '1996-01-01' GROUP BY 1")
def old_stage(t):
    return reports.old_stage(_stage(t), "1996-01-02", 24).withColumn("oldest", F.col("oldest").cast("string"))


@query("SELECT l_orderkey AS run_id, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0)")
def without_runs(t):
    return reports.without_runs(_stage(t), _runs(t).where("run_id % 5 <> 0")).select("run_id", "l_linenumber")


@query("""
WITH d AS (SELECT p_partkey, p_size, p_brand FROM part WHERE p_partkey % 3 <> 0),
p AS (SELECT p_partkey, CASE WHEN p_size > 40 THEN p_size + 1 ELSE p_size END AS p_size, p_brand FROM part WHERE p_partkey % 4 <> 0)
SELECT code, k AS object_key, concat(k, ': ', code) AS message FROM (
  SELECT CAST(coalesce(d.p_partkey, p.p_partkey) AS VARCHAR) AS k,
    CASE WHEN p.p_partkey IS NULL THEN 'part_missing' WHEN d.p_partkey IS NULL THEN 'part_undeclared' ELSE 'part_differs' END AS code
  FROM d FULL JOIN p ON d.p_partkey = p.p_partkey
  WHERE p.p_partkey IS NULL OR d.p_partkey IS NULL OR d.p_size IS DISTINCT FROM p.p_size OR d.p_brand IS DISTINCT FROM p.p_brand)
""")
def tree_findings(t):
    part = t("part").select("p_partkey", "p_size", "p_brand")
    published = part.where("p_partkey % 4 <> 0").withColumn("p_size", F.when(F.col("p_size") > 40, F.col("p_size") + 1).otherwise(F.col("p_size")))
    return reports.tree_findings(part.where("p_partkey % 3 <> 0"), published, ["p_partkey"], ["p_size", "p_brand"], "part")


@query("SELECT l_orderkey AS activity_id, count(*) AS laps, count(DISTINCT l_linenumber) AS lap_indexes FROM lineitem GROUP BY 1 ORDER BY laps DESC, activity_id LIMIT 25")
def lap_grain(t):
    """The report of the most laps: its limit is what it is."""
    return reports.lap_grain(t("lineitem").select(F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("lap_index")), 25)


@query("""
SELECT child, status, count(*) AS activities FROM (
  SELECT unnest(['stream', 'details', 'laps']) AS child, unnest([o_orderstatus, o_orderpriority, CASE WHEN o_totalprice > 150000 THEN 'SUCCESS' END]) AS status FROM orders) GROUP BY 1, 2
""")
def raw_status(t):
    done = F.when(F.col("o_totalprice") > 150000, "SUCCESS")
    activities = t("orders").select(F.col("o_orderstatus").alias("stream_status"), F.col("o_orderpriority").alias("details_status"), done.alias("laps_status"))
    return reports.raw_status({"orders": t("orders")}, activities)[1]


@query("""
WITH a AS (SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'virtual' WHEN 1 THEN 'measured' WHEN 2 THEN 'estimated' WHEN 3 THEN 'unknown' END AS kind,
  CASE WHEN o_orderstatus = 'P' THEN 'ambiguous' ELSE 'clear' END AS status, CASE WHEN o_orderpriority = '1-URGENT' THEN 'manual_override' ELSE 'rule' END AS method,
  o_totalprice > 100000 AS ok FROM orders),
e AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_returnflag = 'R'), f AS (SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_quantity > 45)
SELECT a.id AS activity_id, CAST(coalesce(kind = 'virtual', false) AS INTEGER) AS is_virtual, CAST(coalesce(kind = 'measured', false) AS INTEGER) AS is_measured,
  CAST(coalesce(kind = 'estimated', false) AS INTEGER) AS is_estimated, CAST(coalesce(kind = 'unknown', false) AS INTEGER) AS is_unknown,
  CAST(status = 'ambiguous' AS INTEGER) AS is_ambiguous, CAST(contains(method, 'override') AS INTEGER) AS is_overridden,
  CAST(e.id IS NOT NULL AS INTEGER) AS has_power_efforts, CAST(f.id IS NOT NULL AS INTEGER) AS has_power_record,
  CAST(f.id IS NOT NULL AND NOT ok AS INTEGER) AS record_without_eligibility, CAST(ok AND e.id IS NULL AS INTEGER) AS eligible_without_efforts
FROM a LEFT JOIN e ON e.id = a.id LEFT JOIN f ON f.id = a.id
""")
def power_audit(t):
    o, m = t("orders"), F.col("o_orderkey") % 5
    activities = o.select(
        F.col("o_orderkey").alias("activity_id"),
        F.when(m == 0, "virtual").when(m == 1, "measured").when(m == 2, "estimated").when(m == 3, "unknown").alias("power_source_type"),
        F.when(F.col("o_orderstatus") == "P", "ambiguous").otherwise("clear").alias("power_source_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "manual_override").otherwise("rule").alias("power_classification_method"),
        (F.col("o_totalprice") > 100000).alias("is_power_record_eligible"),
    )
    lines = t("lineitem").withColumnRenamed("l_orderkey", "activity_id")
    efforts = lines.select("activity_id", F.when(F.col("l_returnflag") == "R", "watts").otherwise("heartrate_bpm").alias("metric_name"))
    facts = lines.select("activity_id", F.when(F.col("l_quantity") > 45, "power_best_effort").otherwise("longest_distance").alias("achievement_type"))
    return reports.power_audit(activities, efforts, facts)
