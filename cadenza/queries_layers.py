"""Shapers, silver plans, invalidation, state and further checks on the given tables, with DuckDB SQL for the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import keys, text
from .operators import aggregates as A
from .operators import incremental as I  # noqa: E741
from .operators import reconcile as R
from .operators import upsert as U
from .plans import outbox, reports, silver
from .quality import families as V
from .queries import query, rounded
from .sources import shape

# --- responses, made from tables as JSON, to typed rows


@query("SELECT o_orderkey AS activity_id, o_orderpriority AS activity_name, round(o_totalprice, 2) AS distance, CAST(trunc(o_totalprice / 7) AS INTEGER) AS moving, CASE WHEN o_orderstatus = 'F' THEN TRUE WHEN o_orderstatus = 'O' THEN FALSE END AS device, 'PENDING' AS status FROM orders WHERE o_orderpriority <> '5-LOW'")
def shape_activities(t):
    device = F.when(F.col("o_orderstatus") == "F", True).when(F.col("o_orderstatus") == "O", False)
    one = F.struct(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("distance"), (F.col("o_totalprice") / 7).alias("moving_time"), device.alias("device_watts"))
    pages = t("orders").groupBy("o_custkey").agg(F.to_json(F.collect_list(one)).alias("payload"))
    good, _ = shape.activities(pages)
    return good.select("activity_id", "activity_name", rounded("distance_metres", 2).alias("distance"), F.col("moving_time_seconds").alias("moving"), F.col("is_device_watts").alias("device"), F.col("stream_status").alias("status"))


@query("SELECT o_orderdate AS day, count(*) AS rejected FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY 1")
def shape_activity_rejects(t):
    one = F.struct(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("name"))
    pages = t("orders").groupBy("o_orderdate").agg(F.to_json(F.collect_list(one)).alias("payload")).withColumnRenamed("o_orderdate", "retrieved_at")
    _, bad = shape.activities(pages)
    return bad.groupBy(F.col("retrieved_at").alias("day")).agg(F.count("*").alias("rejected"))


def _lines(t) -> DataFrame:
    return t("lineitem").groupBy(F.col("l_orderkey").alias("activity_id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity", "l_partkey", "l_suppkey"))).alias("a"))


@query("""
WITH l AS (SELECT l_orderkey AS activity_id, count(*) AS n, sum(l_quantity) AS q FROM lineitem GROUP BY 1)
SELECT activity_id, 'time' AS stream_type, 'time' AS series_type, CAST(n AS INTEGER) AS original_size, CAST(n AS INTEGER) AS samples FROM l
UNION ALL SELECT activity_id, 'watts', 'distance', CAST(n AS INTEGER), CAST(n AS INTEGER) FROM l
""")
def shape_streams(t):
    stream = lambda f, series: F.struct(F.transform("a", lambda x: x[f]).alias("data"), F.lit(series).alias("series_type"), F.size("a").alias("original_size"))
    responses = _lines(t).select("activity_id", F.to_json(F.struct(stream("l_linenumber", "time").alias("time"), stream("l_quantity", "distance").alias("watts"))).alias("payload"))
    return shape.streams(responses).select("activity_id", "stream_type", "series_type", "original_size", F.json_array_length("stream_payload").alias("samples"))


@query("SELECT l_orderkey AS activity_id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity, l_partkey, l_suppkey) AS INTEGER) AS lap_index, CAST(l_partkey AS BIGINT) AS part FROM lineitem")
def shape_laps(t):
    rows, _ = shape.laps(_lines(t).select("activity_id", F.to_json("a").alias("payload")))
    return rows.select("activity_id", "lap_index", F.get_json_object("lap_payload", "$.l_partkey").cast("long").alias("part"))


@query("SELECT p_partkey::VARCHAR AS gear_id, p_name AS gear_name, p_size > 25 AS is_primary, p_retailprice AS distance_metres, 'bike' AS gear_type FROM part WHERE p_size % 10 <> 0")
def shape_gear(t):
    one = F.struct(F.when(F.col("p_size") % 10 != 0, F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"), (F.col("p_size") > 25).alias("primary"), F.col("p_retailprice").alias("distance"))
    good, _ = shape.gear(t("part").select(F.to_json(one).alias("payload")), F.lit("bike"), F.lit(True))
    return good.select("gear_id", "gear_name", "is_primary", "distance_metres", "gear_type")


@query("SELECT CASE WHEN p_size > 25 THEN 'bike' ELSE 'shoes' END AS gear_type, p_partkey::VARCHAR AS gear_id FROM part")
def gear_collection(t):
    of = lambda c: F.filter(F.collect_list(F.when(c, F.struct(F.col("p_partkey").cast("string").alias("id")))), lambda x: x.isNotNull())
    athletes = t("part").groupBy("p_brand").agg(F.to_json(F.struct(of(F.col("p_size") > 25).alias("bikes"), of(F.col("p_size") <= 25).alias("shoes"))).alias("payload"))
    return shape.gear_collection(athletes).select("gear_type", F.get_json_object("payload", "$.id").alias("gear_id"))


@query("SELECT DISTINCT p_partkey::VARCHAR AS gear_id FROM part WHERE p_size > 25 UNION SELECT DISTINCT l_partkey::VARCHAR FROM lineitem WHERE l_tax > 0.05")
def referenced_gear(t):
    collection = t("part").where("p_size > 25").select(F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"))).alias("payload"))
    return shape.referenced_gear(collection, t("lineitem").where("l_tax > 0.05").select(F.col("l_partkey").cast("string").alias("gear_id")))


@query("""SELECT user_id, CAST(ts AS DATE) AS day, '{"pages":[' || string_agg(event_id::VARCHAR, ',' ORDER BY event_id) || ']}' AS heart_rate_payload, max(event_id) AS run_id FROM events GROUP BY 1, 2""", texts=("day",))
def heart_rate_days(t):
    e = t("events").select(F.lit(1).alias("source_id"), F.col("user_id").alias("fitbit_user_id"), F.to_date("ts").alias("activity_date"), F.lit("1min").alias("detail_level"), F.col("event_id").alias("page"), F.col("event_id").cast("string").alias("payload"), F.col("event_id").alias("run_id"), F.lit(None).alias("retrieved_at"))
    return shape.heart_rate_days(e).select(F.col("fitbit_user_id").alias("user_id"), F.col("activity_date").alias("day"), "heart_rate_payload", "run_id")


@query("SELECT CASE p WHEN 0 THEN 'fitbit' WHEN 1 THEN 'apple_health' WHEN 2 THEN 'google_fit' WHEN 3 THEN 'apple_health' WHEN 4 THEN 'fitbit' ELSE 'unknown' END AS e, count(*) AS rows FROM (SELECT p_size % 6 AS p FROM part) GROUP BY 1")
def source_ecosystems(t):
    k = F.col("p_size") % 6
    platform = F.when(k == 0, "fitbit").when(k == 1, "HEALTH_KIT").when(k == 2, "GOOGLE_FIT").otherwise("OTHER")
    maker = F.when(k == 3, "Apple Inc.").when(k == 4, "Fitbit").otherwise("Acme")
    return t("part").select(shape.ecosystem(platform, maker).alias("e")).groupBy("e").agg(F.count("*").alias("rows"))


# --- silver

LAPS = """WITH l AS (SELECT *, l_orderkey * 10 + l_linenumber AS id, count(*) FILTER (WHERE l_suppkey % 5 > 1) OVER (PARTITION BY l_orderkey * 10 + l_linenumber) AS n FROM lineitem)"""


def _lap_tables(t):
    l = t("lineitem")  # noqa: E741
    one = F.struct(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.struct(F.when(F.col("l_suppkey") % 5 == 0, F.lit(-1)).otherwise(F.col("l_orderkey")).alias("id")).alias("activity"),
        F.col("l_linenumber").alias("lap_index"),
        F.when(F.col("l_suppkey") % 5 == 1, "many").otherwise(F.col("l_quantity").cast("string")).alias("distance"),
        (F.col("l_quantity") * 2).alias("elapsed_time"),
    )
    raw = l.select(F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("lap_index"), F.to_json(one).alias("lap_payload"))
    return silver.type_laps(raw, t("orders").select(F.col("o_orderkey").alias("activity_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("start_datetime_utc")))


@query(LAPS + " SELECT id AS lap_id, l_orderkey AS activity_id, CAST(l_linenumber AS INTEGER) AS lap_index, l_quantity AS distance_metres, CAST(trunc(l_quantity * 2) AS INTEGER) AS elapsed_time_seconds FROM l WHERE n = 1 AND l_suppkey % 5 > 1")
def type_laps(t):
    return _lap_tables(t)[0].select("lap_id", "activity_id", "lap_index", "distance_metres", "elapsed_time_seconds")


@query(LAPS + ", v AS (SELECT id, count(*) AS n FROM lineitem2 GROUP BY 1) SELECT CASE WHEN l_suppkey % 5 = 0 THEN 'activity mismatch' WHEN l_suppkey % 5 = 1 THEN 'distance is not numeric' ELSE 'repeated lap id' END AS reject_reason, count(*) AS rows FROM l LEFT JOIN v USING (id) WHERE l_suppkey % 5 <= 1 OR v.n > 1 GROUP BY 1".replace("lineitem2", "(SELECT l_orderkey * 10 + l_linenumber AS id FROM lineitem WHERE l_suppkey % 5 > 1)"))
def type_lap_rejects(t):
    return _lap_tables(t)[1].groupBy("reject_reason").agg(F.count("*").alias("rows"))


@query("""
WITH o AS (SELECT o_custkey::VARCHAR AS gear_id, o_orderkey AS id, o_orderdate AS seen, extract(year FROM CAST(o_orderdate AS DATE)) AS run, o_orderstatus = 'F' AS cur FROM orders),
r AS (SELECT max(run) AS latest FROM o WHERE run % 2 = 0)
SELECT gear_id, max_by(id, {'a': seen, 'b': id}) AS gear_observation_id, CAST(min(seen) AS VARCHAR) AS first_seen_at, CAST(max(seen) AS VARCHAR) AS last_seen_at, coalesce(bool_or(run = latest AND cur), FALSE) AS is_current FROM o, r GROUP BY 1
""")
def silver_gear(t):
    o = t("orders").select(F.col("o_custkey").cast("string").alias("gear_id"), F.col("o_orderkey").alias("gear_observation_id"), F.col("o_orderdate").alias("first_observed_at"), F.col("o_orderdate").alias("last_observed_at"), F.year("o_orderdate").alias("run_id"), (F.col("o_orderstatus") == "F").alias("observed_in_current_collection"))
    runs = o.select("run_id", F.when(F.col("run_id") % 2 == 0, "SUCCESS").otherwise("FAILED").alias("status")).distinct()
    found = silver.silver_gear(o, runs)
    return found.select("gear_id", "gear_observation_id", F.col("first_seen_at").cast("string").alias("first_seen_at"), F.col("last_seen_at").cast("string").alias("last_seen_at"), "is_current")


EVIDENCE = """
WITH c AS (SELECT min(o_orderdate) + INTERVAL 900 DAY AS cut FROM orders),
e AS (SELECT o_orderkey AS activity_id, o_orderdate AS begun, o_custkey % 7 <> 0 AS usable, o_custkey % 5 = 0 AS app, o_custkey % 3 = 0 AS outdoor, CASE o_custkey % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE END AS device, CASE WHEN o_custkey % 11 = 0 THEN 'governed' END AS o, cut FROM orders, c)
"""


def _evidence(t):
    k = F.col("o_custkey")
    e = t("orders").select(
        F.col("o_orderkey").alias("activity_id"), F.col("o_orderdate").alias("start_datetime_utc"), (k % 7 != 0).alias("has_usable_power"), (k % 5 == 0).alias("is_trainer_app"), (k % 3 == 0).alias("is_outdoor_power_candidate"),
        F.when(k % 4 == 0, True).when(k % 4 == 1, False).when(k % 4 == 2, True).alias("is_device_watts"), k.alias("k"),
    )
    control = t("orders").agg((F.min("o_orderdate") + F.expr("INTERVAL 900 DAYS")).alias("effective_cutover_at")).withColumn("rule_version", F.lit("v9"))
    fields = ("power_source_type", "power_source_status", "is_measured_power", "is_power_record_eligible", "power_record_exclusion_reason", "power_classification_rule", "power_classification_method")
    values = {f: F.lit("governed") if not f.startswith("is_") else F.lit(True) for f in fields} | {"power_record_exclusion_reason": F.lit(None).cast("string")}
    overrides = e.where("k % 11 = 0 or k % 13 = 0").select("activity_id", (F.col("k") % 11 == 0).alias("is_active"), *(v.alias(f) for f, v in values.items()))
    return e, control, overrides


@query(EVIDENCE + """
SELECT activity_id,
  CASE WHEN o IS NOT NULL THEN o WHEN NOT usable THEN 'none' WHEN app AND begun < cut THEN 'virtual' WHEN outdoor AND device THEN 'measured' WHEN device AND begun >= cut THEN 'measured' WHEN device AND begun < cut THEN 'unknown' WHEN NOT coalesce(device, FALSE) AND usable THEN 'estimated' ELSE 'unknown' END AS power_source_type,
  CASE WHEN o IS NOT NULL THEN TRUE WHEN usable AND outdoor AND coalesce(device, FALSE) THEN TRUE WHEN usable AND coalesce(device, FALSE) AND begun >= cut THEN TRUE ELSE FALSE END AS is_power_record_eligible,
  CASE WHEN o IS NOT NULL THEN o WHEN NOT usable THEN 'no_usable_power' WHEN app AND begun < cut THEN 'trainerroad_virtual_power_before_roller_bike_power_cutover' WHEN app AND device AND begun >= cut THEN 'trainerroad_at_or_after_roller_bike_power_cutover'
    WHEN outdoor AND device AND begun < cut THEN 'outdoor_device_watts_before_cutover' WHEN outdoor AND device THEN 'outdoor_device_watts_gps_evidence' WHEN device AND begun >= cut THEN 'device_watts_at_or_after_power_meter_cutover' WHEN device AND begun < cut THEN 'pre_cutover_device_watts_ambiguous'
    WHEN NOT coalesce(device, FALSE) AND usable THEN 'strava_non_device_watts' ELSE 'unknown_power_source' END AS power_classification_rule,
  'v9' AS power_classification_version FROM e
""")
def classify_power(t):
    return silver.classify_power(*_evidence(t)).select("activity_id", "power_source_type", "is_power_record_eligible", "power_classification_rule", "power_classification_version")


@query("SELECT CAST(min(o_orderdate) AS VARCHAR) AS derived_cutover_at, min_by(o_orderkey, (o_orderdate, o_orderkey)) AS supporting_activity_id, '2001-01-01 00:00:00' AS effective_cutover_at FROM orders WHERE o_orderstatus = 'F'")
def power_cutover(t):
    candidates = t("orders").where("o_orderstatus = 'F'").select(F.col("o_orderdate").alias("start_datetime_utc"), F.col("o_orderkey").alias("activity_id"))
    manual = t("region").limit(1).select(F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias("manual_cutover_at"), F.lit("v1").alias("rule_version"))
    found = silver.power_cutover(candidates, manual)
    return found.select(F.col("derived_cutover_at").cast("string").alias("derived_cutover_at"), "supporting_activity_id", F.col("effective_cutover_at").cast("string").alias("effective_cutover_at"))


@query("SELECT o_orderkey, round(o_totalprice / 1000, 6) AS km, round(o_totalprice / 1609.344, 6) AS miles, round(o_custkey * CAST(3.6 AS DOUBLE), 6) AS kmh, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def silver_activities(t):
    o = t("orders").select(F.col("o_orderkey"), F.lit("Ride").alias("sport_type"), F.col("o_totalprice").alias("distance_metres"), F.col("o_custkey").cast("double").alias("average_speed_metres_per_second"), F.col("o_orderdate").cast("timestamp_ntz").alias("start_datetime_local"), F.lit("").alias("raw_payload"), F.lit("").alias("source_identity_text"))
    s = silver.silver_activities(o)
    return s.select("o_orderkey", rounded("distance_kilometres", 6).alias("km"), rounded("distance_miles", 6).alias("miles"), rounded("average_speed_kilometres_per_hour", 6).alias("kmh"), F.col("start_date_local").cast("string").alias("day"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax > 0.06 THEN 'no_lap_power' WHEN l_returnflag = 'A' THEN 'missing_canonical_context' WHEN l_suppkey % 5 = 0 THEN 'source_assertion_missing'
  WHEN l_linestatus = 'F' AND (l_quantity <= 25 OR l_discount <= 0.05) THEN 'governed_override' WHEN l_linestatus <> 'F' AND l_quantity > 25 THEN 'potential_inconsistency' ELSE 'expected' END AS provenance FROM lineitem
""")
def lap_provenance(t):
    known = F.when(F.col("l_returnflag") != "A", "x")
    power, device = F.when(F.col("l_tax") <= 0.06, 1.0), F.when(F.col("l_suppkey") % 5 != 0, F.col("l_linestatus") == "F")
    found = silver.lap_power_provenance(power, device, (known, known, F.col("l_quantity") > 25, F.col("l_discount") > 0.05))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.when(found.startswith("expe"), "expected").otherwise(found).alias("provenance"))


# --- evaluation state and what to compute again

STATE = "WITH b AS (SELECT c_custkey AS k, CAST(DATE '2020-01-01' + CAST(c_nationkey AS INTEGER) AS DATE) AS day FROM customer), s AS (SELECT c_custkey AS k, CASE c_custkey % 3 WHEN 0 THEN 'CURRENT' ELSE 'INVALIDATED' END AS evaluation_status, CASE WHEN c_custkey % 7 = 0 THEN ' ' ELSE 'sig' || (c_custkey % 2) END AS input_signature, 10 AS achievement_count FROM customer WHERE c_custkey % 5 <> 0), f AS (SELECT o_custkey AS k, count(*) AS facts FROM orders GROUP BY 1)"


def _state(t):
    c = t("customer").withColumnRenamed("c_custkey", "k")
    base = c.select("k", F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey").cast("int")).alias("day"))
    state = c.where("k % 5 <> 0").select("k", F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey").cast("int")).alias("day"), F.when(F.col("k") % 3 == 0, "CURRENT").otherwise("INVALIDATED").alias("evaluation_status"), F.when(F.col("k") % 7 == 0, " ").otherwise(F.concat(F.lit("sig"), (F.col("k") % 2).cast("string"))).alias("input_signature"), F.lit(10).alias("achievement_count"))
    return base, state, t("orders").select(F.col("o_custkey").alias("k"))


@query(STATE + " SELECT count(*) AS rows, count(*) FILTER (WHERE evaluation_status = 'CURRENT') AS current, count(*) FILTER (WHERE evaluation_status = 'INVALIDATED') AS invalidated, count(*) FILTER (WHERE evaluation_status IS NULL) AS missing FROM b LEFT JOIN s USING (k)")
def state_summary(t):
    base, state, _ = _state(t)
    return I.state_summary(base, state, "k")


@query(STATE + """ SELECT * FROM (SELECT k, CASE WHEN evaluation_status IS NULL THEN 'missing' WHEN evaluation_status = 'INVALIDATED' THEN 'invalidated' WHEN trim(input_signature) = '' THEN 'blank_signature' WHEN coalesce(facts, 0) <> achievement_count THEN 'count_mismatch' END AS reason
FROM b LEFT JOIN s USING (k) LEFT JOIN f USING (k)) WHERE reason IS NOT NULL""")
def evaluation_debt(t):
    base, state, facts = _state(t)
    return I.evaluation_debt(base.select("k"), state.drop("day"), facts, "k")


@query(STATE + " SELECT * FROM (SELECT k, CASE WHEN evaluation_status IS NULL THEN 'missing' WHEN input_signature <> 'sig0' THEN 'changed' WHEN evaluation_status <> 'CURRENT' THEN 'not_current' END AS reason FROM b LEFT JOIN s USING (k)) WHERE reason IS NOT NULL")
def signature_mismatch(t):
    base, state, _ = _state(t)
    return I.signature_mismatch(base.select("k", F.lit("sig0").alias("sig")), state, "k")


@query(STATE + " SELECT k, evaluation_status, CASE WHEN c THEN 'INVALIDATED' ELSE evaluation_status END AS new_status, CASE WHEN c THEN 'DATE_CHANGE' END AS invalidation_reason FROM (SELECT s.*, b.day >= DATE '2020-01-10' AS c FROM s JOIN b USING (k))")
def invalidate_state(t):
    _, state, _ = _state(t)
    found = I.invalidate(state.withColumns({"invalidation_reason": F.lit(None).cast("string"), "old": F.col("evaluation_status")}), "day", "2020-01-10", "DATE_CHANGE")
    return found.select("k", F.col("old").alias("evaluation_status"), F.col("evaluation_status").alias("new_status"), "invalidation_reason")


@query(STATE + " SELECT k, day FROM b WHERE day >= DATE '2020-01-12'", texts=("day",))
def historical_closure(t):
    return I.closure(_state(t)[0], "day", "k", "2020-01-12")


@query(STATE + " SELECT DISTINCT k FROM f WHERE k NOT IN (SELECT k FROM b WHERE day < DATE '2020-01-15')")
def orphan_facts(t):
    base, _, facts = _state(t)
    return I.orphan_facts(facts, base.where("day < '2020-01-15'"), "k")


@query(STATE + " SELECT k, CAST(coalesce(facts, 0) AS INTEGER) AS achievement_count, 'CURRENT' AS evaluation_status FROM b LEFT JOIN f USING (k)")
def state_rows(t):
    base, _, facts = _state(t)
    return I.state_rows(base.select("k"), facts, "k")


CANDIDATES = "WITH b AS (SELECT c_custkey AS k FROM customer), f AS (SELECT o_custkey AS k, max(o_orderdate) AS f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), e AS (SELECT o_custkey AS k, max(o_orderdate) AS e FROM orders WHERE o_orderstatus = 'O' GROUP BY 1), x AS (SELECT k FROM b LEFT JOIN f USING (k) LEFT JOIN e USING (k) WHERE f IS NULL OR e > f)"


def _candidates(t):
    o = t("orders").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("computed_at"), "o_orderstatus")
    return I.candidates(t("customer").select(F.col("c_custkey").alias("k")), o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), "k", "day", "conservative")


@query(CANDIDATES + " SELECT k FROM x")
def evaluation_candidates(t):
    return _candidates(t)


@query(CANDIDATES + ", y AS (SELECT k FROM b WHERE k % 2 = 0) SELECT k, 'only_first' AS side FROM x WHERE k NOT IN (SELECT k FROM y) UNION ALL SELECT k, 'only_second' FROM y WHERE k NOT IN (SELECT k FROM x)")
def candidate_audit(t):
    return I.candidate_audit(_candidates(t), t("customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k")), "k")


@query("WITH r AS (SELECT DISTINCT l_partkey AS k FROM lineitem), o AS (SELECT p_partkey AS k FROM part WHERE p_size < 20), a AS (SELECT l_partkey AS k, max(l_shipdate) AS m FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT k FROM r LEFT JOIN a USING (k) WHERE k NOT IN (SELECT k FROM o) AND (m IS NULL OR m < TIMESTAMP '2001-03-01' - INTERVAL 30 DAY)")
def lookups_due(t):
    l = t("lineitem").select(F.col("l_partkey").alias("k"), F.col("l_shipdate").cast("timestamp_ntz").alias("attempted_at"), "l_returnflag")  # noqa: E741
    return I.lookups_due(l.select("k"), t("part").where("p_size < 20").select(F.col("p_partkey").alias("k")), l.where("l_returnflag = 'R'"), "k", "2001-03-01", 30)


@query("SELECT p_partkey, CASE WHEN p_size > 40 THEN 'already_populated' WHEN p_size > 30 THEN 'unparseable' WHEN p_size > 20 THEN 'unknown_source' ELSE 'update' END AS action, CASE WHEN p_size > 40 THEN 'x' WHEN p_size <= 20 THEN p_brand END AS filled FROM part")
def backfill_actions(t):
    rows = t("part").withColumn("filled", F.when(F.col("p_size") > 40, "x"))
    state = F.when(F.col("p_size") > 30, "invalid").otherwise("ok")
    return I.backfill_actions(rows, {"filled": F.col("p_brand")}, state, F.col("p_size") > 20).select("p_partkey", "action", "filled")


HALF = "WITH a AS (SELECT p_partkey AS k, p_size AS v FROM part WHERE p_partkey % 10 <> 0), n AS (SELECT p_partkey AS k, CASE WHEN p_partkey % 4 = 0 THEN p_size + 1 ELSE p_size END AS v FROM part WHERE p_partkey % 3 <> 0)"


def _halves(t):
    p = t("part").select(F.col("p_partkey").alias("k"), F.col("p_size").alias("v"))
    return p.where("k % 10 <> 0"), p.where("k % 3 <> 0").withColumn("v", F.when(F.col("k") % 4 == 0, F.col("v") + 1).otherwise(F.col("v")))


@query(HALF + " SELECT count(*) FILTER (WHERE a.k IS NULL) AS inserted, count(*) FILTER (WHERE a.v <> n.v) AS updated, count(*) FILTER (WHERE a.v = n.v) AS unchanged FROM n LEFT JOIN a USING (k)")
def publish_counts(t):
    before, after = _halves(t)
    return I.publish_counts(before, after, "k", ["v"])


@query(HALF + " SELECT k FROM a FULL JOIN n USING (k) WHERE a.v IS DISTINCT FROM n.v")
def changed_outputs(t):
    return I.changed_outputs(*_halves(t), "k", ["v"])


@query(HALF + ", g AS (SELECT DISTINCT k % 100 AS g FROM n WHERE v > 45) SELECT k, v FROM a WHERE k % 100 NOT IN (SELECT g FROM g) UNION ALL SELECT k, v FROM n WHERE k % 100 IN (SELECT g FROM g)")
def replace_affected(t):
    before, after = (d.withColumn("g", F.col("k") % 100) for d in _halves(t))
    hit = after.where("v > 45").select("g").distinct()
    return U.replace_keys(before, after.join(hit, "g", "left_semi").select("k", "v", "g"), ["g"], hit).select("k", "v")


@query(HALF + " SELECT k, v, 'PENDING' AS status FROM a WHERE k >= 50 AND k % 2 = 0 UNION ALL SELECT k, v, 'FAILED' FROM a WHERE k >= 50 AND k % 2 <> 0")
def failed_batch(t):
    rows = _halves(t)[0].where("k >= 50").withColumn("status", F.lit("PENDING"))
    failed = U.failed_from(rows.where("k % 2 <> 0").select("k"), "k", 50)
    return U.apply_status(rows, failed, "k", "status").select("k", "v", "status")


@query("SELECT l_orderkey AS k, CAST(coalesce(n, 0) AS BIGINT) AS expected_rows FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' AND l_tax > 0.04 GROUP BY 1) USING (l_orderkey)")
def affected_plan(t):
    l = t("lineitem").withColumnRenamed("l_orderkey", "k")  # noqa: E741
    return I.affected_plan(l.where("l_returnflag = 'R'"), l.where("l_linestatus = 'F' and l_tax > 0.04").groupBy("k").agg(F.count("*").alias("expected_rows")), "k")


LOG = "WITH g AS (SELECT event_type AS entity, ts AS started_at, ts + INTERVAL 1 HOUR AS ended_at, CASE WHEN value > 30 THEN 'FAILED' ELSE 'SUCCESS' END AS status FROM events)"


def _log(t):
    e = t("events").select(F.col("event_type").alias("entity"), F.col("ts").cast("timestamp_ntz").alias("started_at"), F.when(F.col("value") > 30, "FAILED").otherwise("SUCCESS").alias("status"))
    return e.withColumn("ended_at", F.col("started_at") + F.expr("INTERVAL 1 HOUR"))


@query(LOG + ", d AS (SELECT max(ended_at) FILTER (WHERE status = 'SUCCESS' AND entity = 'click') AS a, max(ended_at) FILTER (WHERE status = 'SUCCESS' AND entity IN ('view', 'purchase')) AS b FROM g) SELECT CAST(a AS VARCHAR) AS downstream, CAST(b AS VARCHAR) AS upstream, coalesce(a >= b, FALSE) AS is_current FROM d")
def up_to_date(t):
    found = I.up_to_date(_log(t), "click", ["view", "purchase"])
    return found.select(F.col("downstream").cast("string").alias("downstream"), F.col("upstream").cast("string").alias("upstream"), "is_current")


@query(LOG + " SELECT entity, count(*) AS issue_count FROM g WHERE entity IN ('click', 'error') AND status = 'FAILED' AND started_at >= TIMESTAMP '2024-01-20' - INTERVAL 10 DAY GROUP BY 1")
def recent_failures(t):
    return V.recent_failures(_log(t), ["click", "error"], "2024-01-20", 10)


# --- further checks


@query("SELECT o_orderkey, count(*) AS lines FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_shipdate < o_orderdate GROUP BY 1")
def ordered_dates(t):
    lines = t("lineitem").withColumnRenamed("l_orderkey", "o_orderkey").join(t("orders"), "o_orderkey")
    return V.ordered(lines, "o_orderdate", "l_shipdate").groupBy("o_orderkey").agg(F.count("*").alias("lines"))


@query("SELECT a AS left_rows, b AS right_rows, abs(a - b) AS issue_count FROM (SELECT count(*) AS a FROM orders), (SELECT count(*) AS b FROM customer) WHERE a <> b")
def count_parity(t):
    return V.count_parity(t("orders"), t("customer"))


@query("SELECT doc_id, 'n_chars' AS columns FROM documents WHERE n_chars IS DISTINCT FROM CASE WHEN lang = 'de' THEN length(text) + 1 ELSE length(text) END")
def column_matches(t):
    d = t("documents").withColumn("n_chars", F.col("n_chars").cast("long"))
    want = F.length("text").cast("long") + F.when(F.col("lang") == "de", 1).otherwise(0)
    return V.column_matches(d, {"n_chars": want}, ["doc_id"]).select("doc_id", F.array_join("columns", ",").alias("columns"))


@query("SELECT lang, count(*) AS issue_count FROM documents WHERE lang IS DISTINCT FROM 'en' GROUP BY 1")
def version_current(t):
    return V.version_current(t("documents"), "lang", "en")


@query("SELECT o_orderkey, o_orderstatus FROM orders LEFT JOIN (SELECT l_orderkey, min(l_linestatus) AS s FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderstatus IS DISTINCT FROM s")
def agrees_with_children(t):
    lines = t("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_linestatus").alias("s"))
    return V.agrees(t("orders").select("o_orderkey", "o_orderstatus"), lines, ["o_orderkey"], {"o_orderstatus": "s"})


@query("SELECT delta, count(*) AS issue_count FROM (SELECT lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - event_id - 1 AS delta FROM events) WHERE delta <> 0 GROUP BY 1")
def adjacent_boundaries(t):
    e = t("events").withColumn("after", F.col("event_id") + 1)
    return V.adjacent_boundaries(e, "user_id", "event_id", "event_id", "after")


@query("SELECT first_index, count(*) AS keys FROM (SELECT min(l_linenumber) AS first_index FROM lineitem GROUP BY l_orderkey) GROUP BY 1")
def first_index_distribution(t):
    return V.first_index_distribution(t("lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'missing' ELSE 'invalid' END AS state FROM events WHERE event_type IN ('error', 'view')")
def payload_presence(t):
    p = F.when(F.col("event_type") == "view", F.concat(F.lit("{"), "props")).when(F.col("event_type") != "error", F.col("props"))
    found = V.payload_presence(t("events").withColumn("p", p), "p", ["event_id"])
    return found.select("event_id", F.when(F.col("state").isin("invalid", "malformed", "unparseable"), "invalid").otherwise("missing").alias("state"))


@query("SELECT doc_id FROM documents WHERE lang = 'fr' OR text IS NULL AND lang IS NULL")
def checksum_matches(t):
    d = t("documents").withColumn("checksum", F.when(F.col("lang") == "fr", "0").otherwise(F.sha2("text", 256)))
    return V.checksum_matches(d, "text", "checksum", ["doc_id"]).select("doc_id")


@query("SELECT c_custkey, c_acctbal::VARCHAR AS acct FROM customer WHERE NOT regexp_matches(c_acctbal::VARCHAR, '^-?\\d+\\.\\d{2,}$')")
def coordinate_precision(t):
    return V.coordinate_precision(t("customer").withColumn("acct", F.col("c_acctbal").cast("string")), "acct", 2, ["c_custkey"])


@query("SELECT o_orderkey FROM orders JOIN (SELECT l_orderkey, min(l_shipdate) AS a, max(l_shipdate) AS b FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE year(CAST(o_orderdate AS DATE)) < year(CAST(a AS DATE)) OR year(CAST(o_orderdate AS DATE)) - 1 > year(CAST(b AS DATE))")
def outside_range(t):
    samples = t("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.year("l_shipdate").alias("at"))
    return V.outside_range(t("orders").select("o_orderkey", F.year("o_orderdate").alias("y")), samples, "o_orderkey", "at", "y", "y").select("o_orderkey")


# --- text, keys, reports


@query("SELECT o_orderkey, CASE WHEN s <= 0 THEN '' WHEN s % 3600 = 0 THEN s // 3600 || '-hour' WHEN s >= 60 AND s % 60 = 0 THEN s // 60 || '-minute' ELSE s || '-second' END AS label FROM (SELECT o_orderkey, o_orderkey % 120 * 30 AS s FROM orders)")
def duration_label(t):
    return t("orders").select("o_orderkey", text.duration_label(F.col("o_orderkey") % 120 * 30).alias("label"))


@query("SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'New all-time longest ride' WHEN 1 THEN 'New this year highest elevation gain' ELSE 'New this year 5-minute power best' END AS title FROM part")
def achievement_title(t):
    k = F.col("p_size") % 3
    kind = F.when(k == 0, "longest_distance").when(k == 1, "highest_elevation_gain").otherwise("power_best_effort")
    return t("part").select("p_partkey", text.achievement_title(kind, F.lit(300), F.when(k == 0, "all_time").otherwise("calendar_year")).alias("title"))


@query("SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'Not recorded' WHEN c_nationkey % 3 = 1 THEN c_name ELSE 'Unknown gear (' || c_nationkey || ')' END AS name FROM customer")
def gear_names(t):
    k = F.col("c_nationkey")
    return t("customer").select("c_custkey", text.gear_name(F.when(k % 3 != 0, k.cast("string")), F.when(k % 3 == 1, F.col("c_name"))).alias("name"))


@query("SELECT o_custkey, sha256(string_agg(o_orderstatus, '|' ORDER BY o_orderstatus)) AS key FROM (SELECT DISTINCT o_custkey, o_orderstatus FROM orders) GROUP BY 1")
def message_keys(t):
    return t("orders").groupBy("o_custkey").agg(keys.message_key(F.collect_set("o_orderstatus")).alias("key"))


@query("SELECT doc_id, CASE WHEN lang = 'en' THEN sha256(doc_id::VARCHAR) ELSE sha256('1|2|' || coalesce(source, 'NA') || '|' || coalesce(sha256(text), 'NA')) END AS key FROM documents")
def sleep_log_keys(t):
    log = F.when(F.col("lang") == "en", F.col("doc_id").cast("string"))
    return t("documents").select("doc_id", keys.sleep_log_key(log, F.lit(1), F.lit(2), F.col("source"), F.col("text")).alias("key"))


@query("""SELECT c_custkey, sha256('["' || c_custkey || '","' || c_mktsegment || '","' || coalesce(CASE WHEN c_nationkey > 10 THEN c_nationkey::VARCHAR END, '<NA>') || '"]') AS sig FROM customer""")
def row_signatures(t):
    return t("customer").select("c_custkey", keys.row_signature(F.col("c_custkey"), F.col("c_mktsegment"), F.when(F.col("c_nationkey") > 10, F.col("c_nationkey"))).alias("sig"))


@query("SELECT o_custkey::VARCHAR AS gear_id, coalesce(c_name, 'Unknown gear (' || o_custkey || ')') AS display_name, count(*) AS activities, CAST(max(o_orderdate) AS VARCHAR) AS last_used, max(c_name) IS NOT NULL AS is_resolved FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON c_custkey = o_custkey GROUP BY o_custkey, c_name")
def gear_resolution(t):
    o = t("orders").select(F.col("o_custkey").cast("string").alias("gear_id"), F.col("o_orderdate").alias("start_date_local"))
    found = reports.gear_resolution(o, t("customer").where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("gear_id"), F.col("c_name").alias("gear_name")))
    return found.withColumn("last_used", F.col("last_used").cast("string"))


@query("SELECT reconciliation_status, CAST(coalesce(n, 0) AS BIGINT) AS rows FROM (SELECT unnest(['NEW', 'CHANGED', 'UNCHANGED', 'MISSING']) AS reconciliation_status) LEFT JOIN (SELECT CASE WHEN p_size < 10 THEN 'NEW' WHEN p_size < 20 THEN 'CHANGED' ELSE 'UNCHANGED' END AS reconciliation_status, count(*) AS n FROM part GROUP BY 1) USING (reconciliation_status)")
def reconcile_summary(t):
    p = t("part")
    json = lambda v, flip: F.concat(F.lit('{"b": ' if flip else '{ "c": 1, "b": '), v.cast("string"), F.lit(', "c": 1}' if flip else "}"))
    incoming = p.select("p_partkey", json(F.col("p_size"), True).alias("p"))
    existing = p.where("p_size >= 10").select("p_partkey", json(F.when(F.col("p_size") < 20, F.lit(0)).otherwise(F.col("p_size")), False).alias("p"), F.lit("SUCCESS").alias("s"))
    return R.summary(R.classify_sources(incoming, existing, "p_partkey", "p", ["s"])).select("reconciliation_status", "rows")


@query("SELECT event_type AS entity, CAST(ts AS VARCHAR) AS started_at FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 1")
def latest_of_log(t):
    return A.latest_of_log(t("events"), ["ts", "event_id"], F.col("event_type") == "error").select(F.col("event_type").alias("entity"), F.col("ts").cast("string").alias("started_at"))


OUTBOX = "WITH m AS (SELECT o_custkey AS id, string_agg(o_orderkey::VARCHAR, '|' ORDER BY o_orderkey::VARCHAR) AS u, c_name FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 3)"


def _messages(t):
    o = t("orders").select(
        F.col("o_custkey").alias("activity_id"), F.lit("all_time").alias("comparison_scope"), F.lit("longest_distance").alias("achievement_type"), F.lit(0).alias("duration_seconds"), F.lit("m").alias("metric_name"), F.col("o_totalprice").alias("metric_value"),
        F.lit("t").alias("achievement_title"), F.lit("d").alias("achievement_detail"), F.col("o_orderkey").cast("string").alias("activity_achievement_key"), (F.col("o_orderstatus") == "F").alias("notification_eligible"),
    )
    c = t("customer").select(F.col("c_custkey").alias("activity_id"), F.col("c_name").alias("activity_name"), F.lit("2020-01-01").alias("start_date_local"), F.lit(1.0).alias("distance_kilometres"))
    return outbox.messages(o, c, "telegram", "2020-01-01 00:00:00")


@query(OUTBOX + " SELECT id AS activity_id, sha256(u) AS source_key, sha256(sha256(u) || '|telegram') AS notification_id, 'PENDING' AS notification_status FROM m")
def outbox_messages(t):
    return _messages(t).select("activity_id", "source_key", "notification_id", "notification_status")


@query(OUTBOX + " SELECT count(*) FILTER (WHERE id % 2 = 0) AS queued, count(*) FILTER (WHERE id % 2 = 1) AS skipped, count(*) FILTER (WHERE id % 4 = 1) AS already_sent, count(*) FILTER (WHERE id % 4 = 3) AS already_queued FROM m")
def outbox_queue(t):
    new = _messages(t)
    have = new.where("activity_id % 2 = 1").withColumn("notification_status", F.when(F.col("activity_id") % 4 == 1, "SENT").otherwise("PENDING"))
    return outbox.queue(new, have)[1]


@query(OUTBOX + " SELECT id AS activity_id, CASE WHEN id % 3 = 0 THEN 'SENT' WHEN id % 3 = 1 THEN 'RETRY' ELSE 'PENDING' END AS notification_status, CASE WHEN id % 3 = 1 THEN 'timeout' END AS error_message FROM m")
def outbox_outcomes(t):
    new = _messages(t)
    told = new.where("activity_id % 3 <> 2").select("notification_id", (F.col("activity_id") % 3 == 0).alias("delivered"), F.when(F.col("activity_id") % 3 == 1, "timeout").alias("error"))
    return outbox.apply_outcomes(new, told, 5, 10, "2020-01-02 00:00:00").select("activity_id", "notification_status", "error_message")


SAMPLES = """
WITH e AS (SELECT *, date_trunc('second', ts) AS s, CAST(floor(value) AS INTEGER) AS bpm, CASE WHEN event_id % 3 <> 0 THEN 'p' || event_id END AS point FROM events),
c AS (SELECT *, CAST(ts AS DATE) AS day FROM e UNION ALL SELECT *, CAST(ts AS DATE) + 1 FROM e WHERE event_id % 2 = 0)
"""


def _sample_pages(t):
    """Responses for each user and day, in pages of six hours; every other sample comes again the day after."""
    e = t("events").withColumn("day", F.explode(F.when(F.col("event_id") % 2 == 0, F.array(F.to_date("ts"), F.date_add(F.to_date("ts"), 1))).otherwise(F.array(F.to_date("ts")))))
    time = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("physicalTime"), F.lit("3600s").alias("utcOffset"))
    rate = F.struct(time.alias("sampleTime"), F.when(F.col("event_id") % 11 != 0, F.floor("value").cast("string")).alias("beatsPerMinute"))
    point = F.struct(F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("p"), "event_id")).alias("name"), F.struct(F.col("event_type").alias("name")).alias("dataSource"), rate.alias("heartRate"))
    pages = e.groupBy("user_id", "day", F.floor(F.hour("ts") / 6).alias("page")).agg(F.collect_list(point).alias("dataPoints"))
    of = pages.groupBy("user_id", "day").agg(F.to_json(F.struct(F.array_sort(F.collect_list(F.struct("page", "dataPoints"))).alias("pages"))).alias("heart_rate_payload"))
    return of.select(F.lit(1).alias("source_id"), F.col("user_id").alias("google_health_user_id"), F.col("day").alias("activity_date"), F.lit("1sec").alias("detail_level"), F.col("day").alias("retrieved_at"), "heart_rate_payload")


@query(SAMPLES + """
SELECT sha256(concat_ws('|', '1', user_id, coalesce(point, 'NA'), s, bpm, event_type)) AS heart_rate_sample_key, user_id, point, event_type AS source_name, s AS at_utc, bpm,
  CAST(s + INTERVAL 1 HOUR AS DATE) AS local_day, max(day) AS raw_day, sha256(concat_ws('|', '1', user_id, max(day), '1sec')) AS raw_response_key
FROM c WHERE event_id % 11 <> 0 GROUP BY user_id, point, event_type, s, bpm
""", texts=("at_utc", "local_day", "raw_day"))
def heart_rate_samples(t):
    found, _ = shape.heart_rate_samples(_sample_pages(t))
    return found.select("heart_rate_sample_key", F.col("google_health_user_id").alias("user_id"), F.col("source_data_point_id").alias("point"), "source_name", F.col("sample_datetime_utc").alias("at_utc"),
                        F.col("heart_rate_bpm").alias("bpm"), F.col("sample_date_local").alias("local_day"), F.col("raw_activity_date").alias("raw_day"), "raw_response_key")


@query(SAMPLES + "SELECT user_id, day, count(*) AS rejected FROM c WHERE event_id % 11 = 0 GROUP BY 1, 2", texts=("day",))
def heart_rate_sample_rejects(t):
    _, rejects = shape.heart_rate_samples(_sample_pages(t))
    return rejects.groupBy(F.col("google_health_user_id").alias("user_id"), F.col("activity_date").alias("day")).agg(F.count("*").alias("rejected"))
