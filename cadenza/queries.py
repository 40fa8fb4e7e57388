"""The library's operators on the given tables, as registered queries, with DuckDB SQL for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import keys, text
from .operators import aggregates as A
from .operators import incremental as I  # noqa: E741
from .operators import joins as J
from .operators import reconcile as R
from .operators import records as S
from .operators import upsert as U
from .operators import windows as W
from .plans import gold, reports, silver
from .quality import families as V

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, texts: tuple[str, ...] = ()):
    """Register the function's name; it gets a reader of tables. ``texts``: columns (dates) that are shown as text."""

    def register(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
            return found.withColumns({c: F.col(c).cast("string") for c in texts})

        QUERIES[build.__name__] = run
        shown = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in texts)
        ORACLE_SQL[build.__name__] = f"SELECT * REPLACE ({shown}) FROM ({sql})" if texts else sql
        return run

    return register


def rounded(x: F.Column | str, digits: int) -> F.Column:
    """A double as DuckDB's round gives it: that multiple of a power of ten which is nearest to the product, halves away from zero.

    Spark's round goes by the double's shortest decimal text. The two part where a product is a half and the text is not, or the other way round.
    """
    x, power = F.col(x) if isinstance(x, str) else x, F.lit(10.0**digits)
    product = x * power
    nearest = F.when(F.abs(product - F.rint(product)) == 0.5, product + F.signum(product) / 2).otherwise(F.rint(product))
    return F.when(F.abs(product) == float("inf"), x).otherwise(nearest / power)


def r(name: str, digits: int = 4) -> F.Column:
    return rounded(name, digits).alias(name)


def effort_columns(found: DataFrame) -> DataFrame:
    return found.select("user_id", F.col("duration_seconds").alias("n"), r("peak_value"), F.col("start_event_id"), F.col("end_event_id"))


EFFORTS = """
WITH s AS (SELECT user_id, event_id, CAST({value} AS DECIMAL(28,10)) AS v, row_number() OVER w AS i FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
d AS (SELECT unnest([5, 10, 20]) AS n),
w AS (
  SELECT a.user_id, d.n, a.i, sum(b.v) AS m, count(b.v) AS c, count(*) AS k
  FROM s a CROSS JOIN d JOIN s b ON a.user_id = b.user_id AND b.i >= a.i AND b.i < a.i + d.n GROUP BY 1, 2, 3
),
p AS (SELECT *, row_number() OVER (PARTITION BY user_id, n ORDER BY m DESC, i) AS place FROM w WHERE c = n AND k = n)
SELECT p.user_id, CAST(p.n AS INTEGER) AS n, round(CAST(p.m AS DOUBLE) / p.n, 4) AS peak_value, f.event_id AS start_event_id, l.event_id AS end_event_id
FROM p JOIN s f ON p.user_id = f.user_id AND p.i = f.i JOIN s l ON p.user_id = l.user_id AND l.i = p.i + p.n - 1 WHERE place = 1
"""


@query(EFFORTS.replace("{value}", "value"))
def best_efforts(t):
    return effort_columns(W.best_efforts(t("events"), "user_id", ["ts", "event_id"], {"value": "value"}, [5, 10, 20]))


@query(EFFORTS.replace("{value}", "CASE WHEN event_type <> 'error' THEN value END"))
def rolling_valid_only(t):
    e = t("events").withColumn("value", F.when(F.col("event_type") != "error", F.col("value")))
    return effort_columns(W.best_efforts(e, "user_id", ["ts", "event_id"], {"value": "value"}, [5, 10, 20]))


RECORDS = """
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
x AS (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey{year} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o),
b AS (SELECT x.*, (SELECT min(i) FROM o WHERE o.o_custkey = x.o_custkey AND o.o_totalprice = x.before AND o.i < x.i{same}) AS bi FROM x WHERE before IS NULL OR o_totalprice > before)
SELECT b.o_custkey, b.o_orderkey, b.o_totalprice, b.before AS previous_value, o.o_orderkey AS previous_key FROM b LEFT JOIN o ON o.o_custkey = b.o_custkey AND o.i = b.bi
"""
ORDER = ["o_orderdate", "o_orderkey"]


def _records(t, year: bool) -> DataFrame:
    found = W.running_records(t("orders"), ["o_custkey"], ORDER, "o_totalprice", "o_orderdate", year)
    return found.select("o_custkey", "o_orderkey", "o_totalprice", F.col("previous.value").alias("previous_value"), F.col("previous.o_orderkey").alias("previous_key"))


@query(RECORDS.replace("{year}", "").replace("{same}", ""))
def records_all_time(t):
    return _records(t, False)


@query(RECORDS.replace("{year}", ", year(o_orderdate)").replace("{same}", " AND year(o.o_orderdate) = year(x.o_orderdate)"))
def records_year(t):
    return _records(t, True)


@query("""
WITH o AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i FROM orders),
x AS (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o)
SELECT x.o_custkey, x.o_orderkey, p.o_orderkey AS prior_key, CAST(date_diff('day', CAST(p.o_orderdate AS DATE), CAST(x.o_orderdate AS DATE)) AS INTEGER) AS days
FROM x LEFT JOIN o p ON p.o_custkey = x.o_custkey AND p.i = (SELECT max(i) FROM o q WHERE q.o_custkey = x.o_custkey AND q.i < x.i AND q.o_totalprice >= x.o_totalprice)
WHERE before IS NULL OR x.o_totalprice > before
""")
def record_recency(t):
    found = S.year_records(t("orders"), ["o_custkey"], ORDER, "o_totalprice", "o_orderdate")
    return found.select("o_custkey", "o_orderkey", F.col("prior.o_orderkey").alias("prior_key"), F.datediff("o_orderdate", "prior.o_orderdate").alias("days"))


@query("SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(t):
    return W.latest_per_key(t("events").select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT l_orderkey, l_linenumber, lead(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) - l_quantity AS delta FROM lineitem")
def adjacent_delta(t):
    return W.adjacent_delta(t("lineitem"), "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity", "l_quantity").select("l_orderkey", "l_linenumber", "delta")


@query("""
WITH e AS (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events), i AS (SELECT DISTINCT user_id, s // 3600 * 3600 AS a, s // 3600 * 3600 + 1800 AS b FROM e)
SELECT i.user_id, i.a AS start_s, count(*) AS events FROM i JOIN e ON e.user_id = i.user_id AND e.s >= i.a AND e.s < i.b GROUP BY 1, 2
""")
def interval_join(t):
    e = t("events").select("user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    a = F.floor(F.col("s") / 3600) * 3600
    i = e.select("user_id", a.alias("start_s"), (a + 1800).alias("end_s")).distinct()
    return J.interval_join(e, i, "user_id", "s", "start_s", "end_s", width=86400).groupBy("user_id", "start_s").agg(F.count("*").alias("events"))


@query("""
WITH l AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS c FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(c, 2) AS total_children, round(o_totalprice, 2) AS total_parent FROM l JOIN orders ON l_orderkey = o_orderkey WHERE abs(c - o_totalprice) > 1000
""")
def parent_child_reconcile(t):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))
    found = V.parent_summary(t("lineitem"), t("orders").withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey", {"total": (price, "o_totalprice")}, 1000)
    return found.select("l_orderkey", r("total_children", 2), r("total_parent", 2))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def missing_downstream(t):
    return V.missing_downstream(t("documents"), t("labels"), ["doc_id"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def orphans(t):
    return V.orphans(t("orders"), t("customer").where("c_mktsegment <> 'BUILDING'"), ["o_custkey"], ["c_custkey"]).select("o_orderkey", "o_custkey")


@query("SELECT o_custkey, count(*) AS uses, max(o_orderdate) AS last_attempt FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1")
def unresolved_refs(t):
    attempts = t("orders").select("o_custkey", F.col("o_orderdate").alias("attempted_at"))
    return V.unresolved_refs(t("orders"), "o_custkey", t("customer").where("c_acctbal > 0"), "c_custkey", attempts)


@query("SELECT c_custkey, c_acctbal > 0 AS has_orders, c_custkey IN (SELECT o_custkey FROM orders) AS found FROM customer WHERE (c_acctbal > 0) <> (c_custkey IN (SELECT o_custkey FROM orders))")
def flag_mismatch(t):
    c = t("customer").select("c_custkey", (F.col("c_acctbal") > 0).alias("has_orders"))
    return V.flag_vs_exists(c, "has_orders", t("orders").withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"])


@query("SELECT l_orderkey, l_partkey, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key(t):
    return V.unique_key(t("lineitem"), ["l_orderkey", "l_partkey"])


@query("SELECT source, sha256(text) AS content, count(*) AS rows FROM documents GROUP BY 1, 2 HAVING count(*) > 1")
def composite_grain(t):
    return V.unique_key(t("documents").select("source", F.sha2("text", 256).alias("content")), ["source", "content"])


@query("SELECT o_orderstatus, count(*) AS issue_count FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1")
def accepted_values(t):
    return V.accepted_values(t("orders"), "o_orderstatus", ["F", "O"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity IS NULL OR NOT (l_quantity > 2 AND l_discount < 0.1)")
def required_fields(t):
    return V.required(t("lineitem"), ["l_quantity"], (F.col("l_quantity") > 2) & (F.col("l_discount") < 0.1), ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R' AND NOT l_linestatus = 'F'")
def implication(t):
    return V.implies(t("lineitem"), F.col("l_returnflag") == "R", F.col("l_linestatus") == "F").select("l_orderkey", "l_linenumber")


@query("WITH c AS (SELECT user_id, count(*) AS k FROM events GROUP BY 1) SELECT user_id, CAST(n AS INTEGER) AS n FROM c, (SELECT unnest([5, 50, 100, 150]) AS n) WHERE n <= k AND NOT (n = 50 AND k >= 100)")
def coverage_expected(t):
    counts = t("events").groupBy("user_id").agg(F.count("*").alias("k"))
    there = J.range_expand(counts.where("k >= 100"), "k", [50], "n")
    return V.coverage(counts, "user_id", "k", there, [5, 50, 100, 150], "n")


@query("""
SELECT l_orderkey, l_linenumber, 'quantity' AS metric, l_quantity AS value FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, 'price', l_extendedprice FROM lineitem UNION ALL SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem
""")
def unpivot_metrics(t):
    return J.unpivot(t("lineitem"), ["l_orderkey", "l_linenumber"], {"quantity": F.col("l_quantity"), "price": F.col("l_extendedprice"), "discount": F.col("l_discount")})


DOMAINS = "WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders), s AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)"


@query(DOMAINS + " SELECT day, o.day IS NOT NULL AS has_ordered, s.day IS NOT NULL AS has_shipped FROM o FULL JOIN s USING (day)", texts=('day',))
def date_domain_overlap(t):
    return V.domain_overlap(_domains(t), "day")


@query(DOMAINS + " SELECT day, o.day IS NOT NULL AS has_ordered, s.day IS NOT NULL AS has_shipped FROM o FULL JOIN s USING (day) WHERE o.day IS NULL OR s.day IS NULL", texts=('day',))
def partial_coverage(t):
    return V.partial_coverage(_domains(t), "day")


def _domains(t):
    return {"ordered": t("orders").select(F.to_date("o_orderdate").alias("day")), "shipped": t("lineitem").select(F.to_date("l_shipdate").alias("day"))}


@query("""
WITH e AS (SELECT CAST(ts AS DATE) + CAST(event_id % 3 * 40 AS INTEGER) AS day, sum(value) AS v FROM events GROUP BY 1),
d AS (SELECT CAST(unnest(generate_series(min(day), max(day), INTERVAL 1 DAY)) AS DATE) AS day FROM e)
SELECT day, round(coalesce(v, 0), 4) AS value FROM d LEFT JOIN e USING (day)
""", texts=('day',))
def densify_daily(t):
    """All events; those of two in three ids are put off by 40 and 80 days, which leaves days without any."""
    days = t("events").withColumn("day", F.date_add(F.to_date("ts"), (F.col("event_id") % 3 * 40).cast("int")))
    return A.densify_daily(days, "day", "value").select("day", r("value"))


@query("SELECT user_id, CAST(ts AS DATE) AS day, count(DISTINCT event_type) AS n_values, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS value_list FROM events GROUP BY 1, 2 HAVING count(DISTINCT event_type) > 1", texts=('day',))
def multi_source_per_key(t):
    return V.multi_source(t("events").withColumn("day", F.to_date("ts")), ["user_id", "day"], "event_type")


@query("""
WITH i AS (SELECT c_custkey AS k, '{"b": ' || CASE WHEN c_nationkey = 3 THEN '1' ELSE '0' END || '}' AS p FROM customer WHERE c_acctbal > 0),
e AS (SELECT c_custkey AS k, '{"b": 0}' AS p, CASE c_mktsegment WHEN 'BUILDING' THEN 'FAILED' WHEN 'MACHINERY' THEN 'PENDING' ELSE 'SUCCESS' END AS s FROM customer WHERE c_nationkey <> 7)
SELECT k, CASE WHEN e.p IS NULL THEN 'NEW' WHEN i.p IS NULL THEN 'MISSING' WHEN i.p = e.p THEN 'UNCHANGED' ELSE 'CHANGED' END AS reconciliation_status,
  CASE WHEN e.p IS NULL THEN 'INCOMPLETE' WHEN s = 'FAILED' THEN 'FAILED' WHEN s = 'PENDING' THEN 'INCOMPLETE' ELSE 'COMPLETE' END AS child_status,
  coalesce(i.p <> e.p, FALSE) AS payload_changed, i.p IS NOT NULL AND (e.p IS NULL OR i.p <> e.p OR s <> 'SUCCESS') AS repair_s
FROM i FULL JOIN e USING (k)
""")
def reconcile_sources(t):
    c = t("customer").withColumnRenamed("c_custkey", "k")
    incoming = c.where("c_acctbal > 0").select("k", F.concat(F.lit('{"b": '), F.when(F.col("c_nationkey") == 3, "1").otherwise("0"), F.lit("}")).alias("p"))
    status = F.when(F.col("c_mktsegment") == "BUILDING", "FAILED").when(F.col("c_mktsegment") == "MACHINERY", "PENDING").otherwise("SUCCESS")
    return R.classify_sources(incoming, c.where("c_nationkey <> 7").select("k", F.lit('{"b":0}').alias("p"), status.alias("s")), "k", "p", ["s"], "b int")


def _customer_halves(t):
    c, columns = t("customer"), ["c_custkey", "c_name", "c_acctbal"]
    newer = c.where("c_nationkey < 15").withColumn("c_acctbal", F.when(F.col("c_acctbal") <= 5000, F.col("c_acctbal")))
    return c.where("c_mktsegment <> 'BUILDING'").select(*columns), newer.select(*columns)


HALVES = "WITH t AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment <> 'BUILDING'), s AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal <= 5000 THEN c_acctbal END AS c_acctbal FROM customer WHERE c_nationkey < 15)"


@query(HALVES + """ SELECT c_custkey, coalesce(s.c_name, t.c_name) AS c_name, CASE WHEN s.c_custkey IS NULL THEN t.c_acctbal ELSE s.c_acctbal END AS c_acctbal,
CASE WHEN t.c_custkey IS NULL THEN 'inserted' WHEN s.c_custkey IS NULL THEN 'kept' WHEN s.c_acctbal IS NOT DISTINCT FROM t.c_acctbal THEN 'unchanged' ELSE 'updated' END AS action FROM t FULL JOIN s USING (c_custkey)""")
def upsert_result(t):
    return U.merged(*_customer_halves(t), ["c_custkey"])


@query(HALVES + " SELECT CASE WHEN c_custkey IN (SELECT c_custkey FROM t) THEN 'update' ELSE 'insert' END AS part, count(*) AS rows, sum(c_custkey) AS keys FROM s GROUP BY 1")
def split_existing(t):
    target, source = _customer_halves(t)
    insert, update = U.split_existing(source, target, ["c_custkey"])
    both = insert.withColumn("part", F.lit("insert")).unionByName(update.withColumn("part", F.lit("update")))
    return both.groupBy("part").agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys"))


@query("""
SELECT o_orderkey, CASE WHEN o_totalprice IS NULL THEN 'none' WHEN o_orderstatus = 'F' AND o_totalprice < 50000 THEN 'small_closed' WHEN o_orderpriority LIKE '1-%' THEN 'urgent' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'other' END AS class FROM orders
""")
def classify_rules(t):
    closed = F.col("o_orderstatus") == "F"
    rule = silver.ladder((F.col("o_totalprice").isNull(), "none"), (closed & (F.col("o_totalprice") < 50000), "small_closed"), (F.col("o_orderpriority").startswith("1-"), "urgent"), (F.col("o_orderstatus") == "O", "open"), otherwise="other")
    return t("orders").select("o_orderkey", rule.alias("class"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events")
def json_extract(t):
    return t("events").select("event_id", F.get_json_object("props", "$.k").try_cast("long").alias("k"))


@query("""
WITH f AS (SELECT event_id, props, unnest(json_keys(props)) AS path FROM events),
t AS (SELECT event_id, path, json_type(props, '$.' || path) AS k FROM f)
SELECT path, 100.0 * count(DISTINCT event_id) / (SELECT count(DISTINCT event_id) FROM events WHERE json_valid(props)) AS coverage_percent,
  string_agg(DISTINCT CASE k WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END, ',') AS types,
  avg(CASE WHEN k = 'NULL' THEN 1.0 ELSE 0.0 END) AS null_frequency FROM t GROUP BY 1
""")
def json_coverage(t):
    return reports.payload_coverage(t("events"), "props", "event_id")


@query("""
WITH o AS (SELECT o_orderkey AS id, o_totalprice < 50000 AS low, o_orderkey % 2 = 0 AS even, o_orderpriority LIKE '5%' AS bare FROM orders),
f AS (
  SELECT id, 'status' AS path, 'string' AS k FROM o UNION ALL SELECT id, 'order', CASE WHEN bare THEN 'null' ELSE 'object' END FROM o
  UNION ALL SELECT id, 'order.price', CASE WHEN low THEN 'null' ELSE 'number' END FROM o WHERE NOT bare
  UNION ALL SELECT id, 'order.tags', CASE WHEN even THEN 'array' ELSE 'null' END FROM o WHERE NOT bare
  UNION ALL SELECT id, unnest(['order.who', 'order.who.id', 'order.who.open']), unnest(['object', 'number', 'boolean']) FROM o WHERE NOT bare
)
SELECT path, 100.0 * count(DISTINCT id) / (SELECT count(*) FROM o) AS coverage_percent, string_agg(DISTINCT k, ',' ORDER BY k) AS types, avg(CASE WHEN k = 'null' THEN 1.0 ELSE 0.0 END) AS null_frequency FROM f GROUP BY 1
""")
def json_coverage_nested(t):
    """Orders as payloads of three levels with nulls and arrays."""
    who = F.struct(F.col("o_custkey").alias("id"), (F.col("o_orderstatus") == "O").alias("open"))
    inner = F.struct(F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("price"), F.when(F.col("o_orderkey") % 2 == 0, F.array("o_orderstatus")).alias("tags"), who.alias("who"))
    whole = F.struct(F.col("o_orderstatus").alias("status"), F.when(~F.col("o_orderpriority").startswith("5"), inner).alias("order"))
    return reports.payload_coverage(t("orders").select("o_orderkey", F.to_json(whole, {"ignoreNullFields": "false"}).alias("payload")), "payload", "o_orderkey")


@query("SELECT o_orderkey, sha256(o_orderkey || '|' || o_orderstatus || '|' || coalesce(CASE WHEN o_orderpriority LIKE '1-%' THEN NULL ELSE o_orderpriority END, 'NA')) AS key FROM orders")
def keys_sha256(t):
    return t("orders").select("o_orderkey", keys.key(F.col("o_orderkey"), F.col("o_orderstatus"), F.when(~F.col("o_orderpriority").startswith("1-"), F.col("o_orderpriority"))).alias("key"))


@query("""
WITH l AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
SELECT l_orderkey AS activity_id, CAST(i AS INTEGER) AS sample_index, CAST(l_linenumber AS INTEGER) AS time_seconds, CASE WHEN i < n THEN CAST(l_quantity AS INTEGER) END AS watts, CAST(n AS INTEGER) AS raw_max_original_size FROM l
""")
def stream_widen(t):
    rows = t("lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))).alias("a"))
    n = F.size("a")
    time = F.to_json(F.transform("a", lambda x: x["l_linenumber"]))
    watts = F.to_json(F.slice(F.transform("a", lambda x: x["l_quantity"].cast("int")), F.lit(1), n - 1))
    entry = F.explode(F.array(F.struct(F.lit("time").alias("stream_type"), time.alias("stream_payload")), F.struct(F.lit("watts").alias("stream_type"), watts.alias("stream_payload")))).alias("s")
    raw = rows.select(F.col("l_orderkey").alias("activity_id"), n.alias("original_size"), F.lit(None).cast("timestamp").alias("retrieved_at"), entry).select("activity_id", "original_size", "retrieved_at", "s.*")
    return silver.widen_streams(raw).select("activity_id", "sample_index", "time_seconds", "watts", "raw_max_original_size")


@query("""
SELECT 'c_custkey' AS column_name, count(*) AS rows, count(c_custkey) AS non_null, count(DISTINCT c_custkey) AS distinct_values FROM customer UNION ALL
SELECT 'c_mktsegment', count(*), count(c_mktsegment), count(DISTINCT c_mktsegment) FROM customer UNION ALL SELECT 'c_nationkey', count(*), count(c_nationkey), count(DISTINCT c_nationkey) FROM customer
""")
def population_profile(t):
    return A.population_profile(t("customer"), ["c_custkey", "c_mktsegment", "c_nationkey"]).select("column_name", "rows", "non_null", "distinct_values")


SNAPSHOTS = "WITH b AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS day, o_totalprice AS v, o_orderstatus AS p FROM orders WHERE o_orderpriority <> '5-LOW'), a AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) + CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS INTEGER) AS day, o_totalprice AS v, CASE WHEN o_totalprice > 200000 THEN 'X' ELSE o_orderstatus END AS p FROM orders WHERE o_orderstatus <> 'P')"


def _snapshots(t):
    o = t("orders").select(F.col("o_orderkey").alias("k"), F.to_date("o_orderdate").alias("day"), F.col("o_totalprice").alias("v"), F.col("o_orderstatus").alias("p"), "o_orderpriority")
    later = o.where("p <> 'P'").withColumns({"day": F.date_add("day", F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)), "p": F.when(F.col("v") > 200000, "X").otherwise(F.col("p"))})
    return o.where("o_orderpriority <> '5-LOW'").drop("o_orderpriority"), later.drop("o_orderpriority")


@query(SNAPSHOTS + """ SELECT k, CASE WHEN b.k IS NULL THEN 'insert' WHEN a.k IS NULL THEN 'delete_or_exclude' ELSE 'update' END AS change_type, b.day AS activity_date_before, a.day AS activity_date_after,
b.k IS NULL OR a.k IS NULL OR b.day <> a.day OR b.p <> a.p AS silver_activities_changed, coalesce(b.v, a.v) < 10000 AS silver_streams_changed, b.p IS DISTINCT FROM a.p AS power_classification_changed,
least(coalesce(b.day, a.day), coalesce(a.day, b.day)) AS dependency_start_date FROM b FULL JOIN a USING (k) WHERE b.k IS NULL OR a.k IS NULL OR b.day <> a.day OR b.p <> a.p OR coalesce(b.v, a.v) < 10000""", texts=('activity_date_before', 'activity_date_after', 'dependency_start_date'))
def change_rows(t):
    before, after = (d.withColumn("sig", keys.row_signature(F.col("day"), F.col("v"), F.col("p"))) for d in _snapshots(t))
    ids = before.select("k", "v").unionByName(after.select("k", "v"))
    return I.change_rows(ids, before, after, "k", "day", ["p"], ids.where("v < 10000"))


@query(SNAPSHOTS + " SELECT k FROM b FULL JOIN a USING (k) WHERE b.k IS NULL OR a.k IS NULL OR b.day <> a.day OR b.p <> a.p")
def symmetric_diff(t):
    return I.signature_diff(*_snapshots(t), "k", ["day", "v", "p"])


@query("""
WITH e AS (SELECT l_orderkey AS k, count(*) AS expected_rows FROM lineitem GROUP BY 1),
a AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (WHERE l_linestatus <> 'F') AS stale FROM lineitem WHERE l_tax < 0.07 GROUP BY 1)
SELECT k, expected_rows, coalesce(n, 0) AS actual_rows, CASE WHEN n IS NULL THEN 'missing' WHEN n <> expected_rows THEN 'incomplete' ELSE 'stale_version' END AS reason
FROM e LEFT JOIN a USING (k) WHERE n IS NULL OR n <> expected_rows OR stale > 0
""")
def repair_plan(t):
    l = t("lineitem").withColumnRenamed("l_orderkey", "k")  # noqa: E741
    expected = l.groupBy("k").agg(F.count("*").alias("expected_rows"))
    return I.repair_plan(expected, l.where("l_tax < 0.07"), ["k"], version=("l_linestatus", "F"))


@query("""
WITH x AS (SELECT l_returnflag, l_linestatus = 'F' AS ok, l_orderkey * 10 + l_linenumber AS id, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag, l_linestatus = 'F' ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) AS i FROM lineitem)
SELECT coalesce(a.l_returnflag, b.l_returnflag) AS flag, a.id AS excluded_id, b.id AS eligible_id, round(a.v - b.v, 2) AS difference
FROM (SELECT * FROM x WHERE i = 1 AND NOT ok) a FULL JOIN (SELECT * FROM x WHERE i = 1 AND ok) b ON a.l_returnflag = b.l_returnflag
""")
def top_excluded_vs_eligible(t):
    e = t("lineitem").select(F.lit("watts").alias("metric_name"), F.col("l_returnflag").alias("duration_seconds"), (F.col("l_linestatus") == "F").alias("is_record_eligible"), F.col("l_extendedprice").alias("peak_value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("activity_id"))
    found = reports.excluded_against_eligible(e)
    return found.select(F.col("duration_seconds").alias("flag"), F.col("excluded_activity_id").alias("excluded_id"), F.col("eligible_activity_id").alias("eligible_id"), rounded("watt_difference", 2).alias("difference"))


@query("SELECT rows_per_key, count(*) AS keys FROM (SELECT count(*) AS rows_per_key FROM lineitem GROUP BY l_orderkey) GROUP BY 1")
def histogram_of_counts(t):
    return A.histogram_of_counts(t("lineitem"), ["l_orderkey"])


@query("SELECT l_orderkey, min(l_linenumber) AS first_index, max(l_linenumber) AS last_index, count(*) AS rows, count(DISTINCT l_linenumber) AS indexes FROM (SELECT l_orderkey, CASE WHEN l_quantity > 10 THEN l_linenumber ELSE l_linenumber + 1 END AS l_linenumber FROM lineitem) GROUP BY 1 HAVING max(l_linenumber) - min(l_linenumber) + 1 <> count(DISTINCT l_linenumber) OR count(*) <> count(DISTINCT l_linenumber)")
def index_continuity(t):
    moved = t("lineitem").withColumn("l_linenumber", F.when(F.col("l_quantity") > 10, F.col("l_linenumber")).otherwise(F.col("l_linenumber") + 1))
    return V.index_continuity(moved, "l_orderkey", "l_linenumber")


@query("SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN (SELECT *, c_nationkey + CASE WHEN c_acctbal > 9000 THEN 0 ELSE 25 END AS k FROM customer) ON n_nationkey = k GROUP BY 1")
def zero_filled_counts(t):
    key = F.col("c_nationkey") + F.when(F.col("c_acctbal") > 9000, 0).otherwise(25)
    counts = t("customer").groupBy(key.alias("n_nationkey")).agg(F.count("*").alias("customers"))
    return A.zero_filled(counts, t("nation"), ["n_nationkey"], "customers").select("n_name", "customers")


@query("SELECT event_type, min(CAST(ts AS DATE)) AS first_date, max(CAST(ts AS DATE)) AS last_date, count(*) AS observations, count(DISTINCT CAST(ts AS DATE)) AS days FROM events GROUP BY 1", texts=('first_date', 'last_date'))
def ecosystem_coverage(t):
    return A.coverage(t("events").withColumn("day", F.to_date("ts")), ["event_type"], "day")


@query("SELECT o_orderkey, CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm ' || s % 60 || 's' ELSE s // 3600 || 'h ' || s % 3600 // 60 || 'm ' || s % 60 || 's' END AS label FROM (SELECT o_orderkey, o_orderkey % 9000 AS s FROM orders)")
def duration_text(t):
    return t("orders").select("o_orderkey", text.duration(F.col("o_orderkey") % 9000).alias("label"))


@query("""
WITH p AS (SELECT p_partkey AS k, p_name AS n, CAST(p_size AS DOUBLE) AS v FROM part), q AS (SELECT p_partkey AS k, p_name AS n, CAST(CASE WHEN p_retailprice > 1500 THEN p_size + 1 ELSE p_size END AS DOUBLE) AS v FROM part WHERE p_size > 5)
SELECT k, CASE WHEN q.k IS NULL THEN 'only_before' WHEN q.v = p.v THEN 'equal' ELSE 'mismatched' END AS difference FROM p LEFT JOIN q USING (k)
""")
def compare_facts(t):
    p = t("part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("n"), F.col("p_size").cast("double").alias("v"), "p_retailprice")
    return I.compare_facts(p, p.where("v > 5").withColumn("v", F.when(F.col("p_retailprice") > 1500, F.col("v") + 1).otherwise(F.col("v"))), ["k"], ["n", "v"])


@query("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) AS has_large FROM customer")
def exists_flag(t):
    large = t("orders").where("o_totalprice > 200000").withColumnRenamed("o_custkey", "c_custkey")
    return J.exists_flag(t("customer"), large, ["c_custkey"], "has_large").select("c_custkey", "has_large")


@query("""
WITH l AS (SELECT user_id, event_id, value, count(value) OVER w AS prior, quantile_cont(value, 0.5) OVER w AS m FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT user_id, event_id FROM l WHERE value > CASE WHEN prior >= 5 THEN greatest(60, 1.5 * m) ELSE 60 END
""")
def slow_batches(t):
    return A.slow_batches(t("events").select("user_id", "event_id", "value"), "user_id", "event_id", "value", factor=1.5).where("is_slow").select("user_id", "event_id")


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS i FROM events QUALIFY i <= 10),
n AS (SELECT *, ceil(count(*) OVER (PARTITION BY user_id) / 2) AS half FROM r),
h AS (SELECT user_id, count(*) >= 4 AND count(value) = count(*) AS whole, sum(event_id) FILTER (WHERE i > half) / nullif(sum(value) FILTER (WHERE i > half), 0) AS a,
  sum(event_id) FILTER (WHERE i <= half) / nullif(sum(value) FILTER (WHERE i <= half), 0) AS b FROM n GROUP BY 1)
SELECT user_id, CASE WHEN NOT whole OR b / a - 1 IS NULL OR a <= 0 THEN 'calculating' WHEN b / a - 1 > 0.1 THEN 'improving' WHEN b / a - 1 < -0.1 THEN 'degrading' ELSE 'stable' END AS trend FROM h
""")
def throughput_trend(t):
    return A.throughput_trend(t("events"), "user_id", "event_id", "event_id", "value").select("user_id", "trend")


@query("SELECT user_id, event_id, round(sum(event_id) OVER w / sum(value) OVER w, 4) AS rows_per_second FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")
def rolling_throughput(t):
    found = A.rolling_throughput(t("events").withColumn("left", F.lit(0)), "user_id", "event_id", "event_id", "value", "left")
    return found.select("user_id", "event_id", r("rows_per_second"))


@query("""
WITH d AS (SELECT ps, sum(q) AS q FROM (SELECT l_orderkey || '/' || l_partkey AS ps, l_quantity AS q FROM lineitem WHERE l_tax < 0.06) GROUP BY 1),
p AS (SELECT ps, sum(q) AS q FROM (SELECT l_orderkey || '/' || l_partkey AS ps, CASE WHEN l_discount > 0.08 THEN l_quantity + 1 ELSE l_quantity END AS q FROM lineitem WHERE l_returnflag <> 'R') GROUP BY 1)
SELECT ps, CASE WHEN p.q IS NULL THEN 'inserted' WHEN d.q IS NULL THEN 'deleted' WHEN d.q = p.q THEN 'unchanged' ELSE 'updated' END AS action FROM d FULL JOIN p USING (ps)
""")
def tree_actions(t):
    l = t("lineitem").withColumn("ps", F.concat_ws("/", "l_orderkey", "l_partkey"))  # noqa: E741
    declared = l.where("l_tax < 0.06").groupBy("ps").agg(F.sum("l_quantity").alias("q"))
    published = l.where("l_returnflag <> 'R'").groupBy("ps").agg(F.sum(F.when(F.col("l_discount") > 0.08, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))).alias("q"))
    return U.tree_actions(declared, published, ["ps"], ["q"])


@query("""
SELECT d.doc_id, s AS status, CASE WHEN s = 'SUCCESS' AND l.doc_id IS NULL THEN 'success_without_data' WHEN s = 'NOT_FOUND' AND l.doc_id IS NOT NULL THEN 'not_found_with_data' ELSE 'data_without_success' END AS finding
FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'SUCCESS' WHEN 'de' THEN 'NOT_FOUND' ELSE 'PENDING' END AS s FROM documents) d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id
WHERE (s = 'SUCCESS') <> (l.doc_id IS NOT NULL)
""")
def status_vs_data(t):
    d = t("documents").select("doc_id", F.when(F.col("lang") == "en", "SUCCESS").when(F.col("lang") == "de", "NOT_FOUND").otherwise("PENDING").alias("status"))
    return V.status_vs_data(d, "status", t("labels"), "doc_id")


@query("SELECT event_id, coalesce(json_extract_string(props, '$.k'), '-') AS k, coalesce(json_extract_string(props, '$.none.x'), '-') AS x FROM events")
def nested_value(t):
    return t("events").select("event_id", reports.nested_value(F.col("props"), "k", F.lit("-")).alias("k"), reports.nested_value(F.col("props"), "none.x", F.lit("-")).alias("x"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_rows(t):
    return A.top_rows(t("orders").select("o_orderkey", "o_totalprice"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("SELECT o_orderpriority, list_position(['3-MEDIUM', '1-URGENT'], o_orderpriority) AS place, count(*) AS rows FROM orders GROUP BY 1, 2")
def custom_order(t):
    place = F.coalesce(A.custom_order(F.col("o_orderpriority"), ["3-MEDIUM", "1-URGENT"]), F.lit(0))
    counts = t("orders").groupBy("o_orderpriority").agg(F.count("*").alias("rows"))
    return counts.select("o_orderpriority", F.when(place > 0, place.cast("int")).alias("place"), "rows")


@query("SELECT 'orders' AS table_name, count(*) AS rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events")
def row_counts(t):
    return A.row_counts({n: t(n) for n in ("orders", "lineitem", "events")})


@query("SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_tax > 0.02 THEN greatest(l_quantity, l_extendedprice / 1000) END AS most FROM lineitem")
def greatest_or_null(t):
    maybe = F.when(F.col("l_tax") > 0.02, F.col("l_quantity"))
    return t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", A.greatest_or_null(maybe, F.col("l_extendedprice") / 1000).alias("most"))


@query("""
WITH s AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS m, o_totalprice AS v FROM orders),
o AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY d, id) AS i FROM s),
x AS (SELECT *, max(v) OVER (PARTITION BY m ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ba, max(v) OVER (PARTITION BY m, year(d) ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best_year FROM o),
y AS (SELECT x.*, (SELECT max(i) FROM o WHERE o.m = x.m AND o.i < x.i AND o.v >= x.v) AS near FROM x WHERE best_year IS NULL OR v > best_year)
SELECT id AS activity_id, m AS metric_name, 'all_time' AS comparison_scope, v AS metric_value, ba AS previous_best_value, CAST(NULL AS INTEGER) AS days_since_previous_best,
  sha256(id || '|longest_distance|' || m || '|0|all_time|1000-01-01|9999-12-31') AS activity_achievement_key FROM x WHERE ba IS NULL OR v > ba
UNION ALL
SELECT y.id, y.m, 'calendar_year', y.v, o.v, CAST(date_diff('day', o.d, y.d) AS INTEGER), sha256(y.id || '|longest_distance|' || y.m || '|0|calendar_year|' || year(y.d) || '-01-01|' || year(y.d) || '-12-31') FROM y LEFT JOIN o ON o.m = y.m AND o.i = y.near
""")
def achievements(t):
    s = t("orders").select(F.col("o_orderkey").alias("activity_id"), F.to_date("o_orderdate").alias("activity_date"), F.lit("longest_distance").alias("achievement_type"), F.col("o_orderpriority").alias("metric_name"), F.lit(0).alias("duration_seconds"), F.col("o_totalprice").alias("value"))
    return gold.achievements(s).select("activity_id", "metric_name", "comparison_scope", "metric_value", "previous_best_value", "days_since_previous_best", "activity_achievement_key")
