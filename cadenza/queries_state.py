"""Queries of what is kept up from state or works in ordered chunks, with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .operators import chunks as C
from .operators import records as S
from .operators import windows as W
from .operators.medians import running_median
from .operators.parts import RangedTable
from .operators.stored import shared_folder
from .operators.sweep import sweep_join
from .operators.tables import publish, published
from .quality import families as V
from .quality.gate import Refused, gate
from .quality.runner import Check
from .queries import EFFORTS, ORACLE_SQL, ORDER, RECORDS, effort_columns, query, r, rounded

#: Orders before this day are the history whose state is kept, those from it on are new.
START = "1997-03-17"
RECORD = (["o_custkey"], ORDER, "o_totalprice", "o_orderdate")


@query("""
WITH o AS (SELECT *, date_trunc('month', o_orderdate) AS m FROM orders WHERE o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL),
x AS (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey, m ORDER BY o_orderdate DESC, o_orderkey DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS later,
  row_number() OVER (PARTITION BY o_custkey, m ORDER BY o_totalprice DESC, o_orderdate, o_orderkey) AS place FROM o)
SELECT o_custkey, o_orderkey, o_totalprice, CAST(m AS DATE) AS state_month FROM x WHERE later IS NULL OR o_totalprice > later OR place = 1
""", texts=("state_month",))
def records_state(t):
    return S.fold(t("orders"), *RECORD).select("o_custkey", "o_orderkey", "o_totalprice", "state_month")


def _recent(t):
    """The rows that an evaluation from START on reads: the state of what lies before, and the rest."""
    orders = t("orders")
    state = S.fold(orders.where(F.col("o_orderdate") < START), *RECORD)
    return S.needed(state, orders, START, "o_orderdate")


@query(f"SELECT * FROM ({ORACLE_SQL['record_recency']}) WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '{START}')")
def recency_from_state(t):
    found = S.year_records(_recent(t), *RECORD).where(F.col("o_orderdate") >= START)
    return found.select("o_custkey", "o_orderkey", F.col("prior.o_orderkey").alias("prior_key"), F.datediff("o_orderdate", "prior.o_orderdate").alias("days"))


@query(f"SELECT * FROM ({RECORDS.replace('{year}', '').replace('{same}', '')}) WHERE o_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '{START}')")
def records_from_state(t):
    found = W.running_records(_recent(t), *RECORD).where(F.col("o_orderdate") >= START)
    return found.select("o_custkey", "o_orderkey", "o_totalprice", F.col("previous.value").alias("previous_value"), F.col("previous.o_orderkey").alias("previous_key"))


ONE_KEY = EFFORTS.replace("{value}", "value").replace("events WINDOW", "(SELECT * REPLACE (1 AS user_id) FROM events) WINDOW")


@query(ONE_KEY.replace("JOIN s b ON a.user_id = b.user_id AND b.i >= a.i AND b.i < a.i + d.n", "JOIN (SELECT s.*, unnest(range(i - 19, i + 1)) AS j FROM s) b ON a.i = b.j AND b.i < a.i + d.n"))
def best_efforts_in_chunks(t):
    """One user has all events: a history that must spread over tasks."""
    one = t("events").withColumn("user_id", F.lit(1).cast("long"))
    return effort_columns(W.best_efforts(one, "user_id", ["ts", "event_id"], {"value": "value"}, [5, 10, 20], longest=2000))


POWER = """
WITH s AS (SELECT {key} AS user_id, CAST(value AS DECIMAL(28,10)) AS v, ts, event_id FROM events),
w AS (SELECT user_id, v, sum(v) OVER p AS t, count(v) OVER p AS c FROM s WINDOW p AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
g AS (SELECT user_id, count(*) AS samples, count(v) AS valid_samples, CAST(sum(v) AS DOUBLE) / nullif(count(v), 0) AS a,
  pow(avg(CASE WHEN c = 30 THEN pow(CAST(t AS DOUBLE) / 30, 4) END), 0.25) AS p FROM w GROUP BY 1)
SELECT user_id, samples, valid_samples, round(a, 4) AS average, round(p, 4) AS normalised, round(CASE WHEN a <> 0 THEN p / a END, 4) AS variability_index FROM g
"""


def _power(found):
    return found.select("user_id", "samples", "valid_samples", r("average"), r("normalised"), r("variability_index"))


@query(POWER.replace("{key}", "user_id"))
def normalised_power(t):
    return _power(W.normalised_power(t("events"), "user_id", ["ts", "event_id"], "value"))


@query(POWER.replace("{key}", "event_id % 2"))
def normalised_power_in_chunks(t):
    """Two users have all events."""
    return _power(W.normalised_power(t("events").withColumn("user_id", F.col("event_id") % 2), "user_id", ["ts", "event_id"], "value", longest=2000))


# a customer's price level, from the first day of a month on: what its dearest order of the month before was
FTP = """
WITH f AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) AS valid_from, max(o_totalprice) AS ftp FROM orders GROUP BY 1, 2),
o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d, o_totalprice FROM orders)
SELECT o.o_custkey, o.o_orderkey, CAST(f.valid_from AS VARCHAR) AS valid_from, round(f.ftp, 2) AS ftp_used, round(o.o_totalprice / f.ftp, 4) AS intensity, round(100 * (o.o_totalprice / f.ftp) * (o.o_totalprice / f.ftp), 4) AS stress
FROM o ASOF LEFT JOIN f ON o.o_custkey = f.o_custkey AND o.d >= f.valid_from
"""


def _load(t, longest):
    orders = t("orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    levels = orders.groupBy("o_custkey", F.add_months(F.trunc("d", "month"), 1).alias("valid_from")).agg(F.max("o_totalprice").alias("ftp"))
    found = C.asof_join(orders, levels, ["o_custkey"], "d", "valid_from", ["valid_from", "ftp"], longest)
    intensity = F.col("o_totalprice") / F.col("ftp")
    return found.select("o_custkey", "o_orderkey", F.col("valid_from").cast("string").alias("valid_from"), rounded("ftp", 2).alias("ftp_used"), rounded(intensity, 4).alias("intensity"), rounded(100 * intensity * intensity, 4).alias("stress"))


@query(FTP)
def training_load_as_of(t):
    return _load(t, C.LONGEST)


@query(FTP)
def training_load_in_chunks(t):
    """Every customer with more than ten rows is spread over chunks of ten."""
    return _load(t, 10)


SPANS = "CASE event_id % 5 WHEN 0 THEN 1 WHEN 1 THEN 600 WHEN 2 THEN 90000 WHEN 3 THEN 0 ELSE 40000000 END"


@query(f"""
WITH e AS (SELECT user_id, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS s FROM events)
SELECT i.event_id AS span_id, count(*) AS events, CAST(sum(x.event_id) AS BIGINT) AS ids FROM (SELECT *, s + ({SPANS}) AS b FROM e) i JOIN e x ON x.user_id = i.user_id AND x.s >= i.s AND x.s < i.b GROUP BY 1
""")
def interval_sweep(t):
    """Intervals of a second to more than a year."""
    e = t("events").select("user_id", "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("s"))
    spans = e.select("user_id", F.col("event_id").alias("span_id"), F.col("s").alias("a"), (F.col("s") + F.expr(SPANS)).alias("b"))
    return sweep_join(e, spans, "user_id", "s", "a", "b").groupBy("span_id").agg(F.count("*").alias("events"), F.sum("event_id").alias("ids"))


@query("""
SELECT event_id, count(value) OVER w AS prior, round(median(value) OVER w, 6) AS prior_median FROM events
WINDOW w AS (ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
""")
def medians_in_chunks(t):
    """One user has all events: their running medians must spread over tasks."""
    one = t("events").withColumn("user_id", F.lit(1).cast("long"))
    return running_median(one, ["user_id"], ["ts", "event_id"], "value", longest=2000).select("event_id", "prior", r("prior_median", 6))


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders")
def merge_into_parts(t):
    """Open orders with new prices, and the orders of odd customers that were not there, merged into a table in parts."""
    orders = t("orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"), "o_orderstatus")
    table = RangedTable(orders.sparkSession, f"{shared_folder(orders.sparkSession)}/parts-{uuid.uuid4().hex}", ["o_orderkey"], 4000)
    table.upsert(orders.where("o_custkey % 2 = 0").drop("o_orderstatus"))
    table.upsert(orders.where("o_orderstatus = 'P' or o_custkey % 2 = 1").withColumn("price", F.when(F.col("o_orderstatus") == "P", F.col("price") + 1).otherwise(F.col("price"))).drop("o_orderstatus"))
    return table.read()


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 50000")
def gated_publication(t):
    """Three versions stand before a gate; the middle one, all orders, has prices below the least one and repeated rows, and is refused."""
    orders = t("orders").select("o_orderkey", "o_totalprice")
    checks = [
        Check("key", "CRITICAL", lambda x: V.unique_key(x["prices"], ["o_orderkey"]), tables=("prices",)),
        Check("price", "CRITICAL", lambda x: V.required(x["prices"], ["o_totalprice"], F.col("o_totalprice") >= 50000), tables=("prices",)),
    ]
    spark, ask = orders.sparkSession, gate("prices", checks, {})
    root, good, refused = f"{shared_folder(spark)}/gated-{uuid.uuid4().hex}", orders.where("o_totalprice >= 50000"), 0
    for i, rows in enumerate((good.where("o_orderkey % 2 = 0"), orders.unionByName(orders), good)):
        try:
            publish(spark, rows, root, str(i), gate=ask)
        except Refused:
            refused += 1
    return published(spark, root).where(F.lit(refused == 1))
