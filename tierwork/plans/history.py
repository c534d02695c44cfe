"""Dimensions with history built from the event log, and fact lookups against them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.operators import history as H
from tierwork.operators.ordered import by_width, keep_first
from tierwork.plans.inputs import DATED_ORDERS, dated_orders, event_log
from tierwork.plans.registry import Tables, plan
from tierwork.sources.storage import cut_lineage

MID = "2024-01-16"


def versions(t: Tables) -> DataFrame:
    log = event_log(t)
    out = H.versions_from_log(log, "user_id", "hash", "ts", ["event_id"])
    return out.drop("hash", "event_id")


ISLANDS = """log AS (SELECT event_id, user_id, event_type, ts FROM events), starts AS (
  SELECT user_id, event_type, ts, event_id FROM (
    SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM log)
  WHERE before IS NULL OR before <> event_type), versions AS (
  SELECT user_id, event_type, ts AS start_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM starts)"""


def _shown(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "user_id", "event_type", F.date_format("start_datetime", "yyyy-MM-dd HH:mm:ss").alias("starts"),
        F.date_format("end_datetime", "yyyy-MM-dd HH:mm:ss").alias("ends"), *more,
    )


@plan("scd2_from_log", f"""
WITH {ISLANDS}
SELECT user_id, event_type, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS starts,
       strftime(coalesce(next_ts, TIMESTAMP '9999-12-31'), '%Y-%m-%d %H:%M:%S') AS ends
FROM versions
""")
def scd2_from_log(t: Tables):
    return _shown(versions(t))


def _stored_dim(t: Tables) -> DataFrame:
    """The dimension as of mid-month."""
    log = event_log(t).where(F.col("ts") < F.lit(MID).cast("timestamp_ntz"))
    out = H.versions_from_log(log, "user_id", "hash", "ts", ["event_id"])
    return cut_lineage(out.withColumn("is_current", (F.col("end_datetime") == F.lit(H.OPEN_END)).cast("int")))


@plan("scd2_apply_log", f"""
WITH {ISLANDS}
SELECT user_id, event_type, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS starts,
       strftime(coalesce(next_ts, TIMESTAMP '9999-12-31'), '%Y-%m-%d %H:%M:%S') AS ends,
       CASE WHEN next_ts IS NULL THEN 1 ELSE 0 END AS is_current
FROM versions
""")
def scd2_apply_log(t: Tables):
    """The log in three parts, the later ones with rows already seen: the history is that of the whole log."""
    log = event_log(t)
    upto = lambda day: log.where(F.col("ts") < F.lit(day).cast("timestamp_ntz"))
    dim = _stored_dim(t)
    for part in (upto("2024-01-23"), log):
        dim = H.apply_log(dim, part, "user_id", "hash", "ts", ["event_id"])
    return _shown(dim, "is_current")


RUN = dt.datetime(2024, 2, 1, 4, 0, 0)


@plan("scd2_close_insert", """
WITH dim AS (
  SELECT c_custkey, c_mktsegment, DATE '1990-01-01' AS start_date, DATE '9999-12-31' AS end_date, 1 AS is_current
  FROM customer WHERE c_acctbal >= 0), updates AS (
  SELECT c_custkey, 'NEW' AS c_mktsegment FROM customer WHERE c_nationkey < 5)
SELECT d.c_custkey, d.c_mktsegment, start_date,
       CASE WHEN u.c_custkey IS NULL THEN end_date ELSE DATE '2024-02-01' END AS end_date,
       CASE WHEN u.c_custkey IS NULL THEN 1 ELSE 0 END AS is_current
FROM dim d LEFT JOIN updates u ON u.c_custkey = d.c_custkey
UNION ALL SELECT c_custkey, c_mktsegment, DATE '2024-02-01', DATE '9999-12-31', 1 FROM updates
""")
def _(t: Tables):
    dim = t.customer.where("c_acctbal >= 0").select(
        "c_custkey", "c_mktsegment", F.lit(H.FIRST_START).alias("start_datetime"),
        F.lit(H.OPEN_END).alias("end_datetime"), F.lit(1).alias("is_current"))
    updates = t.customer.where("c_nationkey < 5").select("c_custkey", F.lit("NEW").alias("c_mktsegment"))
    return H.close_and_insert(dim, updates, "c_custkey", RUN).select(
        "c_custkey", "c_mktsegment", F.to_date("start_datetime").alias("start_date"),
        F.to_date("end_datetime").alias("end_date"), "is_current")


def _customer_versions(t: Tables) -> DataFrame:
    """Two versions per customer: until and from 1998, keyed by customer number; new customers start in 1996."""
    c = t.customer.select("c_custkey", F.when(F.col("c_nationkey") < 10, dt.date(1996, 1, 1)).otherwise(dt.date(1990, 1, 1)).alias("born"))
    v = c.select("c_custkey", "born", F.explode(F.array(F.lit(0), F.lit(1))).alias("v"))
    return v.select(
        "c_custkey", (F.col("c_custkey") * 2 + F.col("v")).alias("customer_pk"),
        F.when(F.col("v") == 0, F.col("born")).otherwise(dt.date(1998, 1, 1)).alias("start_datetime"),
        F.when(F.col("v") == 0, dt.date(1998, 1, 1)).alias("end_datetime"))


def _order_facts(t: Tables) -> DataFrame:
    return dated_orders(t).select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_date")


VERSIONS = """versions AS (
  SELECT c_custkey, c_custkey * 2 AS pk, CASE WHEN c_nationkey < 10 THEN DATE '1996-01-01' ELSE DATE '1990-01-01' END AS s,
         DATE '1998-01-01' AS e FROM customer
  UNION ALL SELECT c_custkey, c_custkey * 2 + 1, DATE '1998-01-01', DATE '9999-12-31' FROM customer)"""


@plan("point_in_time_lookup", f"""
WITH {DATED_ORDERS}, {VERSIONS}
SELECT o_orderkey, coalesce(pk, -1) AS customer_fk FROM dated_orders
LEFT JOIN versions ON c_custkey = o_custkey AND o_date >= s AND o_date < e
""")
def point_in_time_lookup(t: Tables):
    return H.point_in_time(_order_facts(t), _customer_versions(t), "c_custkey", "o_date", "customer_pk", "customer_fk").select(
        "o_orderkey", "customer_fk")


@plan("point_in_time_many_versions", f"""
WITH {ISLANDS}
SELECT e.event_id, coalesce(v.start_event, -1) AS version_fk FROM events e LEFT JOIN (
  SELECT v.user_id, v.start_ts, v.next_ts, l.event_id AS start_event FROM versions v JOIN log l ON l.user_id = v.user_id AND l.ts = v.start_ts) v
ON v.user_id = e.user_id AND e.ts - INTERVAL 1 HOUR >= v.start_ts AND (v.next_ts IS NULL OR e.ts - INTERVAL 1 HOUR < v.next_ts)
""")
def point_in_time_many_versions(t: Tables):
    """Which version of its user was valid an hour before each event."""
    log = t.events.select("event_id", "user_id", F.sha2("event_type", 256).alias("hash"), F.col("ts").cast("timestamp").alias("ts"))
    dim = H.versions_from_log(log, "user_id", "hash", "ts")
    facts = log.select(F.col("event_id").alias("fact_id"), "user_id", (F.col("ts") - F.expr("interval 1 hour")).alias("ts"))
    out = H.point_in_time_ordered(facts, dim, "user_id", "ts", "event_id", "version_fk", None)
    return out.select(F.col("fact_id").alias("event_id"), "version_fk")


@plan("pit_fallback", f"""
WITH {DATED_ORDERS}, {VERSIONS}, found AS (
  SELECT o_orderkey, o_custkey, coalesce(pk, -1) AS fk FROM dated_orders
  LEFT JOIN versions ON c_custkey = o_custkey AND o_date >= s AND o_date < e)
SELECT o_orderkey, CASE WHEN fk = -1 THEN o_custkey * 2 ELSE fk END AS customer_fk FROM found
""")
def _(t: Tables):
    dim = _customer_versions(t)
    found = H.point_in_time(_order_facts(t), dim, "c_custkey", "o_date", "customer_pk", "customer_fk")
    return H.fallback_earliest(found, dim, "c_custkey", "customer_pk", "customer_fk").select("o_orderkey", "customer_fk")


@plan("key_lookup", """
SELECT l_orderkey, l_linenumber, coalesce(p.p_partkey + 1000, -1) AS part_fk, coalesce(s.s_suppkey + 1, -1) AS supplier_fk
FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size < 45) p ON p.p_partkey = l_partkey
LEFT JOIN supplier s ON s.s_suppkey = l_suppkey
""")
def key_lookup(t: Tables):
    parts = t.part.where("p_size < 45").select(F.col("p_partkey").alias("l_partkey"), (F.col("p_partkey") + 1000).alias("part_pk"))
    supps = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), (F.col("s_suppkey") + 1).alias("supplier_pk"))
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return H.lookup_dimension_keys(fact, [(parts, ["l_partkey"], "part_pk"), (supps, ["l_suppkey"], "supplier_pk")])


@plan("dimension_staging", """
WITH used AS (SELECT DISTINCT l_suppkey FROM lineitem), labels_ AS (
  SELECT s_suppkey, max(s_name) AS s_name, max(s_nationkey) AS s_nationkey FROM supplier GROUP BY 1), staged AS (
  SELECT s_suppkey AS code, s_name AS name, n_name AS country FROM labels_ JOIN nation ON n_nationkey = s_nationkey
  UNION ALL
  SELECT l_suppkey, 'N/A', 'N/A' FROM used WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal IS NOT NULL))
SELECT row_number() OVER (ORDER BY code) AS vendor_pk, code, name, country FROM staged
""")
def _(t: Tables):
    vendors = keep_first(t.supplier, ["s_suppkey"], [F.col("s_name").desc()]).join(
        t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name"), "s_nationkey"
    ).select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name"), F.col("n_name").alias("country"))
    late = H.late_members(
        t.lineitem.select(F.col("l_suppkey").alias("code")), vendors, "code", {"name": F.lit("N/A"), "country": F.lit("N/A")})
    return H.surrogate_keys(vendors.unionByName(late), ["code"], by_width("code", 1_000_000), None, "vendor_pk")
