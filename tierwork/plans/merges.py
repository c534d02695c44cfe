"""Change capture on the given tables: orders split by date into a stored target and a new batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.functions.values import row_hash
from tierwork.operators import cdc
from tierwork.operators.history import (
    FIRST_START, OPEN_END, changed_since, default_members, late_members, merge_dimension, overwrite_or_insert, staged_start,
)
from tierwork.plans.inputs import DATED_ORDERS, dated_orders
from tierwork.plans.registry import hash_sql, plan, Tables

CUT = dt.date(1999, 6, 30)
BATCH_START = dt.date(1997, 1, 1)
OLD, NEW = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def stored(t: Tables) -> DataFrame:
    """Orders up to the cut, as loaded yesterday."""
    o = dated_orders(t).where(F.col("o_date") <= F.lit(CUT))
    return o.select(
        "o_orderkey", F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"),
        row_hash([F.col("o_orderpriority"), F.col("o_orderstatus")]).alias("hash"),
        F.lit(True).alias("is_current"), F.lit(OLD).alias("inserted"), F.lit(OLD).alias("modified"),
    )


def batch(t: Tables) -> DataFrame:
    """Orders from 1997 on; open ones have been closed since, and pending ones are not current."""
    o = dated_orders(t).where(F.col("o_date") >= F.lit(BATCH_START))
    status = F.when(F.col("o_orderstatus") == "O", F.lit("F")).otherwise(F.col("o_orderstatus"))
    return o.select(
        "o_orderkey", F.col("o_orderpriority").alias("priority"), status.alias("status"),
        row_hash([F.col("o_orderpriority"), status]).alias("hash"),
        (F.col("o_orderstatus") != "P").alias("is_current"), F.lit(NEW).alias("inserted"), F.lit(NEW).alias("modified"),
    )


SIDES = DATED_ORDERS + """, stored AS (
  SELECT o_orderkey, o_orderpriority AS priority, o_orderstatus AS status, TRUE AS is_current,
         DATE '2024-01-01' AS inserted, DATE '2024-01-01' AS modified
  FROM dated_orders WHERE o_date <= DATE '1999-06-30'), batch AS (
  SELECT o_orderkey, o_orderpriority AS priority, CASE WHEN o_orderstatus = 'O' THEN 'F' ELSE o_orderstatus END AS status,
         o_orderstatus <> 'P' AS is_current, DATE '2024-01-02' AS inserted, DATE '2024-01-02' AS modified
  FROM dated_orders WHERE o_date >= DATE '1997-01-01')"""
KEYS = ["o_orderkey"]
SHOWN = ["o_orderkey", "priority", "status", "is_current", "inserted", "modified"]


@plan("merge_upsert", f"""
WITH {SIDES}
SELECT o_orderkey, coalesce(b.priority, s.priority) AS priority,
       CASE WHEN b.status IS NULL THEN s.status ELSE b.status END AS status,
       CASE WHEN b.status IS NULL THEN FALSE ELSE b.is_current END AS is_current,
       coalesce(s.inserted, b.inserted) AS inserted,
       CASE WHEN s.status IS NULL OR b.status <> s.status OR b.priority <> s.priority THEN b.modified ELSE s.modified END AS modified
FROM stored s FULL JOIN batch b USING (o_orderkey)
""")
def merge_upsert(t: Tables):
    return cdc.merge_upsert(stored(t), batch(t), KEYS, "hash", "is_current", keep_cols=["inserted"]).select(*SHOWN)


@plan("merge_stage2", f"""
WITH {SIDES}, source AS (SELECT * REPLACE (TRUE AS is_current) FROM batch WHERE is_current)
SELECT o_orderkey, CASE WHEN b.status IS NULL THEN s.status ELSE b.status END AS status,
       b.status IS NOT NULL AS is_current, coalesce(s.inserted, b.inserted) AS inserted,
       CASE WHEN b.status IS NOT NULL AND (s.status IS NULL OR b.status <> s.status OR b.priority <> s.priority)
            THEN b.modified ELSE s.modified END AS modified
FROM stored s FULL JOIN source b USING (o_orderkey)
""")
def merge_stage2(t: Tables):
    source = cdc.current_rows(batch(t))
    out = cdc.merge_current(stored(t), source, KEYS, "hash", "is_current", keep_cols=["inserted"])
    return out.select("o_orderkey", "status", "is_current", "inserted", "modified")


@plan("fact_upsert", f"""
WITH {SIDES}
SELECT o_orderkey, coalesce(b.priority, s.priority) AS priority, coalesce(b.status, s.status) AS status,
       coalesce(b.is_current, s.is_current) AS is_current, coalesce(b.inserted, s.inserted) AS inserted,
       coalesce(b.modified, s.modified) AS modified
FROM stored s FULL JOIN batch b USING (o_orderkey)
""")
def fact_upsert(t: Tables):
    return cdc.merge_upsert(stored(t), batch(t), KEYS, deactivate_absent=False).select(*SHOWN)


@plan("fill_drop_init", """
SELECT doc_id, CASE WHEN label IS NULL OR trim(label) = '' THEN 'NaN' ELSE label END AS label
FROM (SELECT d.doc_id, CASE WHEN quality = 1 THEN 'good' WHEN quality = 0 THEN ' ' END AS label
      FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id) WHERE doc_id IS NOT NULL
""")
def _(t: Tables):
    labelled = t.documents.select("doc_id").join(t.labels, "doc_id", "left").select(
        "doc_id", F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, " ").alias("label"))
    first_load = cdc.drop_null_keys(cdc.fill_missing(labelled), ["doc_id"])
    return cdc.load_or_merge(None, first_load, ["doc_id"])


@plan("soft_delete", """
SELECT o_orderkey, o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS is_deleted FROM orders
""")
def _(t: Tables):
    target = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), F.lit(False).alias("is_deleted"))
    return cdc.soft_delete(target, t.customer.where("c_acctbal >= 0"), ["c_custkey"]).drop("c_custkey")


for mode, sql in {
    "delta": "ts = max(ts) OVER (PARTITION BY user_id)",
    "most-recent": "ts = max(ts) OVER ()",
    "full": "TRUE",
}.items():
    @plan(f"current_flag_{mode.replace('-', '_')}", f"SELECT event_id, user_id, {sql} AS is_current FROM events")
    def _(t: Tables, mode=mode):
        flagged = cdc.current_flag(t.events.select("event_id", "user_id", "ts"), mode, ["user_id"], "ts")
        return flagged.drop("ts")


@plan("current_rows", """
SELECT event_id, user_id, event_type FROM events QUALIFY ts = max(ts) OVER (PARTITION BY user_id)
""")
def _(t: Tables):
    cols = t.events.select("event_id", "user_id", "event_type", "ts")
    return cdc.current_rows(cdc.current_flag(cols, "delta", ["user_id"], "ts")).drop("ts", "is_current")


@plan("row_hash", f"""
SELECT c_custkey, {hash_sql('c_name', 'c_mktsegment', "nullif(c_mktsegment, 'BUILDING')")} AS hash
FROM customer
""")
def _(t: Tables):
    c = [F.col("c_name"), F.col("c_mktsegment"), F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))]
    return t.customer.select("c_custkey", row_hash(c).alias("hash"))


@plan("dedupe_keys_then_hash", """
WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_returnflag, l_shipdate, l_extendedprice) = 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM a
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_returnflag ORDER BY l_orderkey, l_linenumber) = 1
""")
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice")
    hashed = lines.withColumn("hash", row_hash([F.col(c) for c in ("l_partkey", "l_suppkey", "l_returnflag")]))
    order = ["l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_extendedprice"]
    return cdc.dedupe(hashed, ["l_orderkey", "l_linenumber"], order, "hash").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def _facts(t: Tables):
    """Stored facts up to the cut and a source in which high-priority old orders were withdrawn."""
    o = dated_orders(t).select("o_orderkey", "o_date", "o_orderpriority", "o_orderstatus")
    fact = o.where(F.col("o_date") <= F.lit(CUT)).withColumn("is_active", F.col("o_orderstatus") != "P")
    source = o.withColumn("is_deleted", F.col("o_orderpriority") == "1-URGENT")
    return fact, source


@plan("fact_delta", f"""
WITH {DATED_ORDERS}
SELECT o_orderkey, o_orderpriority = '1-URGENT' AS is_deleted FROM dated_orders
WHERE o_date > DATE '1999-06-30' OR (o_orderpriority = '1-URGENT' AND o_orderstatus <> 'P')
""")
def _(t: Tables):
    fact, source = _facts(t)
    return cdc.fact_delta(source, fact, "o_orderkey", "is_active").select("o_orderkey", "is_deleted")


@plan("deactivate_and_append", f"""
WITH {DATED_ORDERS}
SELECT o_orderkey, o_orderstatus <> 'P' AND NOT (o_orderpriority = '1-URGENT') AS is_active
FROM dated_orders WHERE o_date <= DATE '1999-06-30'
UNION ALL
SELECT o_orderkey, TRUE FROM dated_orders WHERE o_date > DATE '1999-06-30' AND o_orderpriority <> '1-URGENT'
""")
def _(t: Tables):
    fact, source = _facts(t)
    delta = cdc.fact_delta(source, fact, "o_orderkey", "is_active")
    return cdc.deactivate_and_append(fact, delta, ["o_orderkey"]).select("o_orderkey", "is_active")


MARKS = """marks AS (SELECT o_orderpriority, CASE WHEN o_orderpriority < '3' THEN DATE '2000-01-01' ELSE DATE '1999-01-01' END AS mark
  FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY o_orderpriority)"""


def _marks(t: Tables) -> DataFrame:
    """A stored mark per priority (standing for a source system); the last one has none yet."""
    return t.orders.where("o_orderpriority <> '5-LOW'").select("o_orderpriority").distinct().withColumn(
        "mark", F.when(F.col("o_orderpriority") < "3", dt.date(2000, 1, 1)).otherwise(dt.date(1999, 1, 1)))


@plan("fact_delta_by_source", f"""
WITH {DATED_ORDERS}, {MARKS}
SELECT o_orderkey, d.o_orderpriority FROM dated_orders d LEFT JOIN marks m ON m.o_orderpriority = d.o_orderpriority
WHERE mark IS NULL OR o_date > mark
""")
def _(t: Tables):
    return cdc.delta_by_source(dated_orders(t), _marks(t), "o_orderpriority", "o_date", "mark").select(
        "o_orderkey", "o_orderpriority")


@plan("new_marks_by_source", f"""
WITH {DATED_ORDERS}, {MARKS}
SELECT o_orderpriority, max(mark) AS mark FROM (
  SELECT o_orderpriority, mark FROM marks UNION ALL SELECT o_orderpriority, o_date FROM dated_orders) GROUP BY 1
""")
def _(t: Tables):
    seen = cdc.new_marks(dated_orders(t), "o_orderpriority", "o_date", "mark")
    return cdc.advance_watermark(_marks(t), seen, ["o_orderpriority"], "mark")


@plan("latest_stats", """
SELECT user_id, CAST(ts AS DATE) AS day, event_id FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id) = 1
""")
def _(t: Tables):
    e = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id", "ts")
    return cdc.latest_stats(e, ["user_id", "day"], "ts", ["event_id"]).drop("ts")


@plan("one_set_per_day", """
SELECT event_id, user_id FROM events QUALIFY ts = max(ts) OVER (PARTITION BY CAST(ts AS DATE))
""")
def _(t: Tables):
    return cdc.one_set_per_day(t.events.select("event_id", "user_id", "ts"), "ts").drop("ts")


@plan("staged_start", """
SELECT s_suppkey, CASE WHEN s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1995-01-20')
  THEN DATE '2024-05-01' ELSE DATE '1990-01-01' END AS start_date FROM supplier
""")
def _(t: Tables):
    known = t.lineitem.where(F.col("l_shipdate") < F.lit("1995-01-20").cast("timestamp_ntz")).select(F.col("l_suppkey").alias("s_suppkey"))
    return staged_start(t.supplier.select("s_suppkey"), known, ["s_suppkey"], dt.datetime(2024, 5, 1)).select(
        "s_suppkey", F.to_date("start_datetime").alias("start_date"))


@plan("default_members", """
SELECT s.c_nationkey AS source, k.member_type, 'N/A' AS code
FROM (SELECT DISTINCT c_nationkey FROM customer) s CROSS JOIN (VALUES ('item'), ('resource')) k(member_type)
WHERE NOT (k.member_type = 'item' AND s.c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 0))
""")
def _(t: Tables):
    existing = t.nation.where("n_regionkey = 0").select(
        F.col("n_nationkey").alias("source"), F.lit("item").alias("member_type"), F.lit("N/A").alias("code"))
    sources = t.customer.select(F.col("c_nationkey").alias("source"))
    return default_members(existing, sources, "source", ["item", "resource"], "member_type", {"code": F.lit("N/A")})


@plan("late_members", """
SELECT DISTINCT l_partkey AS p_partkey, 'late' AS p_name FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 40)
""")
def _(t: Tables):
    master = t.part.where("p_size < 40")
    facts = t.lineitem.select(F.col("l_partkey").alias("p_partkey"))
    return late_members(facts, master, "p_partkey", {"p_name": F.lit("late")})


@plan("overwrite_rate_or_insert", """
SELECT coalesce(a.n_nationkey, b.c_nationkey) AS nation, coalesce(b.rate, a.rate) AS rate
FROM (SELECT n_nationkey, 100 AS rate FROM nation WHERE n_regionkey < 3) a
FULL JOIN (SELECT c_nationkey, count(*) AS rate FROM customer GROUP BY 1) b ON a.n_nationkey = b.c_nationkey
""")
def _(t: Tables):
    dim = t.nation.where("n_regionkey < 3").select(F.col("n_nationkey").alias("nation"), F.lit(100).cast("long").alias("rate"))
    new = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("rate"))
    return overwrite_or_insert(dim, new, ["nation"], "rate")


@plan("changed_since_last_load", f"""
WITH {DATED_ORDERS}
SELECT o_orderkey, o_orderpriority FROM dated_orders d
WHERE o_date > coalesce((SELECT max(o_date) FROM dated_orders x
  WHERE x.o_orderpriority = d.o_orderpriority AND x.o_orderpriority <> '5-LOW' AND x.o_orderstatus = 'P' AND x.o_date < DATE '2000-01-01'),
  DATE '1990-01-01')
""")
def _(t: Tables):
    o = dated_orders(t).withColumn("changed", F.col("o_date").cast("timestamp"))
    dim = o.where("o_orderpriority <> '5-LOW' and o_orderstatus = 'P' and o_date < date '2000-01-01'").select(
        "o_orderpriority", F.col("changed").alias("inserted"), F.lit(None).cast("timestamp").alias("modified"))
    return changed_since(o, dim, "o_orderpriority", "changed", ["inserted", "modified"]).select("o_orderkey", "o_orderpriority")


@plan("dimension_merge_by_source", """
WITH src AS (SELECT c_custkey AS code, c_mktsegment AS system, c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS area,
    TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 AS INT)) AS changed FROM customer),
dim AS (SELECT c_custkey AS code, c_mktsegment AS system, c_nationkey AS area, TIMESTAMP '2024-01-01' + to_days(CAST(n_regionkey * 5 AS INT)) AS inserted
  FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 5 <> 0 AND c_mktsegment <> 'BUILDING'),
last AS (SELECT system, max(inserted) AS last FROM dim GROUP BY 1),
fresh AS (SELECT s.* FROM src s LEFT JOIN last l ON l.system = s.system LEFT JOIN dim d ON d.code = s.code AND d.system = s.system AND d.area = s.area
  WHERE s.changed > coalesce(l.last, TIMESTAMP '1990-01-01') AND d.code IS NULL)
SELECT d.code, d.system, d.area, CASE WHEN f.code IS NULL THEN 1 ELSE 0 END AS is_current,
  CASE WHEN f.code IS NULL THEN DATE '9999-12-31' ELSE DATE '2024-02-29' END AS ends FROM dim d LEFT JOIN fresh f ON f.code = d.code
UNION ALL SELECT code, system, area, 1, DATE '9999-12-31' FROM fresh
""")
def dimension_merge_by_source(t: Tables):
    """Changed rows per source system, close, insert, in one step; one system was never loaded, some rows are equal to what is stored."""
    day = lambda n: F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(n.cast("int"))
    who = t.customer.select(F.col("c_custkey").alias("code"), F.col("c_mktsegment").alias("system"), F.col("c_nationkey").alias("area"))
    source = who.withColumn("area", F.col("area") + (F.col("code") % 3 == 0).cast("int")).withColumn("changed", day(F.col("code") % 40))
    regions = t.nation.select(F.col("n_nationkey").alias("area"), "n_regionkey")
    dim = who.where("code % 5 <> 0 AND system <> 'BUILDING'").join(regions, "area").select(
        "code", "system", "area", day(F.col("n_regionkey") * 5).alias("inserted"), F.lit(None).cast("timestamp").alias("modified"),
        F.lit(FIRST_START).alias("start_datetime"), F.lit(OPEN_END).alias("end_datetime"), F.lit(1).alias("is_current"))
    source = source.withColumn("area", F.col("area").cast(dim.schema["area"].dataType))
    out = merge_dimension(dim, source, "code", "system", "changed", ["inserted", "modified"], dt.datetime(2024, 3, 1))
    return out.select("code", "system", "area", "is_current", F.to_date("end_datetime").alias("ends"))
