"""The load steps end to end."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.functions.values import map_value, money
from tierwork.operators.finance import convert, signed_documents
from tierwork.operators.loads import load_cleaned, load_fact
from tierwork.operators.columns import conform
from tierwork.plans.inputs import DATED_ORDERS, DOCUMENTS, QUARTERLY_RATES, dated_orders, order_lines, stored_rates, with_order
from tierwork.plans.registry import Tables, plan

FIRST, SECOND = dt.date(2024, 2, 1), dt.date(2024, 2, 2)
SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("event_type", T.StringType()),
])


@plan("load_cleaned_events", """
WITH old AS (SELECT user_id, ts, event_id, event_type, ts = max(ts) OVER (PARTITION BY user_id) AS cur FROM events WHERE ts < TIMESTAMP '2024-01-16'),
new AS (SELECT user_id, ts, event_id, CASE WHEN event_type = 'error' THEN 'NaN' ELSE event_type END AS event_type,
  ts = max(ts) OVER (PARTITION BY user_id) AS cur FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND user_id % 5 <> 0),
present AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'signup' AND ts >= TIMESTAMP '2024-01-25')
SELECT user_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN n.cur IS NULL THEN o.event_type ELSE n.event_type END AS event_type,
  CASE WHEN n.cur IS NOT NULL THEN n.cur ELSE o.cur AND user_id NOT IN (SELECT user_id FROM new) END AS is_current, CASE WHEN o.cur IS NULL THEN DATE '2024-02-02' ELSE DATE '2024-02-01' END AS inserted_at,
  CASE WHEN n.cur IS NOT NULL AND (o.cur IS NULL OR o.event_type <> n.event_type) THEN DATE '2024-02-02' ELSE DATE '2024-02-01' END AS modified_at,
  user_id NOT IN (SELECT user_id FROM present) AS is_deleted
FROM old o FULL JOIN new n USING (user_id, ts)
""")
def load_cleaned_events(t: Tables):
    """Two nightly loads: the second overlaps the first, lacks a fifth of the users, and in it errors arrive as blank text."""
    cols = t.events.select("user_id", "ts", "event_type")
    mid, back = (F.lit(d).cast("timestamp_ntz") for d in ("2024-01-16", "2024-01-10"))
    stored = load_cleaned(cols.where(F.col("ts") < mid), None, SCHEMA, ["user_id"], "ts", "delta", FIRST)
    raw = cols.where((F.col("ts") >= back) & (F.col("user_id") % 5 != 0)).withColumn("event_type", F.when(F.col("event_type") == "error", " ").otherwise(F.col("event_type")))
    present = t.events.where((F.col("event_type") == "signup") & (F.col("ts") >= F.lit("2024-01-25").cast("timestamp_ntz")))
    out = load_cleaned(raw, stored, SCHEMA, ["user_id"], "ts", "delta", SECOND, present)
    return out.select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), "event_type", "is_current", "inserted_at",
                      "modified_at", "is_deleted")


@plan("load_star_fact", f"""
WITH {DATED_ORDERS}, marks AS (SELECT o_orderpriority, min(o_date) + 1500 AS mark FROM dated_orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1),
delta AS (SELECT d.* FROM dated_orders d LEFT JOIN marks m ON m.o_orderpriority = d.o_orderpriority WHERE mark IS NULL OR o_date > mark)
SELECT o.o_orderkey, CASE WHEN d.o_orderkey IS NULL THEN -5 ELSE coalesce(c.c_custkey + 7, -1) END AS customer_fk, o.amount::DOUBLE AS amount
FROM dated_orders o LEFT JOIN delta d ON d.o_orderkey = o.o_orderkey LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON c.c_custkey = o.o_custkey
WHERE d.o_orderkey IS NOT NULL OR o.o_date < DATE '1999-01-01'
""")
def load_star_fact(t: Tables):
    o = dated_orders(t)
    marks = o.where("o_orderpriority <> '5-LOW'").groupBy("o_orderpriority").agg(F.date_add(F.min("o_date"), 1500).alias("mark"))
    stored = o.where(F.col("o_date") < "1999-01-01").select("o_orderkey", F.lit(-5).cast("long").alias("customer_fk"), "amount")
    dim = t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_custkey") + 7).alias("customer_pk"))
    fact, _marks = load_fact(o, stored, marks, "o_orderpriority", "o_date", [(dim, ["o_custkey"], "customer_pk")], ["o_orderkey"])
    return fact.withColumn("amount", F.col("amount").cast("double"))


@plan("load_star_marks", f"""
WITH {DATED_ORDERS}
SELECT o_orderpriority, max(o_date) AS mark FROM dated_orders GROUP BY 1
""")
def _(t: Tables):
    o = dated_orders(t)
    marks = o.groupBy("o_orderpriority").agg(F.min("o_date").alias("mark"))
    stored = o.where("false").select("o_orderkey", "amount")
    return load_fact(o, stored, marks, "o_orderpriority", "o_date", [], ["o_orderkey"])[1]


STAGED = T.StructType([T.StructField(n, k) for n, k in [
    ("document_no", T.StringType()), ("line_no", T.IntegerType()), ("document_type", T.StringType()), ("document_source", T.StringType()),
    ("transaction_date", T.DateType()), ("product_code", T.StringType()), ("vendor_code", T.StringType()), ("reseller_code", T.StringType()),
    ("currency_code", T.StringType()), ("revenue_eur", T.DoubleType()), ("cost_eur", T.DoubleType()), ("fx_rate", T.DoubleType()),
    ("serial_no", T.StringType()),
]])


@plan("fact_staging", f"""
WITH {DOCUMENTS}, {QUARTERLY_RATES}, edge AS (SELECT nation, min_by(rate, month) AS rate FROM quarterly_rates GROUP BY 1)
SELECT CAST(o_orderkey AS VARCHAR) AS document_no, l_linenumber AS line_no, CASE l_returnflag WHEN 'R' THEN 'credit' ELSE 'invoice' END AS document_type,
  'erp' AS document_source, o_date AS transaction_date, CAST(l_partkey AS VARCHAR) AS product_code, CAST(l_suppkey AS VARCHAR) AS vendor_code,
  coalesce(CAST(o_custkey AS VARCHAR), 'N/A') AS reseller_code, CASE d.nation WHEN 0 THEN 'CHF' WHEN 1 THEN 'GBP' ELSE 'EUR' END AS currency_code,
  CAST(CASE l_returnflag WHEN 'R' THEN -price ELSE price END::DOUBLE / coalesce(r.rate, e.rate)::DOUBLE AS DECIMAL(18,2))::DOUBLE AS revenue_eur,
  CAST(CASE l_returnflag WHEN 'R' THEN -quantity ELSE quantity END::DOUBLE / coalesce(r.rate, e.rate)::DOUBLE AS DECIMAL(18,2))::DOUBLE AS cost_eur,
  coalesce(r.rate, e.rate)::DOUBLE AS fx_rate, CAST(NULL AS VARCHAR) AS serial_no
FROM doc_lines d LEFT JOIN quarterly_rates r ON r.nation = d.nation AND r.month = date_trunc('month', o_date) LEFT JOIN edge e ON e.nation = d.nation
""")
def fact_staging(t: Tables):
    """Lines of one source system in the common fact shape: earliest-rate fallback, N/A for missing members."""
    lines = order_lines(t).withColumn("cost", money(F.col("quantity")))
    docs = with_order(signed_documents(lines, F.col("l_returnflag") == "R", ["price", "cost"]), t)
    eur = convert(docs, stored_rates(t, filled=False), "nation", "o_date", "month", "rate", ["price", "cost"], "earliest")
    named = eur.select(
        F.col("o_orderkey").alias("document_no"), F.col("l_linenumber").alias("line_no"), "document_type", F.lit("erp").alias("document_source"),
        F.col("o_date").alias("transaction_date"), F.col("l_partkey").alias("product_code"), F.col("l_suppkey").alias("vendor_code"),
        F.coalesce(F.col("o_custkey").cast("string"), F.lit("N/A")).alias("reseller_code"),
        map_value(F.col("nation"), {0: "CHF", 1: "GBP"}, F.lit("EUR")).alias("currency_code"), F.col("price_eur").alias("revenue_eur"), "cost_eur",
        "fx_rate")
    return conform(named, STAGED)


@plan("orders_and_quotes", f"""
WITH {DATED_ORDERS}, v AS (SELECT *, CASE o_orderstatus WHEN 'P' THEN 'quote' ELSE 'order' END AS kind FROM dated_orders)
SELECT o_custkey, kind, o_orderkey FROM v QUALIFY rank() OVER (PARTITION BY o_custkey, kind ORDER BY o_date DESC, o_orderkey DESC) = 1
""")
def _(t: Tables):
    from tierwork.operators.mastering import latest_version

    typed = dated_orders(t).withColumn("kind", map_value(F.col("o_orderstatus"), {"P": "quote"}, F.lit("order")))
    return latest_version(typed, ["o_custkey", "kind"], "o_date", "o_orderkey").select("o_custkey", "kind", "o_orderkey")


@plan("resume_point", """
SELECT coalesce(max(CAST(ts AS DATE)), DATE '1900-01-01') AS next_start FROM events WHERE event_type = 'purchase'
""")
def _(t: Tables):
    from tierwork.sources.readers import next_start

    return next_start(t.events.where("event_type = 'purchase'").withColumn("day", F.to_date("ts")), "day")
