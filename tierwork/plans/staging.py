"""Staging of a dimension and of facts from several stand-in source systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.operators.staging import in_shape, survive
from tierwork.plans.registry import Tables, plan

# attribute -> sources, best first
BEST = {
    "name": ("erp", "crm"), "country": ("crm", "erp"), "segment": ("crm", "shop", "erp"), "status": ("shop", "crm"),
    "contact": ("shop",), "priority": ("crm", "erp"), "credit": ("erp", "crm"),
}
SOURCES = """erp AS (
  SELECT c_custkey AS code, 'erp' AS source, TIMESTAMP '2024-01-01' AS changed, CASE WHEN c_custkey % 3 = 0 THEN 'N/A' ELSE c_name END AS name,
         n_name AS country, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS segment, NULL AS status, NULL AS contact, NULL AS priority,
         CAST(c_acctbal AS DECIMAL(18,2)) AS credit FROM customer JOIN nation ON n_nationkey = c_nationkey),
crm AS (
  SELECT o_custkey, 'crm', CAST(o_orderdate AS TIMESTAMP), 'Account ' || o_custkey, CASE WHEN o_custkey % 5 = 0 THEN 'Elsewhere' END, CASE WHEN o_orderkey % 7 = 0 THEN 'KEY ACCOUNT' END,
         CASE o_orderstatus WHEN 'F' THEN 'closed' WHEN 'O' THEN 'open' END, NULL, o_orderpriority, CAST(o_totalprice AS DECIMAL(18,2)) FROM orders),
shop AS (
  SELECT user_id, 'shop', CAST(ts AS TIMESTAMP), 'ignored', NULL, CASE WHEN event_type = 'purchase' THEN 'WEB' END, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'NaN' END,
         'user' || user_id || '@example.com', NULL, NULL FROM events),
rows_ AS (SELECT * FROM erp UNION ALL SELECT * FROM crm UNION ALL SELECT * FROM shop)"""


def _survivor_sql() -> str:
    """Each attribute by a window over all rows that have it."""
    parts = []
    for name, order in BEST.items():
        known = f"{name} IS NOT NULL" + ("" if name == "credit" else f" AND trim({name}) NOT IN ('', 'N/A', 'NaN')")
        rank = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(order))
        listed = ", ".join(f"'{s}'" for s in order)
        parts.append(f"""{name}_ AS (SELECT code, {name} AS v, source AS s FROM rows_ WHERE {known} AND source IN ({listed})
  QUALIFY row_number() OVER (PARTITION BY code ORDER BY CASE source {rank} END, changed DESC, {name}) = 1)""")
    out = ", ".join(f"{n}_.v{'::DOUBLE' if n == 'credit' else ''} AS {n}, {n}_.s AS {n}_source" for n in BEST)
    joins = " ".join(f"LEFT JOIN {n}_ ON {n}_.code = k.code" for n in BEST)
    return f"WITH {SOURCES}, {', '.join(parts)} SELECT k.code, {out} FROM (SELECT DISTINCT code FROM rows_ WHERE code IS NOT NULL) k {joins}"


def _sources(t: Tables) -> DataFrame:
    none = lambda kind="string": F.lit(None).cast(kind)
    names = ["code", "source", "changed", "name", "country", "segment", "status", "contact", "priority", "credit"]
    money = lambda c: F.col(c).cast("decimal(18,2)")
    erp = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey"), F.lit("erp"), F.lit("2024-01-01").cast("timestamp"), F.when(F.col("c_custkey") % 3 == 0, "N/A").otherwise(F.col("c_name")), "n_name",
        F.when(F.col("c_custkey") % 4 == 0, "").otherwise(F.col("c_mktsegment")), none(), none(), none(), money("c_acctbal"))
    crm = t.orders.select(
        "o_custkey", F.lit("crm"), F.col("o_orderdate").cast("timestamp"), F.concat(F.lit("Account "), F.col("o_custkey")), F.when(F.col("o_custkey") % 5 == 0, "Elsewhere"),
        F.when(F.col("o_orderkey") % 7 == 0, "KEY ACCOUNT"), F.when(F.col("o_orderstatus") == "F", "closed").when(F.col("o_orderstatus") == "O", "open"), none(),
        "o_orderpriority", money("o_totalprice"))
    shop = t.events.select(
        "user_id", F.lit("shop"), F.col("ts").cast("timestamp"), F.lit("ignored"), none(), F.when(F.col("event_type") == "purchase", "WEB"),
        F.when(F.col("event_id") % 2 == 0, F.col("event_type")).otherwise("NaN"), F.concat(F.lit("user"), F.col("user_id"), F.lit("@example.com")), none(), none("decimal(18,2)"))
    return erp.toDF(*names).unionByName(crm.toDF(*names)).unionByName(shop.toDF(*names))


@plan("dimension_survivorship", _survivor_sql())
def dimension_survivorship(t: Tables):
    """Resellers of three sources: each attribute from the best source that has it."""
    return survive(_sources(t), ["code"], "source", "changed", BEST).withColumn("credit", F.col("credit").cast("double"))


# the common shape of facts: texts, then dates, then whole numbers, then amounts
TEXTS = ("document_no", "document_type", "document_source", "entity_code", "product_code", "vendor_code", "reseller_code", "end_customer", "currency_code", "order_no",
         "order_status", "priority", "serial_no", "description", "technology", "country", "region", "channel", "campaign", "external_ref")
DATES = ("transaction_date", "order_date", "ship_date")
NUMBERS = ("line_no", "order_line_no")
AMOUNTS = ("quantity", "revenue", "cost", "discount", "tax", "margin", "list_price", "balance")
SHAPE = T.StructType([
    *(T.StructField(n, T.StringType()) for n in TEXTS), *(T.StructField(n, T.DateType()) for n in DATES),
    *(T.StructField(n, T.IntegerType()) for n in NUMBERS), *(T.StructField(n, T.DecimalType(18, 2)) for n in AMOUNTS)])


def _shape_sql(source: str, given: dict[str, str], tables: str) -> str:
    cols = []
    for n in SHAPE.names:
        kind = "VARCHAR" if n in TEXTS else "DATE" if n in DATES else "INT" if n in NUMBERS else "DECIMAL(18,2)"
        value = f"CAST({f"'{source}'" if n == 'document_source' else given.get(n, 'NULL')} AS {kind})"
        cols.append(f"{f"coalesce({value}, 'N/A')" if n in TEXTS else value}{'::DOUBLE' if n in AMOUNTS else ''} AS {n}")
    return f"SELECT {', '.join(cols)} FROM {tables}"


FACTS_SQL = " UNION ALL ".join([
    _shape_sql("erp", {
        "document_no": "l_orderkey", "document_type": "CASE l_returnflag WHEN 'R' THEN 'credit' ELSE 'invoice' END", "product_code": "l_partkey", "vendor_code": "l_suppkey",
        "order_no": "l_orderkey", "order_status": "l_linestatus", "transaction_date": "l_shipdate", "ship_date": "l_shipdate", "line_no": "l_linenumber",
        "order_line_no": "l_linenumber", "quantity": "l_quantity", "revenue": "CASE l_returnflag WHEN 'R' THEN -l_extendedprice ELSE l_extendedprice END",
        "discount": "l_discount", "tax": "l_tax", "technology": "p_type", "description": "p_name", "list_price": "p_retailprice"},
        "lineitem LEFT JOIN part ON p_partkey = l_partkey"),
    _shape_sql("crm", {
        "document_no": "'Q' || o_orderkey", "document_type": "CASE o_orderstatus WHEN 'P' THEN 'quote' ELSE 'order' END", "entity_code": "c_nationkey", "reseller_code": "o_custkey",
        "end_customer": "c_name", "order_no": "o_orderkey", "order_status": "o_orderstatus", "priority": "o_orderpriority", "country": "n_name", "region": "n_regionkey",
        "transaction_date": "o_orderdate", "order_date": "o_orderdate", "revenue": "o_totalprice", "balance": "c_acctbal"},
        "orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey"),
    _shape_sql("shop", {
        "document_no": "'E' || event_id", "document_type": "event_type", "reseller_code": "user_id", "channel": "'web'", "external_ref": "props", "transaction_date": "ts",
        "currency_code": "CASE user_id % 2 WHEN 0 THEN 'EUR' END", "revenue": "value"}, "events"),
])


@plan("fact_staging_sources", FACTS_SQL)
def fact_staging_sources(t: Tables):
    """Invoices, orders and quotes, and shop events in one shape of 33 columns."""
    c, when = F.col, F.when
    erp = in_shape(t.lineitem.join(t.part, c("p_partkey") == c("l_partkey"), "left"), "erp", SHAPE, {
        "document_no": "l_orderkey", "document_type": when(c("l_returnflag") == "R", "credit").otherwise("invoice"), "product_code": "l_partkey", "vendor_code": "l_suppkey",
        "order_no": "l_orderkey", "order_status": "l_linestatus", "transaction_date": "l_shipdate", "ship_date": "l_shipdate", "line_no": "l_linenumber",
        "order_line_no": "l_linenumber", "quantity": "l_quantity", "revenue": when(c("l_returnflag") == "R", -c("l_extendedprice")).otherwise(c("l_extendedprice")),
        "discount": "l_discount", "tax": "l_tax", "technology": "p_type", "description": "p_name", "list_price": "p_retailprice"})
    ordered = t.orders.join(t.customer, c("c_custkey") == c("o_custkey"), "left").join(t.nation, c("n_nationkey") == c("c_nationkey"), "left")
    crm = in_shape(ordered, "crm", SHAPE, {
        "document_no": F.concat(F.lit("Q"), "o_orderkey"), "document_type": when(c("o_orderstatus") == "P", "quote").otherwise("order"), "entity_code": "c_nationkey",
        "reseller_code": "o_custkey", "end_customer": "c_name", "order_no": "o_orderkey", "order_status": "o_orderstatus", "priority": "o_orderpriority", "country": "n_name",
        "region": "n_regionkey", "transaction_date": "o_orderdate", "order_date": "o_orderdate", "revenue": "o_totalprice", "balance": "c_acctbal"})
    shop = in_shape(t.events, "shop", SHAPE, {
        "document_no": F.concat(F.lit("E"), "event_id"), "document_type": "event_type", "reseller_code": "user_id", "channel": F.lit("web"), "external_ref": "props",
        "transaction_date": "ts", "currency_code": when(c("user_id") % 2 == 0, "EUR"), "revenue": "value"})
    staged = erp.unionByName(crm).unionByName(shop)
    return staged.select(*[c(n).cast("double").alias(n) if n in AMOUNTS else c(n) for n in SHAPE.names])
