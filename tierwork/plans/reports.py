"""Configured reports and nested rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierwork.functions.dates import month_start
from tierwork.functions.values import money
from tierwork.operators import reports as R
from tierwork.operators.lookups import explode_quantity, stacked_quantities
from tierwork.operators.ordered import with_group_stats
from tierwork.plans.inputs import DOCUMENTS, NATION_ORDERS, documents, nation_orders, order_lines, with_order
from tierwork.plans.registry import Tables, plan

LINES = (
    R.Line("Final revenue", "status", "F"), R.Line("Urgent", "priority", "1-URGENT"), R.Line("Open revenue", "status", "O"),
    R.Line("Headcount"), R.Line("Final again", "status", "F"),
)


@plan("report_rows", f"""
WITH {NATION_ORDERS}, a AS (SELECT 'N' || nation AS country, CAST(date_trunc('month', o_date) AS DATE) AS month, o_orderstatus AS status, o_orderpriority AS priority,
  amount AS revenue, 0 AS budget, TRUE AS act FROM nation_orders
  UNION ALL SELECT 'N' || nation, CAST(date_trunc('month', o_date) AS DATE), o_orderstatus, o_orderpriority, 0, amount * 2, FALSE FROM nation_orders WHERE o_date >= DATE '2000-01-01'),
c AS (SELECT * FROM (VALUES (1, 'Final revenue', 'status', 'F'), (2, 'Urgent', 'priority', '1-URGENT'), (3, 'Open revenue', 'status', 'O'), (5, 'Final again', 'status', 'F')) v(order_id, description, lvl, val))
SELECT 'review' AS report_type, order_id, description, country, month, sum(revenue)::DOUBLE AS revenue, sum(budget)::DOUBLE AS budget
FROM a JOIN c ON CASE lvl WHEN 'status' THEN status ELSE priority END = val GROUP BY order_id, description, country, month, act
UNION ALL SELECT 'review', 4, 'Headcount', '<placeholder>', DATE '1900-01-01', 0, 0
""")
def report_rows(t: Tables):
    actual = nation_orders(t).select(
        F.concat(F.lit("N"), F.col("nation")).alias("country"), month_start(F.col("o_date")).alias("month"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "amount", "o_date")
    budget = actual.where(F.col("o_date") >= "2000-01-01").withColumn("amount", money(F.col("amount") * 2))
    out = R.report_rows(actual, budget, LINES, "review", ["country", "month"], "amount")
    return out.withColumns({c: F.col(c).cast("double") for c in ("revenue", "budget")})


AS_OF = dt.date(2001, 8, 31)


@plan("ageing_buckets", f"""
WITH {DOCUMENTS}, a AS (SELECT o_orderkey, price, quantity, date_diff('day', ship_date, DATE '2001-08-31') AS days FROM doc_lines WHERE l_linestatus = 'O')
SELECT CASE WHEN days < 55 THEN '1. OK' WHEN days <= 60 THEN '2. In Danger' ELSE '3. Overdue' END AS line_status, count(*) AS n_lines,
       sum(price)::DOUBLE AS amount, sum(price - quantity)::DOUBLE AS margin FROM a GROUP BY 1
""")
def ageing_buckets(t: Tables):
    d = documents(t).where("l_linestatus = 'O'")
    return d.groupBy(R.ageing_bucket(F.datediff(F.lit(AS_OF), "ship_date")).alias("line_status")).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("price").cast("double").alias("amount"),
        F.sum(F.col("price") - F.col("quantity")).cast("double").alias("margin"))


@plan("outbound_shipments_by_week", """
SELECT week(l_shipdate)::INT AS week_no, CAST(l_shipdate AS DATE) AS ship_date, l_partkey, upper(p_type) AS warehouse,
  CASE WHEN p_size > 25 THEN 'Yes' ELSE 'No' END AS serialized, sum(l_quantity)::BIGINT AS qty
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey WHERE l_quantity <> 0 GROUP BY ALL
""")
def _(t: Tables):
    lines = t.lineitem.where("l_quantity <> 0").groupBy(F.to_date("l_shipdate").alias("ship_date"), "l_partkey").agg(
        F.sum(F.col("l_quantity").cast("long")).alias("qty"))
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), F.upper("p_type").alias("warehouse"),
                          F.when(F.col("p_size") > 25, "Yes").otherwise("No").alias("serialized"))
    return lines.join(items, "l_partkey", "left").withColumn("week_no", F.weekofyear("ship_date"))


@plan("shipments_variants", f"""
WITH {DOCUMENTS}
SELECT report, nation, count(*) AS n, sum(quantity)::BIGINT AS quantity FROM doc_lines JOIN (VALUES ('MAIN'), ('CSC'), ('ONE_CUSTOMER')) v(report)
ON report = 'MAIN' OR (report = 'CSC' AND nation < 10) OR (report = 'ONE_CUSTOMER' AND nation = 7 AND l_returnflag = 'A') WHERE quantity > 0 GROUP BY 1, 2
""")
def shipments_variants(t: Tables):
    d = documents(t).where("quantity > 0")
    names = {"MAIN": F.lit(True), "CSC": F.col("nation") < 10, "ONE_CUSTOMER": (F.col("nation") == 7) & (F.col("l_returnflag") == "A")}
    return R.variants(d, names).groupBy("report", "nation").agg(F.count(F.lit(1)).alias("n"), F.sum("quantity").alias("quantity"))


VENDOR_RULES = (
    R.VendorRule("Brand#1", "l_returnflag = 'A'", {
        "report_date": "o_date", "part_code": "p_name", "qty": "quantity", "amount": "price"}),
    R.VendorRule("Brand#2", "l_linestatus = 'F'", {
        "report_date": "ship_date", "part_code": "upper(p_name)", "qty": "1", "list_price": "p_retailprice"}),
    R.VendorRule("Brand#3", "o_date >= date '1999-01-01'", {
        "report_date": "last_day(ship_date)", "part_code": "p_type", "qty": "total_qty"}),
)


@plan("wide_vendor_report", f"""
WITH {DOCUMENTS}, x AS (SELECT d.*, p_brand, p_name, p_type, p_retailprice, sum(quantity) OVER (PARTITION BY o_orderkey, l_partkey) AS total_qty FROM doc_lines d JOIN part ON p_partkey = l_partkey)
SELECT p_brand, o_orderkey, l_linenumber, CASE p_brand WHEN 'Brand#1' THEN o_date WHEN 'Brand#2' THEN ship_date ELSE last_day(ship_date) END AS report_date,
  CASE p_brand WHEN 'Brand#1' THEN p_name WHEN 'Brand#2' THEN upper(p_name) ELSE p_type END AS part_code,
  CAST(CASE p_brand WHEN 'Brand#1' THEN quantity WHEN 'Brand#2' THEN 1 ELSE total_qty END AS BIGINT) AS qty,
  CASE p_brand WHEN 'Brand#1' THEN price END::DOUBLE AS amount, CASE p_brand WHEN 'Brand#2' THEN p_retailprice END AS list_price
FROM x WHERE (p_brand = 'Brand#1' AND l_returnflag = 'A') OR (p_brand = 'Brand#2' AND l_linestatus = 'F') OR (p_brand = 'Brand#3' AND o_date >= DATE '1999-01-01')
""")
def wide_vendor_report(t: Tables):
    # only vendors with a rule: the filter goes to the items before lines and orders are joined
    wanted = t.part.where(F.col("p_brand").isin(*[r.vendor for r in VENDOR_RULES]))
    items = wanted.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name", "p_type", "p_retailprice")
    lines = with_group_stats(order_lines(t).join(items, "l_partkey"), ["o_orderkey", "l_partkey"], total_qty=F.sum("quantity"))
    d = with_order(lines, t)
    columns = {"report_date": "date", "part_code": "string", "qty": "long", "amount": "double", "list_price": "double"}
    return R.vendor_report(d, "p_brand", VENDOR_RULES, columns, ["p_brand", "o_orderkey", "l_linenumber"])


@plan("serial_expansion", """
SELECT l_partkey, unit_no, count(*) AS n FROM (SELECT l_partkey, unnest(range(1, CAST(l_quantity AS BIGINT) + 1))::BIGINT AS unit_no FROM lineitem) GROUP BY 1, 2
""")
def _(t: Tables):
    # a unit has all lines of at least its number: counted along the quantities, before units unfold
    lines = stacked_quantities(t.lineitem, ["l_partkey"], "l_quantity", {"n": F.count(F.lit(1))})
    return explode_quantity(lines, "units", after="fewer").select("l_partkey", "unit_no", "n")


@plan("stock_on_hand", """
SELECT s_suppkey, p_brand, CASE p_brand WHEN 'Brand#1' THEN upper(s_name) ELSE s_name END AS shown_as, coalesce(sum(CASE l_returnflag WHEN 'R' THEN l_quantity ELSE -l_quantity END), 0)::BIGINT AS on_hand
FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY ALL
""")
def _(t: Tables):
    moved = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("long")
    sums = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum(moved).alias("moved"))
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    by_brand = sums.join(items, "l_partkey", "left").groupBy(F.col("l_suppkey").alias("s_suppkey"), "p_brand").agg(F.sum("moved").alias("moved"))
    return by_brand.join(t.supplier, "s_suppkey", "right").select(
        "s_suppkey", "p_brand", F.when(F.col("p_brand") == "Brand#1", F.upper("s_name")).otherwise(F.col("s_name")).alias("shown_as"),
        F.coalesce("moved", F.lit(0)).alias("on_hand"))


@plan("attempts_flatten", """
SELECT DISTINCT user_id, event_type, CAST(date_trunc('day', ts) AS DATE) AS day, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
""")
def attempts_flatten(t: Tables):
    one = F.create_map(F.lit("type"), F.col("event_type"), F.lit("started"), F.date_format("ts", "yyyy-MM-dd"),
                       F.lit("k"), F.get_json_object("props", "$.k"))
    nested = t.events.select("user_id", F.array(one, one).alias("attempts"))
    out = R.explode_attempts(nested, "attempts", {"type": "string", "started": "date", "k": "long"}, ["user_id"])
    return out.toDF("user_id", "event_type", "day", "k")


@plan("collapse_max", """
SELECT p_brand, max(p_size) AS p_size, max(p_type) AS p_type FROM part WHERE p_brand <> 'Brand#1' GROUP BY 1
UNION ALL SELECT p_brand, p_size, p_type FROM part WHERE p_brand = 'Brand#1'
""")
def _(t: Tables):
    return R.collapse_max(t.part, "p_brand", ["Brand#1"], ["p_size", "p_type"])


@plan("collect_names", """
SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types FROM part GROUP BY 1
""")
def _(t: Tables):
    distinct = t.part.select("p_brand", "p_type").distinct()
    return distinct.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_list("p_type")), ",").alias("types"))
