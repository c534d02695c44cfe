"""Vendor rules as tables: matching external shipments, and the wide report with serial numbers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwork.operators import vendors as V
from tierwork.plans.inputs import DOCUMENTS, order_lines, with_order
from tierwork.plans.registry import Tables, plan

MATCHES = (
    (1, "all", None, "vendor LIKE 'Brand#1%'", True, None, None),
    (2, "resellers", None, "vendor LIKE 'Brand#2%'", True, None, "reseller = 'A' AND own_place <> 'DD'"),
    (3, "either side", "vendor IN ('Brand#3', 'Brand#4')", "vendor IN ('Brand#3', 'Brand#4')", False, None, "reseller <> 'N'"),
    (4, "dated", "vendor IN ('Brand#5', 'Brand#6')", None, True,
     "own_ship_date BETWEEN date_sub(invoiced, 31) AND date_add(invoiced, 2)", "own_ship_date IS NULL OR own_ship_date >= invoiced"),
    (5, "own only", "vendor IN ('Brand#7', 'Brand#8', 'Brand#9')", None, False, None, "own_order_id IS NOT NULL"),
)


@plan("match_by_vendor_rules", """
WITH l AS (SELECT * FROM lineitem JOIN part ON p_partkey = l_partkey),
e AS (SELECT row_number() OVER () AS eid, l_orderkey AS order_id, l_linenumber AS line_no, l_suppkey AS note, p_brand AS v, l_returnflag AS reseller, CAST(l_shipdate AS DATE) AS d FROM l),
o AS (SELECT row_number() OVER () AS oid, l_orderkey + CASE WHEN l_quantity < 5 THEN 1000000000 ELSE 0 END AS order_id, l_linenumber AS line_no,
  l_suppkey + CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS note, p_brand AS v, CAST(l_shipdate AS DATE) + CAST(l_partkey % 5 AS INT) AS d,
  CASE WHEN l_quantity > 45 THEN 'DD' ELSE 'M' END AS place FROM l),
p AS (SELECT eid, oid FROM e JOIN o USING (order_id, line_no) WHERE (e.note = o.note AND (o.v LIKE 'Brand#1%' OR o.v LIKE 'Brand#2%' OR
    (e.v IN ('Brand#5', 'Brand#6') AND o.d BETWEEN e.d - 31 AND e.d + 2))) OR (e.v IN ('Brand#3', 'Brand#4') AND o.v IN ('Brand#3', 'Brand#4')) OR e.v IN ('Brand#7', 'Brand#8', 'Brand#9')),
a AS (SELECT eid, oid FROM p UNION ALL SELECT eid, NULL FROM e WHERE eid NOT IN (SELECT eid FROM p) UNION ALL SELECT NULL, oid FROM o WHERE oid NOT IN (SELECT oid FROM p)),
r AS (SELECT CASE WHEN o.v LIKE 'Brand#1%' THEN 'all' WHEN o.v LIKE 'Brand#2%' AND reseller = 'A' AND place <> 'DD' THEN 'resellers'
    WHEN (e.v IN ('Brand#3', 'Brand#4') OR o.v IN ('Brand#3', 'Brand#4')) AND reseller <> 'N' THEN 'either side'
    WHEN e.v IN ('Brand#5', 'Brand#6') AND (o.d IS NULL OR o.d >= e.d) THEN 'dated'
    WHEN e.v IN ('Brand#7', 'Brand#8', 'Brand#9') AND o.order_id IS NOT NULL THEN 'own only' END AS rule,
  e.order_id, e.line_no, e.note, e.v AS vendor, o.order_id AS own_order_id, o.note AS own_note, o.v AS own_vendor FROM a LEFT JOIN e USING (eid) LEFT JOIN o ON o.oid = a.oid)
SELECT * FROM r WHERE rule IS NOT NULL
""")
def match_by_vendor_rules(t: Tables):
    """Both sides stand for the lines: some own lines carry another order number or delivery note and a later date."""
    lines = t.lineitem.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand"), "l_partkey")
    day, line = F.to_date("l_shipdate"), F.col("l_linenumber").alias("line_no")
    ext = lines.select(F.col("l_orderkey").alias("order_id"), line, F.col("l_suppkey").alias("note"), F.col("p_brand").alias("vendor"),
                       F.col("l_returnflag").alias("reseller"), day.alias("invoiced"))
    own = lines.select(
        (F.col("l_orderkey") + F.when(F.col("l_quantity") < 5, 1000000000).otherwise(0)).alias("order_id"), line,
        (F.col("l_suppkey") + F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("note"), F.col("p_brand").alias("vendor"),
        F.date_add(day, (F.col("l_partkey") % 5).cast("int")).alias("ship_date"), F.when(F.col("l_quantity") > 45, "DD").otherwise("M").alias("place"))
    out = V.match_by_rules(ext, own, ["order_id", "line_no"], "note", t.spark.createDataFrame(MATCHES, V.MATCH_RULES))
    return out.select("rule", "order_id", "line_no", "note", "vendor", "own_order_id", "own_note", "own_vendor")


REPORTS = (
    (1, "first", "p_brand = 'Brand#1'", "l_returnflag = 'A'", "o_date", None, {"part_code": "p_name", "qty": "quantity", "amount": "price"}),
    (2, "tens", "p_brand LIKE 'Brand#1%'", "l_linestatus = 'F'", "ship_date", "quantity",
     {"part_code": "upper(p_name)", "qty": "1", "serial": "concat(o_orderkey, '-', l_linenumber, '-', unit_no)"}),
    (3, "returns", "p_brand IN ('Brand#2', 'Brand#20', 'Brand#21')", "o_date >= date'1999-01-01'", "last_day(ship_date)",
     "CASE WHEN l_returnflag = 'R' THEN quantity END",
     {"part_code": "p_type", "qty": "CASE WHEN unit_no IS NULL THEN quantity ELSE 1 END", "serial": "concat('S', l_partkey, '-', unit_no)"}),
    (9, "others", "true", None, "ship_date", "quantity",
     {"part_code": "p_name", "qty": "1", "amount": "price", "serial": "concat(p_brand, '/', o_orderkey, '/', unit_no)"}),
)
REPORT_COLUMNS = {"part_code": "string", "qty": "long", "amount": "decimal(18,2)", "serial": "string"}


@plan("vendor_report_with_serials", f"""
WITH {DOCUMENTS}, x AS (SELECT *, CASE WHEN p_brand = 'Brand#1' THEN 'first' WHEN p_brand LIKE 'Brand#1%' THEN 'tens' WHEN p_brand IN ('Brand#2', 'Brand#20', 'Brand#21') THEN 'returns' ELSE 'others' END AS vendor
  FROM doc_lines JOIN part ON p_partkey = l_partkey),
k AS (SELECT *, CASE WHEN vendor IN ('tens', 'others') OR (vendor = 'returns' AND l_returnflag = 'R') THEN quantity END AS units FROM x
  WHERE CASE vendor WHEN 'first' THEN l_returnflag = 'A' WHEN 'tens' THEN l_linestatus = 'F' WHEN 'returns' THEN o_date >= DATE '1999-01-01' ELSE TRUE END),
u AS (SELECT *, unnest(range(1, CAST(units AS BIGINT) + 1)) AS unit_no FROM k WHERE units >= 1 UNION ALL SELECT *, NULL FROM k WHERE units IS NULL OR units < 1),
r AS (SELECT vendor, unit_no, CASE vendor WHEN 'first' THEN o_date WHEN 'returns' THEN last_day(ship_date) ELSE ship_date END AS report_date,
  CASE vendor WHEN 'tens' THEN upper(p_name) WHEN 'returns' THEN p_type ELSE p_name END AS part_code,
  CASE WHEN vendor = 'first' OR (vendor = 'returns' AND unit_no IS NULL) THEN quantity ELSE 1 END AS qty, CASE WHEN vendor IN ('first', 'others') THEN price END AS amount,
  CASE vendor WHEN 'tens' THEN o_orderkey || '-' || l_linenumber || '-' || unit_no WHEN 'returns' THEN 'S' || l_partkey || '-' || unit_no
    WHEN 'others' THEN p_brand || '/' || o_orderkey || '/' || unit_no END AS serial FROM u)
SELECT vendor, report_date, part_code, count(*) AS n_rows, sum(qty)::BIGINT AS qty, sum(amount)::DOUBLE AS amount, count(serial) AS n_serials,
  min(serial) AS first_serial, max(serial) AS last_serial, max(unit_no)::BIGINT AS last_unit FROM r GROUP BY 1, 2, 3
""")
def vendor_report_with_serials(t: Tables):
    """Every brand falls under a rule; the report's rows, summed per vendor, date and part code."""
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name", "p_type")
    # texts of the parts come last, so lines travel to their orders without them; units are summed where they unfold
    lines = with_order(order_lines(t), t).join(items, "l_partkey")
    totals = {"n_rows": ("count", None), "qty": ("sum", "qty"), "amount": ("sum", "amount"), "n_serials": ("count", "serial"),
              "first_serial": ("min", "serial"), "last_serial": ("max", "serial"), "last_unit": ("max", "unit_no")}
    out = V.report_by_rules(lines, t.spark.createDataFrame(REPORTS, V.REPORT_RULES), REPORT_COLUMNS, ["o_orderkey", "l_linenumber"], totals)
    return out.groupBy("vendor", "report_date", "part_code").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("qty").alias("qty"), F.sum("amount").cast("double").alias("amount"),
        F.sum("n_serials").alias("n_serials"), F.min("first_serial").alias("first_serial"), F.max("last_serial").alias("last_serial"),
        F.max("last_unit").alias("last_unit"))
