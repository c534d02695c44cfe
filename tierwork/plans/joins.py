"""Join shapes on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwork.functions.dates import month_sequence
from tierwork.functions.values import money
from tierwork.operators import lookups as L
from tierwork.operators.ordered import keep_first
from tierwork.plans.inputs import DATED_ORDERS, dated_orders
from tierwork.plans.registry import Tables, plan


@plan("lookup_chain", """
SELECT l_orderkey, l_linenumber, l_partkey, p_brand, s_name, n_name, r_name FROM lineitem
LEFT JOIN part ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_suppkey
LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
""")
def lookup_chain(t: Tables):
    dims = [
        (t.part.withColumnRenamed("p_partkey", "l_partkey"), ["l_partkey"], ["p_brand"]),
        (t.supplier.withColumnRenamed("s_suppkey", "l_suppkey"), ["l_suppkey"], ["s_name", "s_nationkey"]),
        (t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), ["s_nationkey"], ["n_name", "n_regionkey"]),
        (t.region.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"], ["r_name"]),
    ]
    fact = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return L.lookup_all(fact, dims).select("l_orderkey", "l_linenumber", "l_partkey", "p_brand", "s_name", "n_name", "r_name")


@plan("j_03_right_outer", """
SELECT n_name, count(s_suppkey) AS n_suppliers FROM (SELECT * FROM supplier WHERE s_acctbal > 5000) RIGHT JOIN nation ON n_nationkey = s_nationkey GROUP BY 1
""")
def _(t: Tables):
    s = t.supplier.where("s_acctbal > 5000").withColumnRenamed("s_nationkey", "n_nationkey")
    return s.join(t.nation, "n_nationkey", "right").groupBy("n_name").agg(F.count("s_suppkey").alias("n_suppliers"))


@plan("full_outer_null_safe", """
WITH a AS (SELECT CASE WHEN c_nationkey < 20 THEN c_nationkey END AS nation, c_mktsegment AS segment, count(*) AS n_a FROM customer WHERE c_acctbal > 0 GROUP BY 1, 2),
b AS (SELECT CASE WHEN c_nationkey < 22 AND c_nationkey > 2 THEN c_nationkey END AS nation, c_mktsegment AS segment, count(*) AS n_b FROM customer WHERE c_acctbal < 5000 GROUP BY 1, 2)
SELECT coalesce(a.nation, b.nation) AS nation, coalesce(a.segment, b.segment) AS segment, n_a, n_b
FROM a FULL JOIN b ON a.nation IS NOT DISTINCT FROM b.nation AND a.segment IS NOT DISTINCT FROM b.segment
""")
def _(t: Tables):
    def side(cond, nation, name):
        return t.customer.where(cond).groupBy(nation.alias("nation"), F.col("c_mktsegment").alias("segment")).agg(F.count(F.lit(1)).alias(name))

    n = F.col("c_nationkey")
    a = side("c_acctbal > 0", F.when(n < 20, n), "n_a")
    b = side("c_acctbal < 5000", F.when((n < 22) & (n > 2), n), "n_b")
    return L.full_outer_on_key(a, b, ["nation", "segment"], ["n_a"], ["n_b"])


@plan("semi_and_anti", """
SELECT c_custkey, 'urgent' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderdate >= TIMESTAMP '2001-01-01')
UNION ALL SELECT c_custkey, 'none' FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-01-01')
""")
def _(t: Tables):
    late = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01").cast("timestamp_ntz")).withColumnRenamed("o_custkey", "c_custkey")
    c = t.customer.select("c_custkey")
    return c.join(late.where("o_orderpriority = '1-URGENT'"), "c_custkey", "left_semi").withColumn("kind", F.lit("urgent")).unionByName(
        c.join(late, "c_custkey", "left_anti").withColumn("kind", F.lit("none")))


@plan("spine_with_totals", f"""
WITH {DATED_ORDERS}, m AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
  FROM (SELECT CAST(date_trunc('month', min(o_date)) AS DATE) AS lo, CAST(date_trunc('month', max(o_date)) AS DATE) AS hi FROM dated_orders)),
p AS (SELECT DISTINCT o_orderpriority FROM orders)
SELECT p.o_orderpriority, m.month, coalesce(sum(amount), 0)::DOUBLE AS amount FROM p CROSS JOIN m
LEFT JOIN dated_orders d ON d.o_orderpriority = p.o_orderpriority AND date_trunc('month', o_date) = m.month AND o_orderstatus = 'F' GROUP BY 1, 2
""")
def _(t: Tables):
    o = dated_orders(t)
    ends = o.agg(F.trunc(F.min("o_date"), "MM").alias("lo"), F.trunc(F.max("o_date"), "MM").alias("hi")).first()
    months = month_sequence(F.lit(ends.lo), F.lit(ends.hi))
    grid = L.spine(o.select("o_orderpriority"), months, "month")
    sums = o.where("o_orderstatus = 'F'").groupBy("o_orderpriority", F.trunc("o_date", "MM").alias("month")).agg(F.sum("amount").alias("amount"))
    return grid.join(sums, ["o_orderpriority", "month"], "left").withColumn("amount", F.coalesce(F.col("amount").cast("double"), F.lit(0.0)))


@plan("explode_quantity", """
SELECT l_suppkey, unit_no, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2)))::DOUBLE AS amount
FROM (SELECT *, unnest(range(1, CAST(floor(l_quantity) AS BIGINT) + 1))::BIGINT AS unit_no FROM lineitem) GROUP BY 1, 2
""")
def explode_quantity(t: Tables):
    # a unit has all lines of at least its number: summed along the quantities, before units unfold
    lines = L.stacked_quantities(t.lineitem, ["l_suppkey"], "l_quantity", {"n": F.count(F.lit(1)), "amount": F.sum(money(F.col("l_extendedprice")))})
    return L.explode_quantity(lines, "units", after="fewer").select("l_suppkey", "unit_no", "n", F.col("amount").cast("double").alias("amount"))


@plan("join_on_expression", """
SELECT e.event_id, n_name FROM events e LEFT JOIN nation ON lower(n_name) = 'nation_' || (user_id % 30)
""")
def _(t: Tables):
    return L.join_on_expr(
        t.events.select("event_id", "user_id"), t.nation.select("n_name"),
        F.concat(F.lit("nation_"), F.col("user_id") % 30), F.lower("n_name")).select("event_id", "n_name")


@plan("join_either_key", """
SELECT c_custkey, coalesce(a.r_name, b.r_name) AS r_name FROM customer
LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) a ON a.r_regionkey = c_nationkey
LEFT JOIN (SELECT * FROM region WHERE r_regionkey < 3) b ON b.r_regionkey = c_nationkey - 10
""")
def _(t: Tables):
    c = t.customer.select("c_custkey", F.col("c_nationkey").alias("k1"), (F.col("c_nationkey") - 10).alias("k2"))
    return L.join_either(c, t.region.where("r_regionkey < 3"), "k1", "k2", "r_regionkey", "r_name").select("c_custkey", "r_name")


@plan("first_match", """
SELECT o_orderkey, l_partkey FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'A'
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY l_partkey NULLS FIRST) = 1
""")
def _(t: Tables):
    lines = t.lineitem.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return keep_first(t.orders.select("o_orderkey").join(lines, "o_orderkey", "left"), ["o_orderkey"], ["l_partkey"])


@plan("link_intercompany", """
WITH s AS (SELECT o_orderkey AS trans_id, o_orderstatus AS company, o_custkey AS order_id, o_orderkey + 1 AS ref FROM orders),
l AS (SELECT o_orderkey AS trans_id, o_orderstatus AS company, o_custkey AS purchase_id, o_orderkey // 2 AS sister_trans_id FROM orders),
h AS (SELECT DISTINCT o_custkey AS purchase_id, o_orderstatus AS company, CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'P' ELSE 'F' END AS sister_company FROM orders)
SELECT s.trans_id, s.company, s.order_id, l.purchase_id, h.sister_company, l.sister_trans_id, s2.order_id AS sister_order_id, l2.purchase_id AS sister_purchase_id
FROM s LEFT JOIN l ON l.trans_id = s.ref AND l.company = s.company LEFT JOIN h ON h.purchase_id = l.purchase_id AND h.company = s.company
LEFT JOIN s s2 ON s2.trans_id = l.sister_trans_id AND s2.company = h.sister_company
LEFT JOIN l l2 ON l2.trans_id = s2.ref AND l2.company = s2.company
""")
def link_intercompany(t: Tables):
    o = t.orders
    sales = o.select(F.col("o_orderkey").alias("trans_id"), F.col("o_orderstatus").alias("company"),
                     F.col("o_custkey").alias("order_id"), (F.col("o_orderkey") + 1).alias("ref_trans_id"))
    lines = o.select(F.col("o_orderkey").alias("trans_id"), F.col("o_orderstatus").alias("company"),
                     F.col("o_custkey").alias("purchase_id"), F.floor(F.col("o_orderkey") / 2).alias("sister_trans_id"))
    sister = F.when(F.col("o_orderstatus") == "F", "o").when(F.col("o_orderstatus") == "O", "p").otherwise("f")
    heads = o.select(F.col("o_custkey").alias("purchase_id"), F.col("o_orderstatus").alias("company"), sister.alias("sister_company")).distinct()
    return L.link_intercompany(sales, lines, heads)


@plan("match_external", """
WITH ext AS (SELECT o_orderkey, o_orderpriority, year(o_orderdate)::INT AS note, o_orderstatus AS rule FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
own AS (SELECT o_orderkey, o_orderpriority, year(o_orderdate)::INT + CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS note FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')
SELECT ext.o_orderkey AS ext_order, own.o_orderkey AS own_order, ext.note AS ext_note, own.note AS own_note
FROM ext FULL JOIN own ON ext.o_orderkey = own.o_orderkey AND ext.o_orderpriority = own.o_orderpriority
  AND ext.note = CASE WHEN ext.rule = 'P' THEN ext.note ELSE own.note END
""")
def match_external(t: Tables):
    """Order and line (here the priority) identify a shipment; rule P matches without the delivery note."""
    year = F.year("o_orderdate")
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1996-01-01", "2000-01-01"))
    ext = t.orders.where(F.col("o_orderdate") < hi).select("o_orderkey", "o_orderpriority", year.alias("note"), F.col("o_orderstatus").alias("rule"))
    own = t.orders.where(F.col("o_orderdate") >= lo).select(
        "o_orderkey", "o_orderpriority", (year + F.when(F.col("o_orderstatus") == "O", 0).otherwise(1)).alias("note"))
    out = L.match_external(ext, own, ["o_orderkey", "o_orderpriority"], "rule", ["P"], "note", [])
    return out.select(F.col("o_orderkey").alias("ext_order"), F.col("own_o_orderkey").alias("own_order"),
                      F.col("note").alias("ext_note"), "own_note")
