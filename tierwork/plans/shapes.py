"""Small plans for predicates, windows, sets and scalar functions no other plan exercises."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tierwork.functions import dates as D
from tierwork.functions.text import case_insensitive_regex, leading_int, similarity
from tierwork.functions.values import is_not_false, money, row_hash, safe_ratio
from tierwork.operators.ordered import keep_first, last_seen, previous, running, running_max, running_sum
from tierwork.plans.inputs import DATED_ORDERS, dated_orders
from tierwork.plans.registry import hash_sql, plan, Tables


@plan("p_03_regex", "SELECT p_partkey FROM part WHERE regexp_matches(p_name, '(?i)^RED|bolt$')")
def _(t: Tables):
    return t.part.where(F.col("p_name").rlike(case_insensitive_regex("^RED|bolt$"))).select("p_partkey")


@plan("p_04_is_not_false", """
SELECT d.doc_id FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id WHERE (l.quality = 1) IS NOT FALSE
""")
def _(t: Tables):
    return t.documents.select("doc_id").join(t.labels, "doc_id", "left").where(is_not_false(F.col("quality") == 1)).select("doc_id")


@plan("p_05_between", """
SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31' AND o_orderpriority BETWEEN '2' AND '4'
""")
def _(t: Tables):
    lo, hi = (F.lit(d).cast("timestamp_ntz") for d in ("1997-01-01", "1997-12-31"))
    return t.orders.where(F.col("o_orderdate").between(lo, hi) & F.col("o_orderpriority").between("2", "4")).select("o_orderkey")


@plan("p_07_latest_period", """
SELECT o_orderkey FROM orders WHERE year(o_orderdate) * 100 + month(o_orderdate) = (SELECT max(year(o_orderdate) * 100 + month(o_orderdate)) FROM orders)
""")
def _(t: Tables):
    # the month range comes from a scalar subquery on the raw column, so the scan can use it
    last = F.date_trunc("month", F.max("o_orderdate").cast("timestamp")).cast("timestamp_ntz")
    return t.orders.where(F.col("o_orderdate") >= t.orders.select(last).scalar()).select("o_orderkey")


@plan("a_02_group_by_all", """
SELECT o_orderstatus, year(o_orderdate)::INT AS yr, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL HAVING count(DISTINCT o_custkey) > 10
""")
def _(t: Tables):
    return t.spark.sql(
        "SELECT o_orderstatus, year(o_orderdate) AS yr, count(*) AS n, count(DISTINCT o_custkey) AS customers "
        "FROM {orders} GROUP BY ALL HAVING count(DISTINCT o_custkey) > 10", orders=t.orders)


@plan("a_14_first_by", "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def _(t: Tables):
    return keep_first(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"])


@plan("w_05_previous_row", """
SELECT event_id, lag(event_type, 1, 'none') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events
""")
def _(t: Tables):
    e = t.events.select("event_id", "user_id", "event_type", "ts")
    return running(e, ["user_id"], ["ts", "event_id"], None, {"before": previous(F.col("event_type"), "none")}).select("event_id", "before")


@plan("w_06_change_points", """
SELECT user_id, event_id FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
QUALIFY lag(event_type) OVER w IS NULL OR lag(event_type) OVER w <> event_type
""")
def _(t: Tables):
    e = t.events.select("event_id", "user_id", "event_type", "ts")
    seen = running(e, ["user_id"], ["ts", "event_id"], None, {"before": previous(F.col("event_type"))})
    return seen.where(F.col("before").isNull() | (F.col("before") != F.col("event_type"))).select("user_id", "event_id")


@plan("w_07_running_values", f"""
WITH {DATED_ORDERS}
SELECT o_orderkey, (max(amount) OVER w)::DOUBLE AS top, (sum(amount) OVER w)::DOUBLE AS total FROM dated_orders
WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)
""")
def running_values(t: Tables):
    out = running(dated_orders(t), ["o_orderpriority"], ["o_orderkey"], None,
                  {"top": running_max(F.col("amount")), "total": running_sum(F.col("amount"))})
    return out.select("o_orderkey", F.col("top").cast("double").alias("top"), F.col("total").cast("double").alias("total"))


@plan("w_08_forward_fill", """
SELECT event_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS last_purchase FROM events
""")
def _(t: Tables):
    e = t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", F.col("value")).alias("v"))
    return running(e, ["user_id"], ["ts", "event_id"], None, {"last_purchase": last_seen(F.col("v"))}).select("event_id", "last_purchase")


@plan("w_11_nth_working_day", """
SELECT month, day AS tenth FROM (
  SELECT CAST(date_trunc('month', d) AS DATE) AS month, d AS day, row_number() OVER (PARTITION BY date_trunc('month', d) ORDER BY d) AS n
  FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-31', INTERVAL 1 DAY)) AS DATE) AS d) WHERE dayofweek(d) NOT IN (0, 6)) WHERE n = 10
  AND month IN (SELECT date_trunc('month', o_orderdate) FROM orders)
""")
def _(t: Tables):
    months = t.orders.select(D.month_start(F.col("o_orderdate").cast("date")).alias("month")).distinct()
    return months.withColumn("tenth", D.nth_working_day(F.col("month"), 10))


@plan("ledger_cut_off", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders), w AS (
  SELECT month, day FROM (SELECT date_trunc('month', x) AS month, x AS day, row_number() OVER (PARTITION BY date_trunc('month', x) ORDER BY x) AS n
    FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-08-31', INTERVAL 1 DAY)) AS DATE) AS x) WHERE dayofweek(x) NOT IN (0, 6)) WHERE n = 10)
SELECT d AS as_of, CAST(CASE WHEN d < (CASE WHEN month = DATE '2000-12-01' THEN DATE '2000-12-01' ELSE day END)
  THEN date_trunc('month', d) - INTERVAL 1 MONTH - INTERVAL 1 DAY ELSE date_trunc('month', d) - INTERVAL 1 DAY END AS DATE) AS cut_off
FROM d JOIN w ON w.month = date_trunc('month', d)
""")
def _(t: Tables):
    days = t.orders.select(F.to_date("o_orderdate").alias("as_of")).distinct()
    return days.withColumn("cut_off", D.ledger_cut_off(F.col("as_of"), {dt.date(2000, 12, 1): dt.date(2000, 12, 1)}))


@plan("l_03_top_rows", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t: Tables):
    return t.orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10).select("o_orderkey", "o_custkey")


@plan("u_02_union_distinct", "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")
def _(t: Tables):
    return t.customer.select(F.col("c_nationkey").alias("nation")).union(t.supplier.select("s_nationkey")).distinct()


@plan("u_04_set_differences", """
WITH a AS (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'), b AS (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O')
SELECT 'multiset' AS kind, l_suppkey, l_returnflag FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT 'set', l_suppkey, l_returnflag FROM (SELECT * FROM a EXCEPT SELECT * FROM b WHERE l_returnflag <> 'A')
""")
def _(t: Tables):
    cols = ["l_suppkey", "l_returnflag"]
    a, b = (t.lineitem.where(f"l_linestatus = '{s}'") for s in "FO")
    multi = a.select(*cols).exceptAll(b.select(*cols)).select(F.lit("multiset").alias("kind"), *cols)
    plain = a.select(*cols).subtract(b.where("l_returnflag <> 'A'").select(*cols))
    return multi.unionByName(plain.select(F.lit("set").alias("kind"), *cols))


@plan("x_01_strings", """
SELECT c_custkey, upper(trim('  ' || c_name)) AS a, lower(left(c_mktsegment, 3)) || '-' || right(c_name, 4) AS b,
  upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS c, replace(c_name, 'Customer', 'C') AS d, lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS e, length(c_name)::INT AS f
FROM customer
""")
def _(t: Tables):
    return t.customer.select(
        "c_custkey", F.upper(F.trim(F.concat(F.lit("  "), "c_name"))).alias("a"),
        F.concat_ws("-", F.lower(F.left("c_mktsegment", F.lit(3))), F.right("c_name", F.lit(4))).alias("b"), F.initcap("c_mktsegment").alias("c"),
        F.replace("c_name", F.lit("Customer"), F.lit("C")).alias("d"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0").alias("e"), F.length("c_name").alias("f"))


@plan("x_02_x_03_split_regex", """
SELECT page_id, split_part(url, '/', 3) AS host, regexp_extract(url, '([0-9]+)', 1) AS first_number, regexp_replace(url, '[?#].*$', '') AS bare FROM pages
""")
def _(t: Tables):
    return t.pages.select(
        "page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"), F.regexp_extract("url", r"([0-9]+)", 1).alias("first_number"),
        F.regexp_replace("url", r"[?#].*$", "").alias("bare"))


@plan("x_04_similarity", """
SELECT p_partkey, 1.0::DOUBLE - levenshtein(p_name, lower(p_type)) / greatest(length(p_name), length(p_type))::DOUBLE AS s FROM part
""")
def _(t: Tables):
    return t.part.select("p_partkey", similarity(F.col("p_name"), F.lower("p_type")).alias("s"))


@plan("x_08_date_arithmetic", """
SELECT o_orderkey, CAST(o_orderdate + INTERVAL 3 MONTH AS DATE) AS plus3, date_diff('day', o_orderdate, TIMESTAMP '2002-01-01')::INT AS days,
  CAST(last_day(o_orderdate) AS DATE) AS month_end, CAST(o_orderdate - INTERVAL 7 DAY AS DATE) AS week_before FROM orders
""")
def _(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", F.add_months(d, 3).alias("plus3"), F.datediff(F.lit(dt.date(2002, 1, 1)), d).alias("days"),
        F.last_day(d).alias("month_end"), F.date_sub(d, 7).alias("week_before"))


@plan("x_09_parse_dates", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders
""")
def _(t: Tables):
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy")).when(
        F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy.MM.dd")).otherwise("n/a")
    return t.orders.select("o_orderkey", D.parse_date(text, ["dd/MM/yyyy", "yyyy.MM.dd"]).alias("parsed"))


@plan("x_07_fiscal", """
SELECT o_orderkey, year(o_orderdate + INTERVAL 9 MONTH)::INT AS fy, month(o_orderdate - INTERVAL 3 MONTH)::INT AS period, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders
""")
def _(t: Tables):
    d = F.to_date("o_orderdate")
    o = t.orders.select("o_orderkey", D.fiscal_year(d).alias("fy"), D.fiscal_period(d).alias("period"))
    return o.withColumn("month", D.fiscal_to_calendar(F.col("fy"), F.col("period")))


@plan("x_11_x_13_numbers", """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / nullif(l_tax, 0) AS ratio, greatest(l_discount, l_tax) AS top,
  CAST(l_extendedprice AS DECIMAL(12,1))::DOUBLE AS tenths, abs(l_discount - 0.05) AS away, ceil(l_quantity / 7)::BIGINT AS packs FROM lineitem
""")
def _(t: Tables):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", safe_ratio(F.col("l_extendedprice"), F.col("l_tax")).alias("ratio"),
        F.greatest("l_discount", "l_tax").alias("top"), money(F.col("l_extendedprice"), 12, 1).cast("double").alias("tenths"),
        F.abs(F.col("l_discount") - 0.05).alias("away"), F.ceil(F.col("l_quantity") / 7).alias("packs"))


@plan("x_12_leading_number", """
SELECT event_id, coalesce(CAST(nullif(regexp_extract(coalesce(nullif(s, '0'), 'none'), '^(\\d+)', 1), '') AS INT), 0) AS n
FROM (SELECT event_id, json_extract_string(props, '$.k') AS s FROM events)
""")
def _(t: Tables):
    s = F.coalesce(F.nullif(F.get_json_object("props", "$.k"), F.lit("0")), F.lit("none"))
    return t.events.select("event_id", leading_int(s).alias("n"))


@plan("x_16_row_key", f"""
SELECT {hash_sql('l_orderkey', 'l_linenumber', 'l_partkey', 'l_suppkey')} AS row_key FROM lineitem
""")
def _(t: Tables):
    return t.lineitem.select(row_hash([F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("row_key"))


WEEK_SQL = """CAST(floor(date_diff('day', f, d) / 7) + 1 AS INT)"""
WEEKS = """days AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
sat AS (SELECT y, make_date(y, 1, 1) + CAST((6 - dayofweek(make_date(y, 1, 1)) + 7) % 7 AS INT) AS f FROM generate_series(1990, 2005) g(y)),
w AS (SELECT o_orderkey, d, CASE WHEN d < a.f THEN b.f ELSE a.f END AS f, CASE WHEN d < a.f THEN year(d) - 1 ELSE year(d) END AS yr
  FROM days JOIN sat a ON a.y = year(d) JOIN sat b ON b.y = year(d) - 1)"""


@plan("company_week", f"""
WITH {WEEKS} SELECT o_orderkey, {WEEK_SQL} AS week, yr::INT AS week_year, CAST(d - CAST((dayofweek(d) + 1) % 7 AS INT) AS DATE) AS week_start FROM w
""")
def company_week(t: Tables):
    d = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", D.company_week(d).alias("week"), D.company_year(d).alias("week_year"), D.company_week_start(d).alias("week_start"))


@plan("company_week_sql_function", f"WITH {WEEKS} SELECT {WEEK_SQL} AS week, count(*) AS n FROM w GROUP BY 1")
def _(t: Tables):
    t.spark.sql("""
        CREATE OR REPLACE TEMPORARY FUNCTION company_week_start(d DATE) RETURNS DATE RETURN date_sub(d, dayofweek(d) % 7)""")
    return t.spark.sql("""
        SELECT CAST(floor(datediff(company_week_start(d), first) / 7) + 1 AS INT) AS week, count(*) AS n FROM (
          SELECT d, CASE WHEN d < s THEN next_day(make_date(year(d) - 2, 12, 31), 'SAT') ELSE s END AS first
          FROM (SELECT d, next_day(make_date(year(d) - 1, 12, 31), 'SAT') AS s FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM {orders})))
        GROUP BY 1""", orders=t.orders)


@plan("date_dim", """
WITH r AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders)
SELECT d AS date, year(d)::INT AS year, month(d)::INT AS month, day(d)::INT AS day, dayofweek(d)::INT + 1 AS day_of_week, dayofyear(d)::INT AS day_of_year,
  quarter(d)::INT AS quarter, strftime(d, '%b') AS month_name, CAST(d - CAST(dayofweek(d) AS INT) AS DATE) AS week_start, last_day(d) AS month_end
FROM (SELECT CAST(unnest(generate_series(a - INTERVAL 10 YEAR, b + INTERVAL 10 YEAR, INTERVAL 1 DAY)) AS DATE) AS d FROM r)
""")
def date_dim(t: Tables):
    """Ten years around the order dates, weeks from Sunday."""
    span = t.orders.agg(F.add_months(F.to_date(F.min("o_orderdate")), -120).alias("a"), F.add_months(F.to_date(F.max("o_orderdate")), 120).alias("b"))
    d = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("date"))
    c = F.col("date")
    return d.select(
        "date", F.year(c).alias("year"), F.month(c).alias("month"), F.dayofmonth(c).alias("day"), F.dayofweek(c).alias("day_of_week"),
        F.dayofyear(c).alias("day_of_year"), F.quarter(c).alias("quarter"), F.date_format(c, "MMM").alias("month_name"),
        F.date_sub(c, F.dayofweek(c) - 1).alias("week_start"), F.last_day(c).alias("month_end"))
