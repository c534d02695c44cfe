"""Shapes of the given tables that several plans start from, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.functions.dates import month_start
from tierwork.functions.values import money
from tierwork.operators.finance import fill_gaps
from tierwork.plans.registry import Tables
from tierwork.sources.storage import cut_lineage



def dated_orders(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", F.to_date("o_orderdate").alias("o_date"),
        money(F.col("o_totalprice")).alias("amount"),
    )


DATED_ORDERS = """dated_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount
  FROM orders)"""


def nation_orders(t: Tables) -> DataFrame:
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return dated_orders(t).join(who, "o_custkey")


NATION_ORDERS = DATED_ORDERS + """, nation_orders AS (
  SELECT d.*, c_nationkey AS nation FROM dated_orders d JOIN customer ON c_custkey = o_custkey)"""


def order_lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
        F.to_date("l_shipdate").alias("ship_date"), F.col("l_quantity").cast("int").alias("quantity"),
        money(F.col("l_extendedprice")).alias("price"),
    )


def with_order(lines: DataFrame, t: Tables) -> DataFrame:
    return lines.join(nation_orders(t).select("o_orderkey", "o_custkey", "o_date", "nation"), "o_orderkey")


def documents(t: Tables) -> DataFrame:
    """Order lines with order date, customer and nation; quantity and amount positive whatever the type."""
    return with_order(order_lines(t), t)


DOCUMENTS = NATION_ORDERS + """, doc_lines AS (
  SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus,
         CAST(l_shipdate AS DATE) AS ship_date, CAST(l_quantity AS INT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price, o_custkey, o_date, nation
  FROM lineitem JOIN nation_orders ON l_orderkey = o_orderkey)"""


def quarterly_rates(t: Tables) -> DataFrame:
    """A rate per nation, quoted in the first month of each quarter only, so the months between are gaps."""
    monthly = nation_orders(t).groupBy("nation", month_start(F.col("o_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return monthly.where(F.month("month").isin(1, 4, 7, 10)).select(
        "nation", "month", ((F.lit(10001) + 2 * F.col("n")) / 10000.0).cast("decimal(18,4)").alias("rate")
    )


QUARTERLY_RATES = """quarterly_rates AS (
  SELECT nation, CAST(date_trunc('month', o_date) AS DATE) AS month,
         CAST((10001 + 2 * count(*)) / 10000.0 AS DECIMAL(18,4)) AS rate
  FROM nation_orders WHERE month(o_date) IN (1, 4, 7, 10) GROUP BY ALL)"""


def filled_rates(t: Tables) -> DataFrame:
    ends = nation_orders(t).agg(F.trunc(F.min("o_date"), "MM").alias("lo"), F.trunc(F.max("o_date"), "MM").alias("hi")).first()
    return fill_gaps(quarterly_rates(t), "nation", "month", ["rate"], F.lit(ends.lo), F.lit(ends.hi))


FILLED_RATES = QUARTERLY_RATES + """, filled_rates AS (
  SELECT s.nation, s.month, last_value(r.rate IGNORE NULLS) OVER (
           PARTITION BY s.nation ORDER BY s.month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rate
  FROM (SELECT nation, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
        FROM (SELECT DISTINCT nation FROM quarterly_rates), (
          SELECT CAST(date_trunc('month', min(o_date)) AS DATE) AS lo, CAST(date_trunc('month', max(o_date)) AS DATE) AS hi FROM nation_orders)) s
  LEFT JOIN quarterly_rates r ON r.nation = s.nation AND r.month = s.month)"""


def stored_rates(t: Tables, filled: bool = True) -> DataFrame:
    """The rates as a stored table (nations x months): conversions read it several times."""
    return cut_lineage(filled_rates(t) if filled else quarterly_rates(t))


def event_log(t: Tables) -> DataFrame:
    """Attribute changes per user: event type at a time."""
    return t.events.select("event_id", "user_id", "event_type", "ts", F.sha2("event_type", 256).alias("hash"))


def by_month(col: str):
    return F.date_trunc("month", F.col(col).cast("timestamp"))

