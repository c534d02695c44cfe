"""Write and read back: sinks on the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwork.plans.inputs import DATED_ORDERS, dated_orders
from tierwork.plans.registry import Tables, plan
from tierwork.sources import sinks as S
from tierwork.sources.storage import fresh_dir

BY_STATUS = "SELECT o_orderstatus, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount"


def _totals(df):
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"))


@plan("sink_append_merge_schema", f"""
WITH {DATED_ORDERS}
SELECT o_orderstatus, count(*) AS n, CAST(sum(amount) AS DOUBLE) AS amount,
       count(*) FILTER (WHERE o_date >= DATE '2000-01-01') AS n_late FROM dated_orders GROUP BY 1
""")
def _(t: Tables):
    path = fresh_dir(t.spark, "append")
    o = dated_orders(t)
    S.append(o.where(F.col("o_date") < "2000-01-01"), path)
    S.append(o.where(F.col("o_date") >= "2000-01-01").withColumn("late", F.lit(1)), path)
    return S.read_merged(t.spark, path).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").cast("double").alias("amount"), F.count("late").alias("n_late"))


@plan("sink_overwrite_reload", f"WITH {DATED_ORDERS} {BY_STATUS} FROM dated_orders GROUP BY 1")
def _(t: Tables):
    path = fresh_dir(t.spark, "reload")
    S.overwrite(dated_orders(t).where("o_orderstatus = 'F'").select("o_orderkey"), path)
    S.overwrite(dated_orders(t), path)
    return _totals(t.spark.read.parquet(path))


@plan("sink_replace_partitions", f"""
WITH {DATED_ORDERS} SELECT o_orderstatus, count(*) AS n,
  CAST(sum(CASE WHEN o_orderstatus = 'P' THEN -amount ELSE amount END) AS DOUBLE) AS amount FROM dated_orders GROUP BY 1
""")
def _(t: Tables):
    path = fresh_dir(t.spark, "partitions")
    o = dated_orders(t)
    S.replace_partitions(o, path, ["o_orderstatus"])
    S.replace_partitions(o.where("o_orderstatus = 'P'").withColumn("amount", -F.col("amount")), path, ["o_orderstatus"])
    return _totals(t.spark.read.parquet(path))


@plan("replace_slice", f"""
WITH {DATED_ORDERS} SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'reloaded' ELSE o_orderstatus END AS o_orderstatus
FROM dated_orders WHERE o_orderpriority <> '1-URGENT' OR o_date >= DATE '1996-01-01'
""")
def _(t: Tables):
    old = dated_orders(t)
    new = old.where(F.col("o_date") >= "1996-01-01").withColumn("o_orderstatus", F.lit("reloaded"))
    return S.replace_slice(old, new, F.col("o_orderpriority") == "1-URGENT").select("o_orderkey", "o_orderstatus")


@plan("delete_then_append", f"""
WITH {DATED_ORDERS} SELECT o_orderkey, o_date FROM dated_orders WHERE o_date < DATE '2001-01-01'
UNION ALL SELECT o_orderkey, o_date FROM dated_orders WHERE o_date >= DATE '2001-01-01' AND o_orderstatus = 'F'
""")
def _(t: Tables):
    o = dated_orders(t).select("o_orderkey", "o_date", "o_orderstatus")
    year = F.col("o_date").between("2001-01-01", "2001-12-31")
    return S.delete_then_append(o, o.where(year & (F.col("o_orderstatus") == "F")), year).select("o_orderkey", "o_date")


@plan("materialise_and_publish", f"WITH {DATED_ORDERS} {BY_STATUS} FROM dated_orders GROUP BY 1")
def _(t: Tables):
    stored = S.materialise(dated_orders(t), fresh_dir(t.spark, "snapshot"))
    return _totals(stored)


@plan("clear_keep_reserved", """
SELECT s_suppkey - 10 AS vendor_pk, s_name FROM supplier WHERE s_suppkey - 10 <= 0
""")
def _(t: Tables):
    return S.clear_keep_reserved(t.supplier.select((F.col("s_suppkey") - 10).alias("vendor_pk"), "s_name"), "vendor_pk")
