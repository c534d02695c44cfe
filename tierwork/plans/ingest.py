"""Sources and landing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.operators import columns as C
from tierwork.operators.cdc import advance_watermark as advance
from tierwork.operators.history import surrogate_keys
from tierwork.operators.ordered import by_width
from tierwork.plans.inputs import DATED_ORDERS, dated_orders
from tierwork.plans.registry import hash_sql, plan, Tables
from tierwork.sources import readers as R


@plan("read_increment", """
SELECT event_id, user_id, event_type, 'tenant_a' AS tenant, DATE '2024-02-01' AS load_date
FROM events WHERE ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'
""")
def _(t: Tables):
    rows = R.read_increment(
        t.events, "ts", F.lit("2024-01-10").cast("timestamp_ntz"), F.lit("2024-01-20").cast("timestamp_ntz"),
        tenant="tenant_a", load_date=dt.date(2024, 2, 1),
    )
    return rows.select("event_id", "user_id", "event_type", "tenant", "load_date")


@plan("load_increment_by_max", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_date FROM orders
WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '2000-03-15')
""")
def _(t: Tables):
    loaded = t.orders.where(F.col("o_orderdate") < F.lit("2000-03-15").cast("timestamp_ntz"))
    return R.load_increment(t.orders, loaded, "o_orderdate").select("o_orderkey", F.to_date("o_orderdate").alias("o_date"))


@plan("advance_watermark", f"""
WITH {DATED_ORDERS}
SELECT o_orderpriority, o_orderstatus,
       greatest(max(o_date), CASE WHEN o_orderstatus = 'O' THEN DATE '2005-01-01' ELSE DATE '1998-01-01' END) AS mark
FROM dated_orders GROUP BY o_orderpriority, o_orderstatus
""")
def _(t: Tables):
    o = dated_orders(t)
    keys = ["o_orderpriority", "o_orderstatus"]
    stored = o.select(*keys).distinct().withColumn(
        "mark", F.when(F.col("o_orderstatus") == "O", dt.date(2005, 1, 1)).otherwise(dt.date(1998, 1, 1))
    )
    return advance(stored, o.withColumnRenamed("o_date", "mark"), keys, "mark")


@plan("load_full", "SELECT s_suppkey, s_name, DATE '2024-02-01' AS loaded_on FROM supplier")
def _(t: Tables):
    return R.load_full(t.supplier.select("s_suppkey", "s_name"), "loaded_on", dt.date(2024, 2, 1))


@plan("clean_names_and_map", """
SELECT c_custkey AS customer_no, c_name AS customer_name, 'NaN' AS second_name, c_mktsegment AS market_segment
FROM customer
""")
def _(t: Tables):
    raw = t.customer.select(
        F.col("c_custkey").alias("Customer No."), F.col("c_name").alias(" Customer  Name "),
        F.col("c_mktsegment").alias("Market-Segment"),
    )
    clean = C.clean_column_names(raw)
    mapped = clean.select(*C.mapped_columns({
        "customer_no": "customer_no", "customer_name": "customer_name", "second_name": None, "seg": "market_segment",
    }))
    return C.rename_columns(mapped, {"seg": "market_segment"})


@plan("parquet_names", "SELECT p_partkey AS PartNo, p_brand AS \"Brand.Name\" FROM part")
def _(t: Tables):
    return C.clean_for_parquet(t.part.select(F.col("p_partkey").alias("Part No"), F.col("p_brand").alias("Brand.(Name);")))


@plan("cast_to_target", """
SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS DECIMAL(10,2))::DOUBLE AS c_acctbal,
       TRY_CAST(replace(c_name, 'Customer#', '') AS INT) AS c_number, TRY_CAST(c_mktsegment AS INT) AS c_mktsegment
FROM customer
""")
def _(t: Tables):
    target = T.StructType([
        T.StructField("c_custkey", T.LongType()), T.StructField("c_nationkey", T.StringType()),
        T.StructField("c_acctbal", T.DecimalType(10, 2)), T.StructField("c_number", T.IntegerType()),
        T.StructField("c_mktsegment", T.IntegerType()),
    ])
    df = t.customer.withColumn("c_number", F.replace("c_name", F.lit("Customer#"), F.lit("")))
    return C.cast_to_schema(df, target, strict=False).withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@plan("project_to_target", """
SELECT s_name, s_suppkey, CAST(NULL AS VARCHAR) AS s_comment FROM supplier
""")
def _(t: Tables):
    out = C.project_to_target(t.supplier, ["s_name", "s_suppkey", "s_comment"], fill=True)
    return out.withColumn("s_comment", F.col("s_comment").cast("string"))


@plan("conform_unified_shape", """
SELECT CAST(o_orderkey AS VARCHAR) AS document_no, CAST(NULL AS DATE) AS delivery_date,
       CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS revenue, CAST(NULL AS VARCHAR) AS vendor_name
FROM orders
""")
def _(t: Tables):
    shape = T.StructType([
        T.StructField("document_no", T.StringType()), T.StructField("delivery_date", T.DateType()),
        T.StructField("revenue", T.DecimalType(18, 2)), T.StructField("vendor_name", T.StringType()),
    ])
    rows = t.orders.select(F.col("o_orderkey").alias("document_no"), F.col("o_totalprice").alias("revenue"))
    return C.conform(rows, shape).withColumn("revenue", F.col("revenue").cast("double"))


@plan("extract_keys", f"""
SELECT DISTINCT l_orderkey, l_linenumber, {hash_sql('l_orderkey', 'l_linenumber')} AS key_hash
FROM lineitem
""")
def _(t: Tables):
    return R.extract_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@plan("assign_line_number", """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity,
       row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_quantity, l_shipdate) AS line_no
FROM lineitem
""")
def _(t: Tables):
    lines = R.assign_line_number(
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"),
        ["l_orderkey"], ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"], by_width("l_partkey", 100_000),
    )
    return lines.drop("l_shipdate")


@plan("split_hash_union", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'R' THEN {hash_sql('l_orderkey', 'l_linenumber')} ELSE {hash_sql('l_partkey', 'l_suppkey')} END AS hash_id
FROM lineitem
""")
def _(t: Tables):
    # 256 bits because the SQL side has no 512-bit digest
    return R.split_hash_union(
        t.lineitem, F.col("l_returnflag") == "R", ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"], bits=256
    ).select("l_orderkey", "l_linenumber", "l_partkey", "hash_id")


@plan("add_sequence", """
SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS seq_id FROM events
""")
def _(t: Tables):
    out = R.add_sequence(t.events.select("event_id", "user_id", "ts"), ["ts", "event_id"], None)
    return out.drop("ts")


@plan("surrogate_keys", """
SELECT c_custkey, c_name, 0 + row_number() OVER (ORDER BY c_custkey)
  + (SELECT max(s_suppkey) FROM supplier) AS customer_pk
FROM customer
""")
def _(t: Tables):
    existing = t.supplier.select(F.col("s_suppkey").alias("customer_pk"))
    return surrogate_keys(
        t.customer.select("c_custkey", "c_name"), ["c_custkey"], by_width("c_custkey", 1_000_000), existing, "customer_pk")


@plan("col_from_filename", "SELECT 'na' AS entity, count(*) AS n_rows FROM nation")
def _(t: Tables):
    return R.with_file_part(t.nation, r"^([a-z]{2})", "entity").groupBy("entity").agg(F.count(F.lit(1)).alias("n_rows"))


@plan("json_landing", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(NULL AS VARCHAR) AS source_app FROM events
WHERE ts < TIMESTAMP '2024-01-15'
UNION ALL
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_type AS source_app FROM events
WHERE ts >= TIMESTAMP '2024-01-15'
""")
def _(t: Tables):
    mid = F.lit("2024-01-15").cast("timestamp_ntz")
    parsed = R.parse_json(t.events.select("event_id", "event_type", "ts", "props"), "props", "k long")
    old = parsed.where(F.col("ts") < mid).select("event_id", "k")
    new = parsed.where(F.col("ts") >= mid).select("event_id", "k", F.col("event_type").alias("source_app"))
    return R.append_with_drift(old, new)


@plan("nested_landing", """
SELECT user_id, event_id, event_type AS status, CAST(ts AS DATE) AS day, 'daily' AS load_kind
FROM events WHERE ts >= TIMESTAMP '2024-01-12' AND ts < TIMESTAMP '2024-01-13'
""")
def _(t: Tables):
    nested = t.events.select("user_id", "ts", F.struct("event_id", F.col("event_type").alias("status")).alias("attempt"))
    return R.land_day(nested, "ts", "2024-01-12", load_kind="daily").select(
        "user_id", "attempt.event_id", "attempt.status", F.to_date("ts").alias("day"), "load_kind")


@plan("typed_landing", """
SELECT CAST(page_id AS VARCHAR) AS page_code, url AS address, length(html) AS size, 'sheet_1' AS sheet FROM pages
""")
def _(t: Tables):
    return C.land_typed(
        t.pages.withColumn("n", F.length("html")),
        {"page_code": ("page_id", "string"), "address": ("url", "string"), "size": ("n", "long")}, sheet="sheet_1",
    )


@plan("unloaded_units", """
SELECT DISTINCT source FROM documents WHERE source NOT IN (
  SELECT d.source FROM documents d JOIN labels l ON l.doc_id = d.doc_id WHERE l.toxic = 1)
""")
def _(t: Tables):
    loaded = t.documents.select("doc_id", "source").join(t.labels.where("toxic = 1"), "doc_id", "left_semi")
    return R.unloaded_units(t.documents, loaded, "source")


SEGMENT_CODES = {"AUTOMOBILE": "S-10", "BUILDING": "S-20", "FURNITURE": "S-30"}  # fixed values


@plan("constant_table", """
SELECT coalesce(m.new_code, c_mktsegment) AS segment, count(*) AS n
FROM customer LEFT JOIN (VALUES ('AUTOMOBILE', 'S-10'), ('BUILDING', 'S-20'), ('FURNITURE', 'S-30')) m(old_code, new_code)
  ON m.old_code = c_mktsegment
GROUP BY 1
""")
def _(t: Tables):
    out = R.recode(t.customer.select(F.col("c_mktsegment").alias("segment")), "segment", SEGMENT_CODES)
    return out.groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@plan("valid_window", """
SELECT l_orderkey, l_linenumber FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderdate >= TIMESTAMP '1998-01-01' OR l_shipdate BETWEEN TIMESTAMP '1998-01-01' AND TIMESTAMP '1998-12-31'
""")
def _(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    since, until = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1998-12-31"))
    return R.valid_window(lines, "o_orderdate", "l_shipdate", since, until).select("l_orderkey", "l_linenumber")


@plan("register_tables", "SELECT r_name, count(*) AS n_nations FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1")
def _(t: Tables):
    R.register_tables(t.spark, t.root, ["region", "nation"], prefix="landed_", recreate=True)
    return t.spark.sql(
        "SELECT r_name, count(*) AS n_nations FROM landed_region JOIN landed_nation ON n_regionkey = r_regionkey GROUP BY r_name")
