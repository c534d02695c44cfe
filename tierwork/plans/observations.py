"""Observations on several levels, coverage of a master by layers, reconciliation by level, stored profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.functions.dates import month_start
from tierwork.functions.values import money
from tierwork.operators import observations as O
from tierwork.operators import profiles as P
from tierwork.plans.inputs import DOCUMENTS, NATION_ORDERS, documents, nation_orders
from tierwork.plans.quality import PERTURBED, perturbed
from tierwork.plans.registry import Tables, plan
from tierwork.sources.storage import fresh_dir

AS_OF = dt.datetime(2024, 2, 1)

# values that stand for nothing, per column
DEFAULTS = {
    "ship_date": ["1998-01-01"], "flag": ["N"], "l_linestatus": ["O"], "quantity": [1, 2], "p_name": ["small ring"], "p_brand": ["Brand#1"],
    "p_type": ["ECONOMY", "PROMO"], "p_size": [1], "s_name": ["Supplier#000000000"], "o_orderstatus": ["P"],
    "o_orderpriority": ["5-LOW", "4-NOT SPECIFIED"], "c_mktsegment": ["BUILDING"],
}
LEVELS = {"entity_day": ["nation", "o_date"], "entity_month": ["nation", "month"], "month": ["month"], "total": []}


def _default_sql(c: str, values: list) -> str:
    listed = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
    return f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_null, count(*) FILTER (WHERE {c} IN ({listed})) AS {c}_default"


@plan("observations_by_level", f"""
WITH {DOCUMENTS}, x AS (
  SELECT d.*, nullif(l_returnflag, 'R') AS flag, CAST(date_trunc('month', d.o_date) AS DATE) AS month, p_name, p_brand, p_type, p_size, s_name,
         o.o_orderstatus, o.o_orderpriority, nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment
  FROM doc_lines d JOIN dated_orders o ON o.o_orderkey = d.o_orderkey JOIN customer ON c_custkey = d.o_custkey
  LEFT JOIN (SELECT * FROM part WHERE p_size < 40) ON p_partkey = l_partkey LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 0) ON s_suppkey = l_suppkey)
SELECT CASE grouping_id(nation, o_date, month) WHEN 1 THEN 'entity_day' WHEN 2 THEN 'entity_month' WHEN 6 THEN 'month' ELSE 'total' END AS level,
       nation, o_date, month, count(*) AS n_rows, {", ".join(_default_sql(c, v) for c, v in DEFAULTS.items())}
FROM x GROUP BY GROUPING SETS ((nation, o_date), (nation, month), (month), ())
""")
def observations_by_level(t: Tables):
    """24 counts by entity and day, by entity and month, by month and in total; masters lack some of the items and suppliers."""
    heads = nation_orders(t).join(t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment"), "o_custkey")
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", F.nullif("l_returnflag", F.lit("R")).alias("flag"), "l_linestatus",
        F.to_date("l_shipdate").alias("ship_date"), F.col("l_quantity").cast("int").alias("quantity"))
    items = t.part.where("p_size < 40").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_brand", "p_type", "p_size")
    vendors = t.supplier.where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name")
    x = lines.join(heads, "o_orderkey").join(items, "l_partkey", "left").join(vendors, "l_suppkey", "left").withColumns({
        "month": month_start(F.col("o_date")), "c_mktsegment": F.nullif("c_mktsegment", F.lit("HOUSEHOLD"))})
    return O.observe(x, LEVELS, O.null_and_default(DEFAULTS))


@plan("coverage_by_layer", f"""
WITH {NATION_ORDERS},
raw AS (SELECT c_nationkey AS nation, CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_custkey // 3 AS VARCHAR) END AS code, c_name, c_mktsegment FROM customer),
cleaned AS (SELECT nation, coalesce(code, 'NaN') AS code, c_name FROM raw WHERE c_mktsegment <> 'MACHINERY'),
modelled AS (SELECT nation, code, min(c_name) AS c_name FROM cleaned WHERE code <> 'NaN' GROUP BY 1, 2),
stacked AS (SELECT 'raw' AS layer, nation, code FROM raw UNION ALL SELECT 'cleaned', nation, nullif(code, 'NaN') FROM cleaned UNION ALL SELECT 'modelled', nation, code FROM modelled),
per_key AS (SELECT layer, nation, code, count(*) AS n FROM stacked GROUP BY ALL),
f AS (SELECT n.nation, CAST(o_custkey // 3 AS VARCHAR) AS code, c_name, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE amount END AS amount
      FROM nation_orders n JOIN customer ON c_custkey = o_custkey WHERE o_date >= DATE '2000-08-01'),
p AS (SELECT f.nation, f.code, sum(amount) AS amount, bool_or(m.code IS NOT NULL) AS inside, bool_or(coalesce(f.c_name = m.c_name, FALSE)) AS same
      FROM f LEFT JOIN modelled m ON m.nation = f.nation AND m.code = f.code GROUP BY 1, 2)
SELECT DATE '2024-02-01' AS as_of,
  {", ".join(f"(SELECT coalesce(sum(n), 0)::BIGINT FROM per_key WHERE layer = '{x}') AS {x}_rows, (SELECT coalesce(sum(n), 0)::BIGINT FROM per_key WHERE layer = '{x}' AND code IS NOT NULL) AS {x}_with_code, (SELECT coalesce(sum(n), 0)::BIGINT FROM per_key WHERE layer = '{x}' AND code IS NULL) AS {x}_without_code, (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM per_key WHERE layer = '{x}' AND code IS NOT NULL) AS {x}_duplicates" for x in ("raw", "cleaned", "modelled"))},
  count(*) FILTER (WHERE inside AND amount <> 0) AS inside_with_revenue, count(*) FILTER (WHERE inside AND amount = 0) AS inside_without_revenue,
  count(*) FILTER (WHERE NOT inside AND amount <> 0) AS outside_with_revenue, count(*) FILTER (WHERE NOT inside AND amount = 0) AS outside_without_revenue,
  coalesce(sum(amount) FILTER (WHERE inside), 0)::DOUBLE AS inside_revenue, coalesce(sum(amount) FILTER (WHERE NOT inside), 0)::DOUBLE AS outside_revenue,
  count(*) FILTER (WHERE inside AND NOT same) AS name_mismatches
FROM p
""")
def coverage_by_layer(t: Tables):
    """One row a day: a customer master in three layers, and the revenue of the last year inside and outside of it."""
    code = F.floor(F.col("c_custkey") / 3).cast("string")
    raw = t.customer.select(
        F.col("c_nationkey").alias("nation"), F.when(F.col("c_acctbal") >= 0, code).alias("code"), "c_name", "c_mktsegment")
    cleaned = raw.where("c_mktsegment <> 'MACHINERY'").withColumn("code", F.coalesce("code", F.lit("NaN")))
    modelled = cleaned.where("code <> 'NaN'").groupBy("nation", "code").agg(F.min("c_name").alias("c_name"))
    names = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", code.alias("code"))
    facts = nation_orders(t).where(F.col("o_date") >= "2000-08-01").join(names, "o_custkey").withColumn(
        "amount", F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount")))
    layers = O.layer_counts({"raw": raw, "cleaned": cleaned, "modelled": modelled}, ["nation"], "code")
    revenue = O.revenue_coverage(facts, modelled, ["nation", "code"], "amount", "c_name", "c_name")
    both = layers.unionByName(revenue, allowMissingColumns=True)  # one row each, laid over one another
    return both.agg(*[F.max(c).alias(c) for c in both.columns]).select(F.lit(AS_OF.date()).alias("as_of"), "*")


MEASURED = """sides AS (
  SELECT nation, CAST(year(o_date) AS INT) AS yr, CAST(month(o_date) AS INT) AS mon, amount AS revenue, CAST(amount * 0.25 AS DECIMAL(18,2)) AS margin, 'l' AS side FROM nation_orders
  UNION ALL SELECT c_nationkey, CAST(year(o_date) AS INT), CAST(month(o_date) AS INT), amount, CAST(amount * 0.25 AS DECIMAL(18,2)), 'r' FROM perturbed JOIN customer ON c_custkey = o_custkey),
summed AS (
  SELECT grouping_id(nation, yr, mon) AS gid, nation, yr, mon, unnest(['revenue', 'margin']) AS measure,
         unnest([coalesce(sum(revenue) FILTER (WHERE side = 'l'), 0), coalesce(sum(margin) FILTER (WHERE side = 'l'), 0)]) AS x,
         unnest([coalesce(sum(revenue) FILTER (WHERE side = 'r'), 0), coalesce(sum(margin) FILTER (WHERE side = 'r'), 0)]) AS y
  FROM sides GROUP BY GROUPING SETS ((nation, yr, mon), (nation, yr), (yr, mon), (yr), ()))"""
PERTURBED_NATIONS = NATION_ORDERS + PERTURBED.split("FROM orders)", 1)[1]
RECON_LEVELS = {"entity_month": ["nation", "yr", "mon"], "entity_year": ["nation", "yr"], "month": ["yr", "mon"], "year": ["yr"], "total": []}


def _sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    def measured(df: DataFrame) -> DataFrame:
        return df.select("nation", F.year("o_date").alias("yr"), F.month("o_date").alias("mon"), F.col("amount").alias("revenue"),
                         money(F.col("amount") * F.lit("0.25").cast("decimal(3,2)")).alias("margin"))

    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return measured(nation_orders(t)), measured(perturbed(t).join(who, "o_custkey"))


@plan("recon_by_level", f"""
WITH {PERTURBED_NATIONS}, {MEASURED}
SELECT CASE gid WHEN 0 THEN 'entity_month' WHEN 1 THEN 'entity_year' WHEN 4 THEN 'month' WHEN 5 THEN 'year' ELSE 'total' END AS level, nation, yr, mon, measure,
       x::DOUBLE AS left_amount, y::DOUBLE AS right_amount, (x - y)::DOUBLE AS difference, (x - y)::DOUBLE / nullif(x::DOUBLE, 0) * 100 AS difference_pct
FROM summed
""")
def recon_by_level(t: Tables):
    """Ledger against transactions for two measures on five levels, from one stacked aggregate."""
    out = O.reconcile_levels(*_sides(t), RECON_LEVELS, ["revenue", "margin"])
    return out.withColumns({c: F.col(c).cast("double") for c in ("left_amount", "right_amount", "difference")})


@plan("recon_year_to_date", f"""
WITH {PERTURBED_NATIONS}, {MEASURED},
y AS (SELECT *, sum(x) OVER w AS yx, sum(y) OVER w AS yy FROM summed WHERE gid = 0 WINDOW w AS (PARTITION BY nation, measure, yr ORDER BY mon))
SELECT nation, yr, mon, measure, x::DOUBLE AS left_amount, y::DOUBLE AS right_amount, yx::DOUBLE AS ytd_left_amount, yy::DOUBLE AS ytd_right_amount,
       (yx - yy)::DOUBLE AS ytd_difference, (yx - yy)::DOUBLE / nullif(yx::DOUBLE, 0) * 100 AS ytd_difference_pct
FROM y
""")
def recon_year_to_date(t: Tables):
    monthly = O.reconcile_levels(*_sides(t), {"entity_month": RECON_LEVELS["entity_month"]}, ["revenue", "margin"])
    ytd = O.year_to_date(monthly, ["nation", "measure"], "yr", "mon", ["left_amount", "right_amount"])
    out = O.with_difference(ytd, "ytd_left_amount", "ytd_right_amount", "ytd_").drop("level", "difference", "difference_pct")
    return out.withColumns({c: F.col(c).cast("double") for c in out.columns if c.endswith(("amount", "difference"))})


PROFILED = ("lang", "text", "n_chars", "author")


@plan("dq_profile_merged", """
WITH s AS (SELECT source, count(DISTINCT lang) > 1 AS lang, count(DISTINCT text) > 1 AS text, count(DISTINCT n_chars) > 1 AS n_chars FROM documents GROUP BY 1),
p AS (
  SELECT 'source' AS col_name, 'column_id' AS column_type, count(*) AS rows, count(source) AS non_null_col, count(*) - count(source) AS null_col,
         count(DISTINCT source) AS distinct_col, NULL AS missing_names, NULL AS multiple_names FROM documents
  UNION ALL SELECT 'lang', 'column_attr', count(*), count(lang), count(*) - count(lang), count(DISTINCT lang),
         count(*) FILTER (WHERE regexp_replace(coalesce(lang, ''), '\\s', '', 'g') = ''), (SELECT count(*) FILTER (WHERE lang) FROM s) FROM documents
  UNION ALL SELECT 'text', 'column_attr', count(*), count(text), count(*) - count(text), count(DISTINCT text),
         count(*) FILTER (WHERE regexp_replace(coalesce(text, ''), '\\s', '', 'g') = ''), (SELECT count(*) FILTER (WHERE text) FROM s) FROM documents
  UNION ALL SELECT 'n_chars', 'column_attr', count(*), count(n_chars), count(*) - count(n_chars), count(DISTINCT n_chars),
         count(*) FILTER (WHERE n_chars IS NULL), (SELECT count(*) FILTER (WHERE n_chars) FROM s) FROM documents
  UNION ALL SELECT 'author', 'column_missing', NULL, NULL, NULL, NULL, NULL, NULL)
SELECT 'corpus' AS schema, 'documents' AS table, 'raw' AS env, p.*, DATE '2024-02-01' AS as_of FROM p
""")
def dq_profile_merged(t: Tables):
    """Two runs that share the documents between them, stored one after the other; the profile comes from their states."""
    root, source = fresh_dir(t.spark, "profiles"), "corpus.documents"
    for run, part in enumerate((F.col("n_chars") % 2 == 0, ~F.coalesce(F.col("n_chars") % 2 == 0, F.lit(False)))):
        P.load_profile(t.documents.where(part), root, source, "raw", "source", PROFILED, f"r{run}", AS_OF)
    out = P.merged_profile(t.spark, root, source, "raw", "source", PROFILED, AS_OF)
    return out.withColumn("as_of", F.to_date("as_of"))
