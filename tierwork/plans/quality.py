"""Counts, checks and comparisons on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwork.functions.dates import month_start
from tierwork.functions.values import money, safe_ratio, sum_when
from tierwork.operators import quality as Q
from tierwork.plans.inputs import DATED_ORDERS, NATION_ORDERS, dated_orders, nation_orders
from tierwork.plans.registry import Tables, plan


def perturbed(t: Tables):
    """A changed copy of the orders: low-priority ones are gone, urgent amounts up 10 %, high ones up 1 %, status rewritten."""
    return dated_orders(t).where("o_orderpriority <> '5-LOW'").withColumn(
        "amount", money(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("amount") * F.lit("1.10").cast("decimal(3,2)"))
                        .when(F.col("o_orderpriority") == "2-HIGH", F.col("amount") * F.lit("1.01").cast("decimal(3,2)"))
                        .otherwise(F.col("amount")))
    ).withColumn("o_orderstatus", F.when(F.col("o_date") < "1996-01-01", F.lit(None)).otherwise(F.col("o_orderstatus")))


PERTURBED = DATED_ORDERS + """, perturbed AS (
  SELECT * REPLACE (
    CAST(CASE o_orderpriority WHEN '1-URGENT' THEN amount * 1.10 WHEN '2-HIGH' THEN amount * 1.01 ELSE amount END AS DECIMAL(18,2)) AS amount,
    CASE WHEN o_date < DATE '1996-01-01' THEN NULL ELSE o_orderstatus END AS o_orderstatus)
  FROM dated_orders WHERE o_orderpriority <> '5-LOW')"""


@plan("normalise_missing", """
SELECT doc_id, CASE WHEN trim(s) = '' OR s IS NULL THEN 'NaN' ELSE s END AS source
FROM (SELECT doc_id, CASE lang WHEN 'en' THEN source WHEN 'fr' THEN '  ' WHEN 'de' THEN '' END AS s FROM documents)
""")
def _(t: Tables):
    from tierwork.functions.text import normalise_missing

    s = F.when(F.col("lang") == "en", F.col("source")).when(F.col("lang") == "fr", "  ").when(F.col("lang") == "de", "")
    return t.documents.select("doc_id", normalise_missing(s).alias("source"))


@plan("dq_missing_counts", """
SELECT count(*) FILTER (WHERE regexp_replace(coalesce(text, ''), '\\s', '', 'g') = '') AS text,
       count(*) FILTER (WHERE lang IS NULL OR trim(lang) = '') AS lang,
       count(*) FILTER (WHERE source IS NULL OR trim(source) = '') AS source
FROM documents
""")
def _(t: Tables):
    return Q.missing_counts(t.documents, ["text", "lang", "source"])


@plan("dq_profile", """
WITH d AS (SELECT d.*, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT 'lang' AS col_name, count(*) AS rows, count(lang) AS non_null_col, count(*) - count(lang) AS null_col,
       count(DISTINCT lang) AS distinct_col, count(*) FILTER (WHERE lang IS NULL OR trim(lang) = '') AS missing_col FROM d
UNION ALL SELECT 'source', count(*), count(source), count(*) - count(source), count(DISTINCT source), count(*) FILTER (WHERE source IS NULL) FROM d
UNION ALL SELECT 'quality', count(*), count(quality), count(*) - count(quality), count(DISTINCT quality), count(*) FILTER (WHERE quality IS NULL) FROM d
UNION ALL SELECT 'doc_id', count(*), count(doc_id), count(*) - count(doc_id), count(DISTINCT doc_id), count(*) FILTER (WHERE doc_id IS NULL) FROM d
""")
def dq_profile(t: Tables):
    d = t.documents.select("doc_id", "lang", "source").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return Q.profile(d, ["lang", "source", "quality", "doc_id"])


@plan("dq_multi_values", """
SELECT count(*) AS multiple_count FROM (
  SELECT o_custkey FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1)
""")
def _(t: Tables):
    return Q.multiple_values(t.orders, "o_custkey", "o_orderstatus")


@plan("dq_accepted_values", """
SELECT count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS n_bad,
       count(*) FILTER (WHERE event_type IS NULL) AS n_null,
       min(event_type) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')) AS example, 'ERROR' AS status
FROM events
""")
def _(t: Tables):
    return Q.accepted_values(t.events, "event_type", ["click", "view", "purchase"])


@plan("dq_orphan_keys", """
SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)
""")
def _(t: Tables):
    master = t.part.where("p_size < 45").select(F.col("p_partkey").alias("l_partkey"))
    return Q.orphan_keys(t.lineitem, master, ["l_partkey"])


@plan("active_keys", """
SELECT user_id, event_type FROM events GROUP BY 1, 2 HAVING NOT max(value > 60)
""")
def _(t: Tables):
    e = t.events.select("user_id", "event_type", (F.col("value") > 60).alias("active"))
    return Q.keys_without_active_row(e, ["user_id", "event_type"], "active")


@plan("positive_values", """
SELECT count(*) FILTER (WHERE NOT coalesce(c_acctbal > 0, FALSE)) AS c_acctbal,
       count(*) FILTER (WHERE NOT coalesce(c_nationkey > 0, FALSE)) AS c_nationkey FROM customer
""")
def _(t: Tables):
    return Q.not_positive(t.customer, ["c_acctbal", "c_nationkey"])


@plan("placeholder_columns", """
SELECT count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS segment, 0::BIGINT AS c_name FROM customer
""")
def _(t: Tables):
    c = t.customer.select(
        "c_name", F.when(F.col("c_mktsegment") == "BUILDING", "NaN").otherwise(F.col("c_mktsegment")).alias("segment"))
    return Q.placeholder_counts(c, ["segment", "c_name"])


@plan("sentinel_counts_by_day", f"""
WITH {DATED_ORDERS}
SELECT o_date, count(*) AS n_rows, count(*) FILTER (WHERE o_orderpriority IS NULL OR o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED')) AS o_orderpriority_missing,
       count(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderstatus IN ('P')) AS o_orderstatus_missing
FROM dated_orders GROUP BY 1
""")
def _(t: Tables):
    return Q.sentinel_counts(
        dated_orders(t), [F.col("o_date")], {"o_orderpriority": ["5-LOW", "4-NOT SPECIFIED"], "o_orderstatus": ["P"]})


@plan("check_constraints", """
SELECT 'quantity_positive' AS rule, count(*) FILTER (WHERE NOT l_quantity > 1) AS violations FROM lineitem
UNION ALL SELECT 'flag_domain', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL SELECT 'date_range', count(*) FILTER (WHERE NOT (l_shipdate >= TIMESTAMP '1995-06-01' AND l_shipdate < TIMESTAMP '9999-12-31')) FROM lineitem
""")
def _(t: Tables):
    start, end = (F.lit(d).cast("timestamp_ntz") for d in ("1995-06-01", "9999-12-31"))
    return Q.check_constraints(t.lineitem, {
        "quantity_positive": F.col("l_quantity") > 1, "flag_domain": F.col("l_returnflag").isin("A", "N"),
        "date_range": (F.col("l_shipdate") >= start) & (F.col("l_shipdate") < end),
    })


@plan("coverage_report", f"""
WITH {DATED_ORDERS}, rev AS (SELECT o_custkey, sum(amount) AS revenue FROM dated_orders WHERE o_date >= DATE '2001-01-01' GROUP BY 1)
SELECT (SELECT count(*) FROM customer) AS n_customers, (SELECT count(*) FROM customer WHERE c_acctbal < 0) AS n_negative,
       count(*) FILTER (WHERE o_custkey IS NOT NULL) AS with_revenue, count(*) FILTER (WHERE o_custkey IS NULL) AS without_revenue,
       CAST(sum(revenue) AS DOUBLE) AS revenue, (SELECT count(DISTINCT c_name) FROM customer) AS n_names
FROM customer LEFT JOIN rev ON o_custkey = c_custkey
""")
def coverage_report(t: Tables):
    rev = dated_orders(t).where(F.col("o_date") >= "2001-01-01").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("amount").alias("revenue"))
    return t.customer.join(rev, "c_custkey", "left").agg(
        F.count(F.lit(1)).alias("n_customers"), F.count_if(F.col("c_acctbal") < 0).alias("n_negative"),
        F.count("revenue").alias("with_revenue"), F.count_if(F.col("revenue").isNull()).alias("without_revenue"),
        F.sum("revenue").cast("double").alias("revenue"), F.count_distinct("c_name").alias("n_names"),
    )


@plan("volume_log", f"""
WITH {NATION_ORDERS}
SELECT nation, o_date, count(*) AS n_rows, CAST(sum(amount) AS DOUBLE) AS revenue, DATE '2024-02-01' AS logged_on
FROM nation_orders GROUP BY 1, 2
""")
def _(t: Tables):
    return nation_orders(t).groupBy("nation", "o_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("amount").cast("double").alias("revenue"),
    ).withColumn("logged_on", F.lit("2024-02-01").cast("date"))


@plan("column_summary", """
SELECT 'o_totalprice' AS column_name, count(*) AS n_rows, count(*) - count(o_totalprice) AS n_nulls, count(DISTINCT o_totalprice) AS n_distinct, round(avg(o_totalprice::DOUBLE), 4) AS mean,
  round(stddev_samp(o_totalprice::DOUBLE), 4) AS stddev, min(o_totalprice)::VARCHAR AS min_value, round(quantile_cont(o_totalprice::DOUBLE, 0.25), 4) AS q1,
  round(quantile_cont(o_totalprice::DOUBLE, 0.5), 4) AS median, round(quantile_cont(o_totalprice::DOUBLE, 0.75), 4) AS q3, max(o_totalprice)::VARCHAR AS max_value FROM orders
UNION ALL
SELECT 'o_custkey' AS column_name, count(*) AS n_rows, count(*) - count(o_custkey) AS n_nulls, count(DISTINCT o_custkey) AS n_distinct, round(avg(o_custkey::DOUBLE), 4) AS mean,
  round(stddev_samp(o_custkey::DOUBLE), 4) AS stddev, min(o_custkey)::VARCHAR AS min_value, round(quantile_cont(o_custkey::DOUBLE, 0.25), 4) AS q1,
  round(quantile_cont(o_custkey::DOUBLE, 0.5), 4) AS median, round(quantile_cont(o_custkey::DOUBLE, 0.75), 4) AS q3, max(o_custkey)::VARCHAR AS max_value FROM orders
UNION ALL
SELECT 'o_orderstatus' AS column_name, count(*) AS n_rows, count(*) - count(o_orderstatus) AS n_nulls, count(DISTINCT o_orderstatus) AS n_distinct, NULL, NULL, min(o_orderstatus), NULL, NULL, NULL, max(o_orderstatus) FROM orders
""")
def _(t: Tables):
    out = Q.summarise(t.orders, ["o_totalprice", "o_custkey", "o_orderstatus"])
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "stddev", "q1", "median", "q3")})


DIFF_SQL = f"""
WITH {PERTURBED}
SELECT CASE WHEN a.o_orderkey IS NULL THEN 'ONLY_IN_DF2' WHEN b.o_orderkey IS NULL THEN 'ONLY_IN_DF1'
            WHEN abs(a.amount - b.amount)::DOUBLE / a.amount::DOUBLE > 0.05 OR a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
            THEN 'DIFFERENT_VALUES' ELSE 'EXACT_MATCH' END AS comparison_status,
       coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
       CASE WHEN b.o_orderkey IS NULL THEN a.amount || ' -> NULL'
            WHEN abs(a.amount - b.amount)::DOUBLE / a.amount::DOUBLE > 0.05 THEN a.amount || ' -> ' || b.amount || ' -> (diff: 5.0%)'
            ELSE a.amount || ' ≈ ' || b.amount || ' ≈ (within 5.0%)' END AS amount_changes,
       CASE WHEN a.o_orderstatus IS DISTINCT FROM b.o_orderstatus
            THEN coalesce(a.o_orderstatus, 'NULL') || ' -> ' || coalesce(b.o_orderstatus, 'NULL')
            ELSE a.o_orderstatus || ' == ' || b.o_orderstatus END AS o_orderstatus_changes,
       abs(a.amount - b.amount)::DOUBLE / a.amount::DOUBLE * 100 AS amount_difference_pct, 5.0::DOUBLE AS amount_tolerance_pct,
       coalesce(b.o_orderpriority, a.o_orderpriority) AS o_orderpriority
FROM dated_orders a FULL JOIN perturbed b ON a.o_orderkey = b.o_orderkey
"""


@plan("dataset_diff", DIFF_SQL)
def dataset_diff(t: Tables):
    return Q.dataset_diff(
        dated_orders(t), perturbed(t), ["o_orderkey"], ["amount", "o_orderstatus"], {"amount": 0.05}, ["o_orderpriority"])


@plan("diff_summary", f"""
WITH {PERTURBED}
SELECT CASE WHEN a.k IS NULL THEN 'ONLY_RIGHT' WHEN b.k IS NULL THEN 'ONLY_LEFT' ELSE 'BOTH' END AS coverage, count(*) AS n_keys
FROM (SELECT DISTINCT o_custkey AS k, o_orderstatus AS s FROM dated_orders) a
FULL JOIN (SELECT DISTINCT o_custkey AS k, o_orderstatus AS s FROM perturbed) b ON a.k = b.k AND a.s IS NOT DISTINCT FROM b.s
GROUP BY 1
""")
def _(t: Tables):
    return Q.diff_summary(dated_orders(t), perturbed(t), ["o_custkey", "o_orderstatus"])


@plan("recon_exceptall", f"""
WITH {PERTURBED}, a AS (SELECT trim(o_orderstatus) AS status, coalesce(ceil(amount * 10) / 10, 0)::DOUBLE AS amount, o_date FROM dated_orders),
b AS (SELECT coalesce(trim(o_orderstatus), '') AS status, coalesce(ceil(amount * 10) / 10, 0)::DOUBLE AS amount, o_date FROM perturbed)
SELECT (SELECT count(*) FROM a) AS rows_left, (SELECT count(*) FROM b) AS rows_right,
       (SELECT count(*) FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)) AS except_all_left,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) AS except_all_right,
       (SELECT count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b)) AS subtract_left,
       (SELECT count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)) AS subtract_right
""")
def recon_exceptall(t: Tables):
    mapping = {"status": "o_orderstatus", "amount": "amount", "o_date": "o_date"}
    return Q.reconcile(Q.prepare_report(dated_orders(t), mapping, 1), Q.prepare_report(perturbed(t), mapping, 1))


@plan("recon_by_month", f"""
WITH {PERTURBED}, a AS (SELECT CAST(date_trunc('month', o_date) AS DATE) AS month, sum(amount) AS x FROM dated_orders GROUP BY 1),
b AS (SELECT CAST(date_trunc('month', o_date) AS DATE) AS month, sum(amount) AS y FROM perturbed GROUP BY 1)
SELECT coalesce(a.month, b.month) AS month, x::DOUBLE AS left_amount, y::DOUBLE AS right_amount,
       (coalesce(x, 0) - coalesce(y, 0))::DOUBLE AS difference,
       (coalesce(x, 0) - coalesce(y, 0))::DOUBLE / x::DOUBLE * 100 AS difference_pct
FROM a FULL JOIN b ON a.month = b.month
""")
def _(t: Tables):
    a, b = (df.withColumn("month", month_start(F.col("o_date"))) for df in (dated_orders(t), perturbed(t)))
    out = Q.compare_by_period(a, b, ["month"], "amount")
    return out.select("month", *[F.col(c).cast("double").alias(c) for c in out.columns if c != "month"])


@plan("recon_by_year", f"""
WITH {PERTURBED}, a AS (SELECT year(o_date)::INT AS yr, sum(amount) AS x FROM dated_orders GROUP BY 1),
b AS (SELECT year(o_date)::INT AS yr, sum(amount) AS y FROM perturbed GROUP BY 1)
SELECT a.yr, x::DOUBLE AS left_amount, y::DOUBLE AS right_amount, (x - y)::DOUBLE AS difference,
       (x - y)::DOUBLE / x::DOUBLE * 100 AS difference_pct
FROM a JOIN b ON a.yr = b.yr
""")
def _(t: Tables):
    a, b = (df.withColumn("yr", F.year("o_date")) for df in (dated_orders(t), perturbed(t)))
    out = Q.compare_by_period(a, b, ["yr"], "amount")
    return out.select("yr", *[F.col(c).cast("double").alias(c) for c in out.columns if c != "yr"])


@plan("match_share", f"""
WITH {NATION_ORDERS}, g AS (SELECT nation, o_orderstatus, sum(amount) AS amount, count(*) AS n_rows FROM nation_orders GROUP BY 1, 2)
SELECT nation, o_orderstatus, amount::DOUBLE AS amount, n_rows, (sum(amount) OVER (PARTITION BY nation))::DOUBLE AS parent_amount,
       amount::DOUBLE / (sum(amount) OVER (PARTITION BY nation))::DOUBLE AS share
FROM g
""")
def _(t: Tables):
    out = Q.share_of_total(nation_orders(t), ["nation"], "o_orderstatus", F.col("amount"))
    return out.withColumns({c: F.col(c).cast("double") for c in ("amount", "parent_amount")})


@plan("type_consistency", """
SELECT l_returnflag, count(DISTINCT l_linestatus) AS n_values FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) > 1
""")
def _(t: Tables):
    return Q.conflicting_groups(t.lineitem, "l_returnflag", "l_linestatus")


CATALOGUE = """catalogue AS (
  SELECT p_partkey AS entity, CASE WHEN p_size = 50 THEN NULL ELSE p_type END AS kind, length(p_type) + CASE WHEN p_type IN ('ECONOMY', 'PROMO') AND p_size > 40 THEN 10 ELSE 0 END AS run_group,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END AS run_order, CASE WHEN p_size > 10 THEN 1 ELSE 0 END AS active FROM part)"""


def _catalogue(t: Tables):
    far = F.col("p_type").isin("ECONOMY", "PROMO") & (F.col("p_size") > 40)
    return t.part.select(
        F.col("p_partkey").alias("entity"), F.when(F.col("p_size") != 50, F.col("p_type")).alias("kind"),
        (F.length("p_type") + F.when(far, 10).otherwise(0)).alias("run_group"),
        F.when(F.col("p_size") % 7 != 0, F.col("p_size")).alias("run_order"), F.when(F.col("p_size") > 10, 1).otherwise(0).alias("active"))


@plan("catalogue_conflicts", f"""
WITH {CATALOGUE}, p AS (SELECT DISTINCT kind, CAST(run_group AS VARCHAR) AS grp FROM catalogue WHERE kind IS NOT NULL AND run_group IS NOT NULL),
k AS (SELECT *, count(*) OVER (PARTITION BY kind) AS n_groups, count(*) OVER (PARTITION BY grp) AS n_kinds, bool_and(kind IN ('PROMO', 'SMALL')) OVER (PARTITION BY grp) AS free FROM p)
SELECT 'kind' AS side, kind AS value, grp AS other, n_groups AS n_others FROM k WHERE n_groups > 1 AND kind NOT IN ('PROMO', 'SMALL')
UNION ALL SELECT 'group', grp, kind, n_kinds FROM k WHERE n_kinds > 1 AND NOT free
""")
def _(t: Tables):
    return Q.catalogue_conflicts(_catalogue(t), "kind", "run_group", ["PROMO", "SMALL"])


@plan("catalogue_listing", f"""
WITH {CATALOGUE} SELECT entity, kind, run_group, coalesce(run_order, 0) AS sort_key, first_group, last_group, n_entries
FROM catalogue JOIN (SELECT kind, min(run_group) AS first_group, max(run_group) AS last_group, count(*) AS n_entries FROM catalogue GROUP BY 1) USING (kind)
WHERE active = 1 AND kind = 'ECONOMY' AND run_group = 7
""")
def _(t: Tables):
    entries = _catalogue(t)
    listed = Q.catalogue_listing(entries, "active", "run_order", {"kind": "ECONOMY", "run_group": 7})
    return listed.join(Q.group_span(entries, "kind", "run_group"), "kind").select(
        "entity", "kind", "run_group", "sort_key", "first_group", "last_group", "n_entries").orderBy("sort_key", "entity")


@plan("schema_compare", """
WITH a AS (SELECT column_name, column_type FROM (DESCRIBE orders)), n AS (SELECT count(*) AS n FROM orders)
SELECT column_name, left_type, right_type, (SELECT n FROM n) AS n_left
FROM (VALUES ('o_custkey', 'bigint', 'string'), ('o_orderpriority', 'string', NULL), ('o_channel', NULL, 'string')) v(column_name, left_type, right_type)
""")
def _(t: Tables):
    other = t.orders.withColumn("o_custkey", F.col("o_custkey").cast("string")).drop("o_orderpriority").withColumn("o_channel", F.lit("web"))
    missing = Q.missing_columns(t.orders, ["o_orderkey", "o_channel"])
    out = Q.schema_diff(t.orders, other, t.spark)
    n_left = t.orders.select(F.count(F.lit(1))).scalar()
    return out.where(F.col("column_name").isin(missing) | F.col("left_type").isNotNull()).withColumn("n_left", n_left)


@plan("month_end_sentinels", f"""
WITH {DATED_ORDERS}
SELECT CAST(date_trunc('month', o_date) AS DATE) AS month, sum(CASE WHEN o_orderstatus = 'F' THEN amount ELSE 0 END)::DOUBLE AS final_amount,
       sum(amount)::DOUBLE AS amount, sum(CASE WHEN o_orderstatus = 'F' THEN amount ELSE 0 END)::DOUBLE / sum(amount)::DOUBLE AS final_share
FROM dated_orders GROUP BY 1
""")
def _(t: Tables):
    out = dated_orders(t).groupBy(month_start(F.col("o_date")).alias("month")).agg(
        sum_when(F.col("o_orderstatus") == "F", F.col("amount")).cast("double").alias("final_amount"),
        F.sum("amount").cast("double").alias("amount"))
    return out.withColumn("final_share", safe_ratio(F.col("final_amount"), F.col("amount")))
