"""Master records, duplicate profiles, classification and matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.functions.values import money
from tierwork.operators import mastering as M
from tierwork.operators import matching as X
from tierwork.operators.hierarchy import closure, described_levels, flatten_levels, resolve_root
from tierwork.operators.ordered import by_width, keep_first
from tierwork.operators.rules import Rule, Test, apply_rules, finish_rules, with_defaults
from tierwork.plans.inputs import DOCUMENTS, documents, quarterly_rates, QUARTERLY_RATES
from tierwork.plans.registry import Tables, plan
from tierwork.sources.storage import cut_lineage


def accounts(t: Tables) -> DataFrame:
    """CRM accounts: the number is the brand, the tenant the part type, names repeat."""
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_partkey").cast("string").alias("account_id"),
        F.when(F.col("p_brand") == "Brand#1", "NaN").otherwise(F.col("p_brand")).alias("number"),
        F.col("p_type").alias("tenant"), F.timestamp_seconds(F.col("p_size") * 86400).alias("modified"), F.col("p_name").alias("name"),
        F.when(F.col("p_size") < 10, "NaN").otherwise(F.concat(F.lit("G"), F.col("p_size") % 5)).alias("group_code"),
        (F.col("p_size") <= 45).alias("is_current"),
    )


ACCOUNTS = """accounts AS (
  SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS account_id, CASE WHEN p_brand = 'Brand#1' THEN 'NaN' ELSE p_brand END AS number,
         p_type AS tenant, p_size AS modified, p_name AS name,
         CASE WHEN p_size < 10 THEN 'NaN' ELSE 'G' || (p_size % 5) END AS group_code, p_size <= 45 AS is_current FROM part)"""


@plan("best_record", f"""
WITH {ACCOUNTS}, names AS (
  SELECT number, tenant, name, row_number() OVER (PARTITION BY number, tenant, name ORDER BY modified DESC, account_id) AS rn, modified, account_id FROM accounts),
all_names AS (SELECT number, tenant, string_agg(name, '|' ORDER BY modified DESC, account_id) AS all_names FROM names WHERE rn = 1 GROUP BY 1, 2)
SELECT id, number, tenant, name, all_names FROM accounts JOIN all_names USING (number, tenant)
QUALIFY row_number() OVER (PARTITION BY number, tenant ORDER BY modified DESC, account_id) = 1
""")
def best_record(t: Tables):
    out = M.best_record(accounts(t), ["number", "tenant"], "modified", "account_id", "name")
    return out.select("id", "number", "tenant", "name", F.array_join("all_names", "|").alias("all_names"))


LONGEST = 5


@plan("best_record_bounded", f"""
WITH c AS (SELECT c_nationkey AS nation, c_name AS name, o_orderdate AS seen, o_orderkey AS id, o_orderpriority AS priority FROM orders JOIN customer ON c_custkey = o_custkey),
n AS (SELECT nation, name, seen, id, row_number() OVER (PARTITION BY nation, name ORDER BY seen DESC, id) AS rn FROM c),
p AS (SELECT nation, name, row_number() OVER (PARTITION BY nation ORDER BY seen DESC, id, name) AS position, count(*) OVER (PARTITION BY nation) AS n_names FROM n WHERE rn = 1),
b AS (SELECT nation, id, priority FROM c QUALIFY row_number() OVER (PARTITION BY nation ORDER BY seen DESC, id) = 1)
SELECT nation, 'record' AS kind, id, priority, string_agg(name, '|' ORDER BY position) AS names, max(n_names) AS position FROM b JOIN p USING (nation) WHERE position <= {LONGEST} GROUP BY ALL
UNION ALL SELECT nation, 'beyond', NULL, NULL, name, position FROM p WHERE position > {LONGEST}
""")
def best_record_bounded(t: Tables):
    """Last order of each nation with its latest buyers: few in the list, all others as rows."""
    who = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    orders = t.orders.select("o_custkey", F.col("o_orderdate").alias("at"), F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"))
    best, beyond = M.best_record_bounded(orders.join(who, "o_custkey"), ["nation"], "at", "id", "name", LONGEST)
    records = best.select("nation", F.lit("record").alias("kind"), "id", "priority", F.array_join("all_names", "|").alias("names"),
                          F.col("n_names").alias("position"))
    return records.unionByName(
        beyond.select("nation", F.lit("beyond").alias("kind"), F.col("name").alias("names"), "position"), allowMissingColumns=True)


@plan("customer_sources", f"""
WITH {ACCOUNTS} SELECT 'customer' AS kind, id, number, tenant FROM accounts WHERE is_current AND number <> 'NaN'
QUALIFY row_number() OVER (PARTITION BY number, tenant ORDER BY modified DESC, account_id) = 1
UNION ALL (SELECT 'grouped', id, number, tenant FROM accounts WHERE is_current AND number <> 'NaN' AND group_code <> 'NaN'
QUALIFY row_number() OVER (PARTITION BY number, tenant ORDER BY modified DESC, account_id) = 1)
UNION ALL (SELECT 'group', id, number, tenant FROM accounts WHERE is_current
QUALIFY row_number() OVER (PARTITION BY group_code, tenant ORDER BY modified DESC, account_id) = 1)
""")
def _(t: Tables):
    a = accounts(t)
    parts = {
        "customer": M.customer_source(a, "number", "tenant", "modified", "account_id", "name"),
        "grouped": M.grouped_customer_source(a, "number", "group_code", "tenant", "modified", "account_id"),
        "group": M.group_source(a, "group_code", "tenant", "modified", "account_id"),
    }
    frames = [df.select(F.lit(k).alias("kind"), "id", "number", "tenant") for k, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@plan("group_links", f"""
WITH {ACCOUNTS}, links AS (SELECT * FROM accounts WHERE is_current AND number <> 'NaN' AND group_code <> 'NaN'
  QUALIFY row_number() OVER (PARTITION BY number, tenant ORDER BY modified DESC, account_id) = 1),
customers AS (SELECT number, tenant, min(id) AS customer_pk FROM accounts GROUP BY 1, 2),
groups AS (SELECT group_code, tenant, max(id) AS group_pk FROM accounts GROUP BY 1, 2)
SELECT number, tenant, group_code, customer_pk, group_pk FROM links JOIN customers USING (number, tenant) JOIN groups USING (group_code, tenant)
""")
def _(t: Tables):
    a = accounts(t)
    links = M.grouped_customer_source(a, "number", "group_code", "tenant", "modified", "account_id")
    customers = a.groupBy("number", "tenant").agg(F.min("id").alias("customer_pk"))
    groups = a.groupBy("group_code", "tenant").agg(F.max("id").alias("group_pk"))
    return M.link_groups(links, customers, groups, "number", "tenant", "group_code", "customer_pk", "group_pk")


RANKS = {"promo": 1, "standard": 2, "large": 3}


@plan("duplicate_profile", """
SELECT p_partkey, p_name, p_brand, CASE WHEN p_type = 'PROMO' THEN 1 WHEN p_type = 'STANDARD' THEN 2 WHEN p_type = 'LARGE' THEN 3 ELSE 999 END AS priority,
       count(*) OVER (PARTITION BY p_name, p_brand) AS occurrence,
       row_number() OVER (PARTITION BY p_name, p_brand ORDER BY priority, p_partkey) AS row_number
FROM part
""")
def duplicate_profile(t: Tables):
    p = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return M.duplicate_profile(p, ["p_name", "p_brand"], ["p_partkey"], by_width("p_partkey", 100_000), "p_type", RANKS).drop("p_type")


@plan("duplicates_only", """
SELECT p_partkey, p_name, p_brand FROM part QUALIFY count(*) OVER (PARTITION BY p_name, p_brand) > 1
""")
def _(t: Tables):
    return M.duplicates_only(t.part.select("p_partkey", "p_name", "p_brand"), ["p_name", "p_brand"])


@plan("parent_child", """
WITH r AS (SELECT p_partkey, p_name, CASE WHEN p_type = 'PROMO' THEN 1 WHEN p_type = 'STANDARD' THEN 2 WHEN p_type = 'LARGE' THEN 3 ELSE 999 END AS pr FROM part)
SELECT p_partkey, p_name, row_number() OVER w = 1 AS is_parent,
       CASE WHEN row_number() OVER w > 1 THEN first_value(p_partkey) OVER w END AS parent_id
FROM r WINDOW w AS (PARTITION BY p_name ORDER BY pr, p_partkey)
""")
def parent_child(t: Tables):
    p = t.part.select("p_partkey", "p_name", "p_type")
    out = M.parent_child(p, "p_partkey", ["p_name"], ["p_partkey"], by_width("p_partkey", 100_000), "p_type", RANKS)
    return out.select("p_partkey", "p_name", "is_parent", "parent_id")


@plan("root_ancestor", """
WITH RECURSIVE up AS (
  SELECT p_partkey AS node, p_partkey AS root, 0 AS depth FROM part
  UNION ALL SELECT node, root // 3, depth + 1 FROM up WHERE root > 0)
SELECT node AS p_partkey, min(root) AS root, max(depth) AS depth FROM up GROUP BY 1
""")
def root_ancestor(t: Tables):
    edges = t.part.select("p_partkey", F.when(F.col("p_partkey") > 0, F.floor(F.col("p_partkey") / 3)).alias("parent"))
    return resolve_root(edges, "p_partkey", "parent")


@plan("hierarchy_flatten", """
WITH RECURSIVE edges AS (
  SELECT 'R' || r_regionkey AS node, NULL AS parent FROM region
  UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey FROM nation
  UNION ALL SELECT 'C' || c_custkey, 'N' || c_nationkey FROM customer), paths AS (
  SELECT node, [node] AS path FROM edges WHERE parent IS NULL
  UNION ALL SELECT e.node, list_append(p.path, e.node) FROM edges e JOIN paths p ON e.parent = p.node)
SELECT node, path[1] AS level_1, coalesce(path[2], node) AS level_2, coalesce(path[3], node) AS level_3, coalesce(path[4], node) AS level_4
FROM paths WHERE list_contains(path, 'R1')
""")
def hierarchy_flatten(t: Tables):
    def edge(df, mark, node, parent):
        return df.select(F.concat(F.lit(mark[0]), F.col(node)).alias("node"),
                         (F.concat(F.lit(mark[1]), F.col(parent)) if parent else F.lit(None).cast("string")).alias("parent"))

    edges = edge(t.region, "R ", "r_regionkey", None).unionByName(edge(t.nation, "NR", "n_nationkey", "n_regionkey")).unionByName(
        edge(t.customer, "CN", "c_custkey", "c_nationkey"))
    return flatten_levels(edges, "node", "parent", 4, under="R1")


RULES = (
    Rule(1, "duration", "1M", (Test("months", "eq", 1),)),
    Rule(1, "duration", ("years", "months"), (Test("months", "gt", 1),)),
    Rule(1, "duration", "Perpetual", (Test("vendor", "eq", "Brand#7"),)),
    Rule(1, "duration", ("capture", "sku", r"(\d)YR", " YR"), (Test("vendor", "eq", "Brand#3"), Test("sku", "regex", r"\dYR"))),
    Rule(2, "frequency", "Upfront", (Test("duration", "ne", "1M"),)),
    Rule(2, "frequency", "Monthly", (Test("duration", "eq", "1M"),)),
    Rule(2, "consumption", "Flexible", (Test("duration", "eq", "1M"),)),
    Rule(2, "consumption", "Capacity", (Test("duration", "ne", "1M"), Test("life", "not_null"))),
    Rule(2, "type", "Hardware", (Test("description", "regex", r"(?i)bolt|gear"),)),
    Rule(2, "type", "SW Subscription", (Test("description", "contains", "widget"), Test("duration", "contains", "YR"))),
    Rule(3, "mapping_duration", "Sure Mapping", (Test("duration", "ne", "Not Assigned"),)),
    Rule(3, "mapping_billing", "Sure Mapping", (Test("frequency", "eq", "Monthly"),)),
    Rule(3, "mapping_billing", "Other Mapping", (Test("life", "is_null"),)),
)


@plan("rule_classify", """
WITH i AS (SELECT p_partkey, p_brand AS vendor, p_type || '-' || (p_size % 4) || 'YR' AS sku, p_name || ' ' || p_type AS description,
         CASE WHEN p_size % 3 > 0 THEN p_size || 'M' END AS life FROM part),
m AS (SELECT *, coalesce(CAST(nullif(regexp_extract(life, '^(\\d+)', 1), '') AS INT), 0) AS months FROM i),
d AS (SELECT *, CASE WHEN vendor = 'Brand#3' THEN regexp_extract(sku, '(\\d)YR', 1) || ' YR' WHEN vendor = 'Brand#7' THEN 'Perpetual'
  WHEN months > 1 THEN CAST(round(months / 12.0::DOUBLE, 4) AS VARCHAR) || ' YR' WHEN months = 1 THEN '1M' ELSE 'Not Assigned' END AS dur FROM m),
f AS (SELECT *, CASE WHEN dur = '1M' THEN 'Monthly' ELSE 'Upfront' END AS frequency,
  CASE WHEN dur <> '1M' AND life IS NOT NULL THEN 'Capacity' WHEN dur = '1M' THEN 'Flexible' ELSE 'Not Assigned' END AS consumption,
  CASE WHEN description LIKE '%widget%' AND dur LIKE '%YR%' THEN 'SW Subscription'
       WHEN regexp_matches(description, '(?i)bolt|gear') THEN 'Hardware' ELSE 'Not Assigned' END AS type FROM d)
SELECT p_partkey, frequency, consumption, type, upper(description) AS description, months,
  CASE WHEN dur <> 'Not Assigned' THEN 'Sure Mapping' ELSE 'Not Assigned' END AS mapping_duration,
  CASE WHEN life IS NULL THEN 'Other Mapping' WHEN frequency = 'Monthly' THEN 'Sure Mapping' ELSE 'Not Assigned' END AS mapping_billing,
  CASE WHEN dur LIKE '%YR' THEN (CAST(replace(dur, ' YR', '') AS DECIMAL(18,4)) * 12)::DOUBLE ELSE 0.0 END AS mrr_ratio,
  CASE WHEN dur LIKE '%YR' THEN CAST(CAST(CAST(replace(dur, ' YR', '') AS DECIMAL(18,4)) AS DECIMAL(18,2)) AS VARCHAR) || ' YR' ELSE dur END AS duration
FROM f
""")
def rule_classify(t: Tables):
    items = t.part.select(
        "p_partkey", F.col("p_brand").alias("vendor"), F.concat("p_type", F.lit("-"), F.col("p_size") % 4, F.lit("YR")).alias("sku"),
        F.col("p_name").alias("text"), F.col("p_type").alias("text_2"),
        F.when(F.col("p_size") % 3 > 0, F.concat("p_size", F.lit("M"))).alias("life"))
    done = finish_rules(apply_rules(with_defaults(items, ["text", "text_2"], "life"), RULES))
    return done.select("p_partkey", "frequency", "consumption", "type", "description", "months", "mapping_duration",
                       "mapping_billing", "mrr_ratio", "duration")


def _lookup(t: Tables) -> DataFrame:
    """Promo items with the vendor spelt another way; an arr type each."""
    return t.part.where("p_type = 'PROMO'").select(
        F.col("p_name").alias("product_code"), F.replace(F.col("p_brand"), F.lit("#"), F.lit("-")).alias("vendor_code"), "p_size")


def _facts(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.upper("p_name").alias("sku"), F.col("p_brand").alias("vendor"),
                         F.replace(F.col("p_brand"), F.lit("#1"), F.lit("-1")).alias("vendor_master"))


LOOKUP = """facts AS (SELECT p_partkey, lower(p_name) AS sku, lower(p_brand) AS vendor, lower(replace(p_brand, '#1', '-1')) AS vendor_master FROM part),
lookup AS (SELECT lower(p_name) AS code, lower(replace(p_brand, '#', '-')) AS vendor, min(p_size) AS p_size FROM part WHERE p_type = 'PROMO' GROUP BY 1, 2)"""


@plan("match_exact", f"""
WITH {LOOKUP}
SELECT p_partkey, CASE WHEN l.code IS NULL THEN 0 ELSE 1 END AS is_matched,
       CASE WHEN l.code IS NOT NULL THEN 'mt=sku|vendor_master' END AS matched_type, l.p_size
FROM facts f LEFT JOIN lookup l ON l.code = f.sku AND l.vendor = f.vendor_master
""")
def match_exact(t: Tables):
    out = X.match_cascade(_facts(t), _lookup(t), [X.MatchPass("sku", "vendor_master", "product_code", "vendor_code")], ["p_size"])
    return out.select("p_partkey", "is_matched", "matched_type", "p_size")


@plan("match_cascade", f"""
WITH {LOOKUP}, scored AS (
  SELECT DISTINCT f.sku, f.vendor AS a, l.vendor AS b, l.p_size, levenshtein(f.vendor, l.vendor) AS d, greatest(length(f.vendor), length(l.vendor)) AS n
  FROM facts f JOIN lookup l ON l.code = f.sku WHERE (greatest(length(f.vendor), length(l.vendor)) - levenshtein(f.vendor, l.vendor)) * 100
    >= 70 * greatest(length(f.vendor), length(l.vendor))),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY sku, a ORDER BY d::DOUBLE / n, b) = 1)
SELECT p_partkey, CASE WHEN l.code IS NOT NULL THEN 1 WHEN b.a IS NOT NULL THEN 2 ELSE 0 END AS is_matched,
  CASE WHEN l.code IS NOT NULL THEN 'mt=sku|vendor_master' WHEN b.a IS NOT NULL THEN
    'mt=sku|vendor:th=' || CASE WHEN (n - d) * 100 >= 90 * n THEN '0.9' WHEN (n - d) * 100 >= 80 * n THEN '0.8' ELSE '0.7' END
    || ':lv=' || printf('%.2f', 1.0 - d::DOUBLE / n) END AS matched_type,
  coalesce(l.p_size, b.p_size) AS p_size
FROM facts f LEFT JOIN lookup l ON l.code = f.sku AND l.vendor = f.vendor_master
LEFT JOIN best b ON b.sku = f.sku AND b.a = f.vendor
""")
def match_cascade(t: Tables):
    passes = [X.MatchPass("sku", "vendor_master", "product_code", "vendor_code"),
              X.MatchPass("sku", "vendor", "product_code", "vendor_code", (90, 80, 70))]
    return X.match_cascade(_facts(t), _lookup(t), passes, ["p_size"]).select("p_partkey", "is_matched", "matched_type", "p_size")


@plan("similar_customer_names", """
SELECT a.c_nationkey::VARCHAR AS control, a.n AS a, b.n AS b, 1.0::DOUBLE - levenshtein(a.n, b.n) / greatest(length(a.n), length(b.n))::DOUBLE AS similarity
FROM (SELECT DISTINCT c_nationkey, c_mktsegment AS n FROM customer) a
JOIN (SELECT DISTINCT c_nationkey, substr(c_mktsegment, 2) || 'S' AS n FROM customer) b ON a.c_nationkey = b.c_nationkey
WHERE (greatest(length(a.n), length(b.n)) - levenshtein(a.n, b.n)) * 100 >= 60 * greatest(length(a.n), length(b.n))
""")
def _(t: Tables):
    control = F.col("c_nationkey").cast("string").alias("control")
    facts = t.customer.select(control, F.col("c_mktsegment").alias("a"))
    lookup = t.customer.select(control, F.concat(F.expr("substr(c_mktsegment, 2)"), F.lit("S")).alias("b"))
    return X.similar_texts(facts, lookup, 60)


@plan("match_cleaned_text", """
SELECT p_partkey, m.margin FROM part LEFT JOIN (
  SELECT regexp_replace(lower(trim(p_name || '!')), '[^0-9a-z]+', ' ', 'g') AS c, min(p_size) AS margin FROM part WHERE p_type = 'LARGE' GROUP BY 1) m
ON m.c = regexp_replace(lower(trim(upper(p_name) || '  -')), '[^0-9a-z]+', ' ', 'g')
""")
def _(t: Tables):
    margins = t.part.where("p_type = 'LARGE'").select(F.concat("p_name", F.lit("!")).alias("text"), F.col("p_size").alias("margin"))
    facts = t.part.select("p_partkey", F.concat(F.upper("p_name"), F.lit("  -")).alias("text"))
    return X.match_cleaned(facts, margins, "text", ["margin"]).select("p_partkey", "margin")


@plan("match_child_manual", """
WITH result AS (SELECT p_partkey AS sku, p_type, 'mt=auto' AS matched_type FROM part WHERE p_size <= 20),
kids AS (SELECT p_partkey AS sku, r.p_type, 'mt=child' AS matched_type FROM part JOIN result r ON r.sku = p_partkey // 2 WHERE p_size > 20),
both_ AS (SELECT * FROM result UNION ALL SELECT * FROM kids)
SELECT * FROM both_ UNION ALL SELECT p_partkey, 'MANUAL', 'mt=manual' FROM part WHERE p_size > 40 AND p_partkey NOT IN (SELECT sku FROM both_)
""")
def _(t: Tables):
    items = t.part.select(F.col("p_partkey").alias("sku"), F.floor(F.col("p_partkey") / 2).alias("parent_sku"), "p_type", "p_size")
    result = items.where("p_size <= 20").select("sku", "p_type", F.lit("mt=auto").alias("matched_type"))
    both = result.unionByName(X.inherit_from_parent(result, items, "sku", "parent_sku", ["p_type"]))
    manual = items.where("p_size > 40").select("sku", F.lit("MANUAL").alias("p_type"))
    return X.append_manual(both, manual, "sku", ["p_type"])


@plan("vendor_fallback", """
SELECT p_partkey, CASE WHEN p_size > 10 AND p_brand <> 'Brand#2' THEN p_brand ELSE p_type END AS vendor,
       CASE WHEN p_size > 10 AND p_brand <> 'Brand#2' THEN 0 ELSE 1 END AS vendor_is_internal FROM part
""")
def _(t: Tables):
    p = t.part.withColumn("master", F.when(F.col("p_size") > 10, F.when(F.col("p_brand") == "Brand#2", "NaN").otherwise(F.col("p_brand"))))
    return X.vendor_fallback(p, "master", "p_type", "vendor").select("p_partkey", "vendor", "vendor_is_internal")


@plan("item_sales", f"""
WITH {DOCUMENTS}, {QUARTERLY_RATES}, signed AS (
  SELECT l_partkey, CAST(CASE WHEN l_returnflag = 'R' THEN -price ELSE price END / coalesce(r.rate, 1) AS DECIMAL(18,2)) AS amount
  FROM doc_lines d LEFT JOIN quarterly_rates r ON r.nation = d.nation AND r.month = date_trunc('month', o_date)
  WHERE o_date >= DATE '2000-01-01' AND o_date < DATE '2001-01-01')
SELECT l_partkey, p_brand, p_name, sum(amount)::DOUBLE AS amount, count(*) AS n_lines
FROM signed LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3 HAVING sum(amount) <> 0
""")
def item_sales(t: Tables):
    from tierwork.functions.dates import in_period, month_start, period_bounds
    import datetime as dt

    year = period_bounds("2000-03", True, dt.date(2024, 1, 5))
    d = documents(t).where(in_period(F.col("o_date"), year)).withColumn("month", month_start(F.col("o_date")))
    factor = F.coalesce("rate", F.lit(1).cast("decimal(18,4)"))
    signed = d.join(quarterly_rates(t), ["nation", "month"], "left").select("l_partkey", money(F.try_divide(
        F.when(F.col("l_returnflag") == "R", -F.col("price")).otherwise(F.col("price")), factor)).alias("amount"))
    sums = signed.groupBy("l_partkey").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_lines")).where("amount <> 0")
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    return sums.join(items, "l_partkey", "left").withColumn("amount", F.col("amount").cast("double"))


@plan("name_match", """
SELECT c_custkey, c_mktsegment FROM customer WHERE lower(trim(c_mktsegment)) IN (
  SELECT lower(trim(CASE p_type WHEN 'SMALL' THEN ' Furniture ' WHEN 'LARGE' THEN 'BUILDING' ELSE p_type END)) FROM part)
""")
def _(t: Tables):
    shared = t.part.select(F.when(F.col("p_type") == "SMALL", " Furniture ").when(F.col("p_type") == "LARGE", "BUILDING").otherwise(
        F.col("p_type")).alias("c_mktsegment"))
    return M.match_dimensions(t.customer.select("c_custkey", "c_mktsegment"), shared, "c_mktsegment")


@plan("one_label", "SELECT p_brand, max(p_name) AS p_name FROM part GROUP BY 1")
def _(t: Tables):
    return M.one_label(t.part, "p_brand", "p_name")


@plan("longest_label", """
SELECT p_brand, p_name FROM (SELECT DISTINCT p_brand, p_name FROM part)
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY length(p_name) DESC, p_name) = 1
""")
def _(t: Tables):
    return M.longest_label(t.part, "p_brand", "p_name")


@plan("resolve_label", """
WITH m AS (SELECT DISTINCT lower(p_name) AS name, lower(p_type) AS grp, CASE WHEN p_size < 5 THEN 'NaN' WHEN p_size < 25 THEN CAST(p_size AS VARCHAR) ELSE 'X' || p_size END AS code FROM part),
many AS (SELECT name FROM m GROUP BY 1 HAVING count(DISTINCT grp) > 1)
SELECT name, max(grp) AS grp FROM m WHERE name NOT IN (SELECT name FROM many) OR code = 'NaN' OR NOT regexp_matches(code, '[^0-9]') GROUP BY 1
""")
def _(t: Tables):
    code = F.when(F.col("p_size") < 5, "NaN").when(F.col("p_size") < 25, F.col("p_size").cast("string")).otherwise(F.concat(F.lit("X"), F.col("p_size")))
    return M.resolve_label(t.part.select(F.col("p_name").alias("name"), F.col("p_type").alias("grp"), code.alias("code")), "name", "grp", "code")


@plan("vendor_list", """
WITH b AS (SELECT p_brand AS code, p_type AS label FROM part UNION SELECT 'S' || s_nationkey, s_name FROM supplier)
SELECT code, CASE code WHEN 'Brand#5' THEN 'Override' ELSE label END AS label FROM b
QUALIFY row_number() OVER (PARTITION BY code ORDER BY length(CASE code WHEN 'Brand#5' THEN 'Override' ELSE label END) DESC, label) = 1
""")
def _(t: Tables):
    ledger = t.part.select(F.col("p_brand").alias("code"), F.col("p_type").alias("label"))
    others = t.supplier.select(F.concat(F.lit("S"), F.col("s_nationkey")).alias("code"), F.col("s_name").alias("label"))
    return M.vendor_list(ledger, others, "code", "label", {"Brand#5": "Override"})


@plan("latest_version", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY rank() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC) = 1
""")
def _(t: Tables):
    return M.latest_version(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), ["l_orderkey"],
                            "l_shipdate", "l_linenumber").drop("l_shipdate")


@plan("latest_version_independent", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_orderkey) AND l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey)
""")
def _(t: Tables):
    return M.latest_version(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), ["l_orderkey"],
                            "l_shipdate", "l_linenumber", independent=True).drop("l_shipdate")


@plan("latest_attribute", """
SELECT user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-20'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1
""")
def _(t: Tables):
    from tierwork.sources.readers import land_day

    return keep_first(land_day(t.events, "ts", "2024-01-20"), ["user_id"], [F.col("ts").desc(), "event_id"]).select("user_id", "event_type")


# the passes of the cascade in their order: facts' control and match, the lookup's, thresholds, whether missing texts take part
ELEVEN = [
    ("sku", "vendor", "code", "vendor_code", (90, 80), False),
    ("sku", "vendor", "code", "vendor_code", (100,), False),
    ("sku", "vendor_master", "code", "vendor_code", (100,), False),
    ("sku", "vendor_master", "code", "vendor_code", (80, 70, 60), False),
    ("vendor_master", "sku_master", "vendor_code", "code", (100,), False),
    ("sku_master", "vendor_master", "code", "vendor_code", (80, 70, 60), False),
    ("sku_master", "vendor_master", "code", "vendor_code", (50, 40, 30), False),
    ("sku", "vendor", "code", "vendor_code", (80, 70, 60), False),
    ("vendor_master", "sku", "vendor_code", "code", (90, 80), False),
    ("sku_master", "vendor", "code", "vendor_code", (80, 70, 60), False),
    ("vendor_master", "sku_master", "vendor_code", "code", (100,), True),
]
SPELLINGS = """facts AS (
  SELECT c_custkey, lower(CASE WHEN c_custkey % 6 = 0 THEN 'NaN' ELSE c_name END) AS sku,
         lower(CASE WHEN c_custkey % 2 = 0 THEN c_name WHEN c_custkey % 5 = 1 THEN 'NaN' ELSE replace(c_name, '#0', '-') END) AS sku_master,
         lower(n_name || ' ' || c_mktsegment) AS vendor,
         lower(CASE WHEN c_custkey % 4 = 0 THEN 'NaN' WHEN c_custkey % 4 = 1 THEN n_name || ', ' || c_mktsegment || ' ltd' ELSE n_name || ' ' || c_mktsegment END) AS vendor_master
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
lookup AS (
  SELECT lower(CASE WHEN c_custkey % 5 = 0 THEN replace(c_name, 'mer#', 'mer ') ELSE c_name END) AS code,
         lower(CASE WHEN c_custkey % 3 = 0 THEN replace(n_name, 'A', '4') || ' ' || c_mktsegment WHEN c_custkey % 3 = 1 THEN n_name || ' ' || c_mktsegment || ' gmbh'
                    WHEN c_custkey % 11 = 5 THEN 'NaN' ELSE n_name || ' ' || c_mktsegment END) AS vendor_code, CAST(c_acctbal AS DECIMAL(18,2)) AS credit
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'nan', lower(n_name), 0 FROM nation UNION ALL SELECT 'nan', 'nan', 1)"""


def _cascade_sql(passes) -> str:
    """Each pass by comparing all texts of a control."""
    ctes, hits = [], []
    for n, (control, match, c, m, thresholds, missing) in enumerate(passes):
        low, label = min(thresholds), f"mt={control}|{match}"
        known = "TRUE" if missing else f"f.{control} <> 'nan' AND f.{match} <> 'nan'"
        near = f"f.{match} = l.{m}" if low == 100 else (
            f"(greatest(length(f.{match}), length(l.{m})) - levenshtein(f.{match}, l.{m})) * 100 >= {low} * greatest(length(f.{match}), length(l.{m}))")
        step = " ".join(f"WHEN (n - d) * 100 >= {t} * n THEN '{t / 100:.1f}'" for t in thresholds)
        said = f"'{label}'" if low == 100 else f"'{label}:th=' || CASE {step} END || ':lv=' || printf('%.2f', 1.0 - d::DOUBLE / n)"
        ctes.append(f"""p{n} AS (SELECT c, a, {1 if low == 100 else 2} AS code, {said} AS said, credit FROM (
  SELECT f.{control} AS c, f.{match} AS a, l.{m} AS b, min(l.credit) AS credit, levenshtein(f.{match}, l.{m}) AS d, greatest(length(f.{match}), length(l.{m})) AS n
  FROM (SELECT DISTINCT {control}, {match} FROM facts) f JOIN lookup l ON f.{control} = l.{c} WHERE {known} AND {near} GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY c, a ORDER BY d::DOUBLE / n, b) = 1)""")
        hits.append(f"LEFT JOIN p{n} ON p{n}.c = f.{control} AND p{n}.a = f.{match}")
    pick = lambda x: f"coalesce({', '.join(f'p{n}.{x}' for n in range(len(passes)))})"
    return f"""WITH {SPELLINGS}, {', '.join(ctes)}
SELECT c_custkey, coalesce({pick('code')}, 0) AS is_matched, {pick('said')} AS matched_type, CAST({pick('credit')} AS DOUBLE) AS credit
FROM facts f {' '.join(hits)}"""


def _spellings(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers under two codes and two vendor names, and a lookup that spells some of them another way."""
    named = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    k, name, vendor = F.col("c_custkey"), F.col("c_name"), F.concat_ws(" ", "n_name", "c_mktsegment")
    facts = named.select(
        k, F.when(k % 6 == 0, "NaN").otherwise(name).alias("sku"),
        F.when(k % 2 == 0, name).when(k % 5 == 1, "NaN").otherwise(F.replace(name, F.lit("#0"), F.lit("-"))).alias("sku_master"), vendor.alias("vendor"),
        F.when(k % 4 == 0, "NaN").when(k % 4 == 1, F.concat("n_name", F.lit(", "), "c_mktsegment", F.lit(" ltd"))).otherwise(vendor).alias("vendor_master"))
    spelt = F.when(k % 3 == 0, F.concat_ws(" ", F.replace("n_name", F.lit("A"), F.lit("4")), "c_mktsegment")).when(
        k % 3 == 1, F.concat_ws(" ", vendor, F.lit("gmbh"))).when(k % 11 == 5, "NaN").otherwise(vendor)
    money = F.col("c_acctbal").cast("decimal(18,2)").alias("credit")
    lookup = named.select(F.when(k % 5 == 0, F.replace(name, F.lit("mer#"), F.lit("mer "))).otherwise(name).alias("code"), spelt.alias("vendor_code"), money)
    missing = t.nation.select(F.lit("NaN").alias("code"), F.col("n_name").alias("vendor_code"), F.lit(0).cast("decimal(18,2)").alias("credit"))
    unknown = t.spark.range(1).select(F.lit("NaN").alias("code"), F.lit("NaN").alias("vendor_code"), F.lit(1).cast("decimal(18,2)").alias("credit"))
    return facts, lookup.unionByName(missing).unionByName(unknown)


@plan("match_eleven_passes", _cascade_sql(ELEVEN))
def _(t: Tables):
    facts, lookup = _spellings(t)
    out = X.match_cascade(facts, lookup, [X.MatchPass(*p) for p in ELEVEN], ["credit"])
    return out.select("c_custkey", "is_matched", "matched_type", F.col("credit").cast("double").alias("credit"))


@plan("closest_first_sentences", r"""
WITH s AS (SELECT DISTINCT lang AS control, regexp_replace(lower(regexp_extract(text, '^[^.\n]*')), '[^ -~]', '', 'g') AS a FROM documents
  WHERE lang IS NOT NULL AND text IS NOT NULL AND length(regexp_replace(lower(regexp_extract(text, '^[^.\n]*')), '[^ -~]', '', 'g')) BETWEEN 10 AND 60),
l AS (SELECT DISTINCT control, replace(substr(a, 1, length(a) // 2) || substr(a, length(a) // 2 + 2), 'th', 'ht') AS b FROM s)
SELECT s.control, a, b, 1.0::DOUBLE - levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE AS similarity
FROM s JOIN l ON s.control = l.control AND a <> '' AND b <> ''
WHERE (greatest(length(a), length(b)) - levenshtein(a, b)) * 100 >= 70 * greatest(length(a), length(b))
QUALIFY row_number() OVER (PARTITION BY s.control, a ORDER BY levenshtein(a, b) / greatest(length(a), length(b))::DOUBLE, b) = 1
""")
def _(t: Tables):
    """First sentences of the length of names, against a lookup that spells all of them another way: each finds the nearest, at 70 percent or more."""
    a, half = F.col("a"), F.floor(F.length("a") / 2).cast("int")
    first = F.substring_index(F.substring_index("text", ".", 1), "\n", 1)  # of whole texts, so without a pattern
    said = cut_lineage(t.documents.where("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").alias("control"), F.regexp_replace(F.lower(first), "[^ -~]", "").alias("a"), F.lit(70).alias("pct")).where(F.length("a").between(10, 60)).distinct())
    spelt = F.replace(F.concat(F.substr(a, F.lit(1), half), F.substr(a, half + 2)), F.lit("th"), F.lit("ht"))
    return X.closest_texts(said, said.select("control", spelt.alias("b"), "pct"))


@plan("hierarchy_described", """
SELECT 'C' || c_custkey AS node, 'R' || n_regionkey AS level_1, 'N' || c_nationkey AS level_2, 'C' || c_custkey AS level_3, 'C' || c_custkey AS level_4,
       r_name AS level_1_text, n_name AS level_2_text, c_name AS level_3_text, c_name AS level_4_text
FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT 'N' || n_nationkey, 'R' || n_regionkey, 'N' || n_nationkey, 'N' || n_nationkey, 'N' || n_nationkey, r_name, n_name, n_name, n_name
FROM nation JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT 'R' || r_regionkey, 'R' || r_regionkey, 'R' || r_regionkey, 'R' || r_regionkey, 'R' || r_regionkey, r_name, r_name, r_name, r_name FROM region
""")
def _(t: Tables):
    """Region, nation, customer as codes with their descriptions on every level."""
    code = lambda mark, c: F.concat(F.lit(mark), F.col(c))
    edges = t.nation.select(code("N", "n_nationkey").alias("node"), code("R", "n_regionkey").alias("parent")).unionByName(
        t.customer.select(code("C", "c_custkey").alias("node"), code("N", "c_nationkey").alias("parent"))).unionByName(
        t.region.select(code("R", "r_regionkey").alias("node"), F.lit(None).cast("string").alias("parent")))
    texts = t.region.select(code("R", "r_regionkey").alias("code"), F.col("r_name").alias("text")).unionByName(
        t.nation.select(code("N", "n_nationkey"), "n_name").toDF("code", "text")).unionByName(
        t.customer.select(code("C", "c_custkey"), "c_name").toDF("code", "text"))
    return described_levels(edges, "node", "parent", texts, "code", "text", 4)


@plan("hierarchy_two_parents", """
WITH RECURSIVE edges AS (
  SELECT DISTINCT 'P' || p_partkey AS node, 'P' || p_partkey // 2 AS parent FROM part WHERE p_partkey > 0
  UNION SELECT 'P' || p_partkey, 'P' || p_partkey // 3 FROM part WHERE p_partkey > 0
  UNION SELECT 'P' || p_partkey, p_brand FROM part),
up AS (SELECT node, parent AS ancestor, 1 AS depth FROM edges UNION SELECT up.node, e.parent, depth + 1 FROM up JOIN edges e ON e.node = up.ancestor)
SELECT node, ancestor, min(depth) AS depth FROM up GROUP BY ALL
""")
def _(t: Tables):
    """Parts below two parents each, and below their brand: all ancestors with the least number of steps."""
    code = lambda by: F.concat(F.lit("P"), F.floor(F.col("p_partkey") / by))
    below = t.part.where("p_partkey > 0")
    edges = below.select(code(1).alias("node"), code(2).alias("parent")).union(below.select(code(1), code(3))).union(t.part.select(code(1), "p_brand"))
    return closure(edges, "node", "parent")
