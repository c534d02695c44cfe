"""Finance plans: documents, rates, conversion, periods, allocation, account views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwork.functions.dates import (
    fiscal_period, fiscal_to_calendar, fiscal_year, ledger_cut_off, month_start,
)
from tierwork.functions.values import exclude_patterns, flag, map_value, money
from tierwork.operators import finance as N
from tierwork.operators.ordered import with_group_stats
from tierwork.plans.inputs import (
    DATED_ORDERS, DOCUMENTS, FILLED_RATES, NATION_ORDERS, QUARTERLY_RATES, dated_orders, documents, nation_orders,
    order_lines, stored_rates, with_order,
)
from tierwork.plans.registry import Tables, plan
from tierwork.sources.storage import cut_lineage


def unified(t: Tables) -> DataFrame:
    """Invoice and credit lines in one shape, then one join to their orders."""
    return with_order(N.signed_documents(order_lines(t), F.col("l_returnflag") == "R", ["price", "quantity"]), t)


UNIFIED = DOCUMENTS + """, unified AS (
  SELECT * REPLACE (CASE WHEN l_returnflag = 'R' THEN -price ELSE price END AS price,
                    CASE WHEN l_returnflag = 'R' THEN -quantity ELSE quantity END AS quantity),
         CASE WHEN l_returnflag = 'R' THEN 'credit' ELSE 'invoice' END AS document_type FROM doc_lines)"""


@plan("unify_documents", f"""
WITH {UNIFIED}
SELECT document_type, nation, count(*) AS n, sum(price)::DOUBLE AS price, sum(quantity)::BIGINT AS quantity FROM unified GROUP BY 1, 2
""")
def unify_documents(t: Tables):
    return unified(t).groupBy("document_type", "nation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("price"), F.sum("quantity").alias("quantity"))


FLAGSHIP = f"""
WITH {UNIFIED}, {FILLED_RATES}, edge AS (SELECT nation, max_by(rate, month) AS rate FROM filled_rates WHERE rate IS NOT NULL GROUP BY 1),
conv AS (SELECT u.nation, u.o_date, u.o_custkey, u.document_type,
    CAST(u.price::DOUBLE / coalesce(f.rate, e.rate)::DOUBLE AS DECIMAL(18,2)) AS eur
  FROM unified u LEFT JOIN filled_rates f ON f.nation = u.nation AND f.month = date_trunc('month', u.o_date)
  LEFT JOIN edge e ON e.nation = u.nation),
firsts AS (SELECT o_custkey, min(o_date) AS first_date FROM nation_orders GROUP BY 1)
SELECT n_name, CAST(date_trunc('month', o_date) AS DATE) AS month, sum(eur)::DOUBLE AS revenue_eur, count(*) AS n_lines,
       count(*) FILTER (WHERE document_type = 'credit') AS n_credit_lines, count(*) FILTER (WHERE o_date = first_date) AS n_first_lines
FROM conv JOIN firsts USING (o_custkey) JOIN nation ON n_nationkey = nation GROUP BY 1, 2
"""


@plan("flagship_monthly_revenue_eur", FLAGSHIP)
def flagship(t: Tables):
    """Documents -> reporting currency through gap-filled rates -> monthly totals per nation, with first-order lines."""
    eur = N.convert(unified(t), stored_rates(t), "nation", "o_date", "month", "rate", ["price"])
    firsts = t.orders.groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("first_date"))
    names = t.nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    # amounts are summed per customer and day before anything else is joined to them
    sums = eur.groupBy("nation", "o_custkey", "o_date").agg(
        F.sum("price_eur").alias("eur"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("document_type") == "credit").alias("n_credit"))
    return sums.join(firsts, "o_custkey").join(names, "nation").groupBy(
        "n_name", month_start(F.col("o_date")).alias("month")
    ).agg(
        F.sum("eur").cast("double").alias("revenue_eur"), F.sum("n").alias("n_lines"), F.sum("n_credit").alias("n_credit_lines"),
        F.sum(F.when(F.col("o_date") == F.col("first_date"), F.col("n")).otherwise(0)).alias("n_first_lines"),
    )


@plan("fx_rates_by_entity", f"""
WITH {NATION_ORDERS}, src AS (
  SELECT strftime(o_date + INTERVAL 9 MONTH, '%Y') || CASE WHEN o_orderstatus = 'P' THEN 'BUD-01' WHEN o_orderstatus = 'O' THEN 'ACT-AUD' ELSE 'ACT-04' END AS scenario,
         month(o_date - INTERVAL 3 MONTH) AS period, 'C' || (nation % 7) AS currency, (10001 + 2 * count(*))::DOUBLE AS rate
  FROM nation_orders GROUP BY 1, 2, 3)
SELECT e.entity, s.currency, s.rate,
       CAST(make_date(CASE WHEN period < 10 THEN CAST(scenario[1:4] AS INT) - 1 ELSE CAST(scenario[1:4] AS INT) END,
            CASE WHEN period < 10 THEN period + 3 ELSE period - 9 END, 1) AS DATE) AS month, 'Actual' AS scenario_group
FROM src s LEFT JOIN (SELECT n_name AS entity, 'C' || (n_nationkey % 7) AS currency FROM nation) e ON e.currency = s.currency
WHERE scenario LIKE '%ACT%' AND scenario NOT LIKE '%AUD%'
""")
def _(t: Tables):
    kind = F.when(F.col("o_orderstatus") == "P", "BUD-01").when(F.col("o_orderstatus") == "O", "ACT-AUD").otherwise("ACT-04")
    src = nation_orders(t).groupBy(
        F.concat(fiscal_year(F.col("o_date")), kind).alias("scenario"), F.lpad(fiscal_period(F.col("o_date")), 2, "0").alias("period"),
        F.concat(F.lit("C"), F.col("nation") % 7).alias("currency"),
    ).agg((F.lit(10001) + 2 * F.count(F.lit(1))).cast("double").alias("rate"))
    entities = t.nation.select(F.col("n_name").alias("entity"), F.concat(F.lit("C"), F.col("n_nationkey") % 7).alias("currency"))
    return N.fx_rates(src, entities, "scenario", "period", "currency", "rate").select(
        "entity", "currency", "rate", "month", "scenario_group")


@plan("fx_gap_fill", f"WITH {NATION_ORDERS}, {FILLED_RATES} SELECT nation, month, rate::DOUBLE AS rate FROM filled_rates")
def fx_gap_fill(t: Tables):
    return stored_rates(t).withColumn("rate", F.col("rate").cast("double"))


for which, pick in {"latest": "max_by", "earliest": "min_by"}.items():
    @plan(f"convert_{which}_fallback", f"""
WITH {NATION_ORDERS}, {QUARTERLY_RATES}, edge AS (SELECT nation, {pick}(rate, month) AS rate FROM quarterly_rates GROUP BY 1)
SELECT o_orderkey, (CASE WHEN o.nation = 0 THEN 1 ELSE coalesce(r.rate, e.rate) END)::DOUBLE AS fx_rate,
       CAST(amount::DOUBLE / (CASE WHEN o.nation = 0 THEN 1 ELSE coalesce(r.rate, e.rate) END)::DOUBLE AS DECIMAL(18,2))::DOUBLE AS amount_eur
FROM nation_orders o LEFT JOIN quarterly_rates r ON r.nation = o.nation AND r.month = date_trunc('month', o_date)
LEFT JOIN edge e ON e.nation = o.nation
""")
    def _(t: Tables, which=which):
        out = N.convert(nation_orders(t), stored_rates(t, filled=False), "nation", "o_date", "month", "rate", ["amount"], which,
                        reporting=F.col("nation") == 0)
        return out.select("o_orderkey", F.col("fx_rate").cast("double").alias("fx_rate"), F.col("amount_eur").cast("double").alias("amount_eur"))


@plan("day_rate", f"""
WITH {NATION_ORDERS}, rates AS (
  SELECT o_date AS d, 'C' || (nation % 5) AS f, 'C' || ((nation + 1) % 5) AS t, (10001 + 2 * count(*)) / 10000.0::DOUBLE AS r
  FROM nation_orders WHERE o_orderstatus = 'F' GROUP BY 1, 2, 3), facts AS (
  SELECT o_orderkey, o_date, 'C' || (nation % 5) AS src, CASE o_orderstatus WHEN 'F' THEN 'C1' WHEN 'O' THEN 'C2' ELSE 'C3' END AS dst FROM nation_orders)
SELECT o_orderkey, CASE WHEN src = dst THEN 1.0 ELSE coalesce(a.r, 1.0::DOUBLE / b.r) END AS day_rate
FROM facts LEFT JOIN rates a ON a.d = o_date AND a.f = src AND a.t = dst LEFT JOIN rates b ON b.d = o_date AND b.f = dst AND b.t = src
""")
def _(t: Tables):
    o = nation_orders(t)
    cur = F.concat(F.lit("C"), F.col("nation") % 5)
    rates = o.where("o_orderstatus = 'F'").groupBy(
        F.col("o_date").alias("rate_date"), cur.alias("from_currency"), F.concat(F.lit("C"), (F.col("nation") + 1) % 5).alias("to_currency")
    ).agg(((F.lit(10001) + 2 * F.count(F.lit(1))) / 10000.0).alias("rate"))
    facts = o.select("o_orderkey", "o_date", cur.alias("src"), F.when(F.col("o_orderstatus") == "F", "C1").when(
        F.col("o_orderstatus") == "O", "C2").otherwise("C3").alias("dst"))
    return N.day_rate(facts, rates, "o_date", "src", "dst").select("o_orderkey", "day_rate")


@plan("first_seen_dates", f"""
WITH {DOCUMENTS}
SELECT o_orderkey, l_linenumber, l_partkey, min(o_date) OVER (PARTITION BY l_suppkey) AS vendor_start,
       min(o_date) OVER (PARTITION BY o_custkey) AS reseller_start,
       min(o_date) OVER (PARTITION BY CASE WHEN nation < 5 THEN 'own' || o_custkey ELSE 'g' || nation END) AS group_start
FROM doc_lines
""")
def _(t: Tables):
    group = N.own_or_group(F.when(F.col("nation") >= 5, F.col("nation").cast("string")), F.col("o_custkey").cast("string"))
    d = documents(t).select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "o_date", group.alias("grp"))
    starts = {"vendor_start": "l_suppkey", "reseller_start": "o_custkey", "group_start": "grp"}
    return N.first_seen(d, "o_date", starts).select("o_orderkey", "l_linenumber", "l_partkey", *starts)


DEFERRED = f"""
WITH {DOCUMENTS}, x AS (SELECT nation, price, CAST(date_trunc('month', o_date) AS DATE) AS s, quantity * 3 AS m FROM doc_lines),
y AS (SELECT *, m - 1 > 2 AND m - 1 < 120 AS is_deferred, CASE WHEN m - 1 > 2 AND m - 1 < 120 THEN m ELSE 1 END AS n FROM x)
SELECT nation, is_deferred, CAST(s + to_months(i) AS DATE) AS month, count(*) AS n_rows,
       sum((2 * CAST(price * 100 AS BIGINT) + n) // (2 * n))::BIGINT / 100.0::DOUBLE AS price
FROM (SELECT *, unnest(range(n)) AS i FROM y) GROUP BY 1, 2, 3
"""


def _contracts(t: Tables) -> DataFrame:
    start = month_start(F.col("o_date"))
    return documents(t).select("o_orderkey", "nation", "price", start.alias("month"), F.add_months(start, F.col("quantity") * 3).alias("end_date"))


@plan("deferred_spread", DEFERRED)
def deferred_spread(t: Tables):
    return N.spread_deferred(_contracts(t), "month", "end_date", "price").groupBy("nation", "is_deferred", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("price").cast("double").alias("price"))


@plan("deferred_monthly_totals", DEFERRED)
def deferred_monthly_totals(t: Tables):
    out = N.deferred_totals(_contracts(t), ["nation"], "month", "end_date", "price")
    return out.withColumn("price", F.col("price").cast("double"))


def ytd_balances(t: Tables) -> DataFrame:
    """Running total per nation, account and fiscal year; the months an account has no posting in are missing."""
    from tierwork.operators.ordered import running, running_sum

    o = nation_orders(t).where("o_orderstatus <> 'P' or o_date < date '1999-09-01'")
    monthly = o.groupBy("nation", F.col("o_orderstatus").alias("account"), fiscal_year(F.col("o_date")).alias("fy"),
                        fiscal_period(F.col("o_date")).alias("period")).agg(F.sum("amount").alias("movement"))
    keys = ["nation", "account", "fy"]
    return running(monthly, keys, ["period"], F.lit(0), {"amount": running_sum(F.col("movement"))}).drop("movement")


YTD = NATION_ORDERS + """, monthly AS (
  SELECT nation, o_orderstatus AS account, CAST(year(o_date + INTERVAL 9 MONTH) AS INT) AS fy, CAST(month(o_date - INTERVAL 3 MONTH) AS INT) AS period,
         sum(amount) AS movement FROM nation_orders WHERE o_orderstatus <> 'P' OR o_date < DATE '1999-09-01' GROUP BY ALL),
ytd AS (SELECT nation, account, fy, period, sum(movement) OVER (PARTITION BY nation, account, fy ORDER BY period) AS amount FROM monthly)"""


@plan("ytd_to_monthly", f"""
WITH {YTD}, closed AS (SELECT * FROM ytd UNION ALL
  SELECT nation, account, fy, max(period) + 1, 0 FROM ytd GROUP BY 1, 2, 3 HAVING max(period) < 12)
SELECT nation, account, fy, period, amount::DOUBLE AS ytd_amount,
       (amount - coalesce(lag(amount) OVER (PARTITION BY nation, account, fy ORDER BY period), 0))::DOUBLE AS amount FROM closed
""")
def ytd_to_monthly(t: Tables):
    out = N.ytd_to_monthly(ytd_balances(t), ["nation", "account", "fy"], "period", "amount")
    return out.withColumns({c: F.col(c).cast("double") for c in ("ytd_amount", "amount")})


@plan("ytd_on_calendar_months", f"""
WITH {YTD}
SELECT nation, account, CAST(make_date(CASE WHEN period < 10 THEN fy - 1 ELSE fy END, CASE WHEN period < 10 THEN period + 3 ELSE period - 9 END, 1) AS DATE) AS month,
       (amount - coalesce(lag(amount) OVER (PARTITION BY nation, account, fy ORDER BY period), 0))::DOUBLE AS amount FROM ytd
""")
def _(t: Tables):
    out = N.ytd_to_monthly(ytd_balances(t), ["nation", "account", "fy"], "period", "amount", close=False)
    return out.select("nation", "account", fiscal_to_calendar(F.col("fy"), F.col("period")).alias("month"),
                      F.col("amount").cast("double").alias("amount"))


def ledger(t: Tables) -> DataFrame:
    """Order totals as booked cost, for final orders only, half of it posted on the order day and half 14 days later."""
    o = dated_orders(t).where("o_orderstatus = 'F'").withColumn("part", F.explode(F.array(F.lit(0), F.lit(14))))
    return o.select("o_orderkey", F.date_add("o_date", F.col("part")).alias("posting_date"),
                    F.when(F.col("o_orderpriority") == "5-LOW", F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount")).alias("cost"))


LEDGER = """ledger AS (SELECT o_orderkey, CAST(o_date + part AS DATE) AS posting_date,
    CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE amount END AS cost
  FROM (SELECT *, unnest([0, 14]) AS part FROM dated_orders WHERE o_orderstatus = 'F')), lines AS (
  SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS cost FROM lineitem),
booked AS (SELECT o_orderkey, sum(cost) AS c FROM ledger GROUP BY 1), known AS (SELECT o_orderkey, sum(cost) AS c, count(*) AS n FROM lines GROUP BY 1),
gap AS (SELECT o_orderkey, coalesce(b.c, 0) - k.c AS gap FROM known k LEFT JOIN booked b USING (o_orderkey))"""


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey",
                             money(F.col("l_extendedprice")).alias("cost"))


@plan("cost_gap", f"""
WITH {DATED_ORDERS}, {LEDGER}
SELECT 'matched' AS kind, o_orderkey, gap::DOUBLE AS gap FROM gap
UNION ALL SELECT 'missed', o_orderkey, c::DOUBLE FROM booked WHERE o_orderkey NOT IN (SELECT o_orderkey FROM known)
""")
def _(t: Tables):
    gap, missed = N.cost_gap(ledger(t), _lines(t), ["o_orderkey"], "cost")
    return gap.select(F.lit("matched").alias("kind"), "o_orderkey", F.col("gap").cast("double").alias("gap")).unionByName(
        missed.select(F.lit("missed").alias("kind"), "o_orderkey", F.col("gap").cast("double").alias("gap")))


@plan("gap_by_posting_date", f"""
WITH {DATED_ORDERS}, {LEDGER}, dated AS (SELECT o_orderkey, posting_date, sum(cost) AS c FROM ledger GROUP BY 1, 2),
tot AS (SELECT o_orderkey, sum(c) AS total, count(*) AS n FROM dated GROUP BY 1)
SELECT o_orderkey, posting_date, gap::DOUBLE * coalesce(c::DOUBLE / nullif(total::DOUBLE, 0), 1.0::DOUBLE / n, 1.0) AS gap
FROM gap LEFT JOIN tot USING (o_orderkey) LEFT JOIN dated USING (o_orderkey)
""")
def _(t: Tables):
    gap, _missed = N.cost_gap(ledger(t), _lines(t), ["o_orderkey"], "cost")
    return N.split_by_date(gap, ledger(t), ["o_orderkey"], "posting_date", "cost")


@plan("allocate_prorata", f"""
WITH {DATED_ORDERS}, {LEDGER}
SELECT l.o_orderkey, l_linenumber, l_partkey, gap::DOUBLE * coalesce(cost::DOUBLE / nullif(k.c::DOUBLE, 0), 1.0::DOUBLE / k.n) AS allocated
FROM lines l JOIN gap g USING (o_orderkey) JOIN known k USING (o_orderkey) WHERE gap <> 0
""")
def allocate_prorata(t: Tables):
    lines = _lines(t)
    gap, _missed = N.cost_gap(ledger(t), lines, ["o_orderkey"], "cost")
    return N.allocate(gap, lines, ["o_orderkey"], "cost").select("o_orderkey", "l_linenumber", "l_partkey", "allocated")


@plan("allocation_end_to_end", f"""
WITH {DATED_ORDERS}, {LEDGER}, dated AS (SELECT o_orderkey, posting_date, sum(cost) AS c FROM ledger GROUP BY 1, 2),
tot AS (SELECT o_orderkey, sum(c) AS total, count(*) AS n FROM dated GROUP BY 1),
gd AS (SELECT o_orderkey, posting_date, gap::DOUBLE * coalesce(c::DOUBLE / nullif(total::DOUBLE, 0), 1.0::DOUBLE / n, 1.0) AS gap
  FROM gap LEFT JOIN tot USING (o_orderkey) LEFT JOIN dated USING (o_orderkey)),
al AS (SELECT g.o_orderkey, posting_date, gap, CAST(floor(gap * coalesce(cost::DOUBLE / nullif(k.c::DOUBLE, 0), 1.0::DOUBLE / k.n) * 100 + 0.5) AS BIGINT) AS a
  FROM gd g JOIN lines l ON l.o_orderkey = g.o_orderkey JOIN known k ON k.o_orderkey = g.o_orderkey WHERE gap <> 0),
three AS (SELECT 'line' AS kind, o_orderkey, posting_date, a FROM al
  UNION ALL SELECT 'remainder', o_orderkey, posting_date, CAST(floor(max(gap) * 100 + 0.5) AS BIGINT) - sum(a) AS a FROM al GROUP BY 2, 3 HAVING CAST(floor(max(gap) * 100 + 0.5) AS BIGINT) <> sum(a)
  UNION ALL SELECT 'missed', o_orderkey, posting_date, CAST(sum(cost) * 100 AS BIGINT) FROM ledger WHERE o_orderkey NOT IN (SELECT o_orderkey FROM known) GROUP BY 2, 3)
SELECT kind, CAST(date_trunc('month', posting_date) AS DATE) AS month, count(*) AS n, sum(a)::BIGINT / 100.0::DOUBLE AS amount FROM three GROUP BY 1, 2
""")
def allocation_end_to_end(t: Tables):
    """Gap per document -> posting dates -> lines and remainder; with documents without lines, by month."""
    lines, booked = _lines(t), ledger(t)
    gap, missed = N.cost_gap(booked, lines, ["o_orderkey"], "cost")
    dated = N.split_by_date(gap, booked, ["o_orderkey"], "posting_date", "cost")
    shared = N.allocate_dated(dated, lines, ["o_orderkey"], "posting_date", "cost", "l_linenumber")
    kind = F.when(F.col("l_linenumber").isNull(), F.lit("remainder")).otherwise(F.lit("line"))
    lost = booked.join(missed.select("o_orderkey"), "o_orderkey", "left_semi").groupBy("o_orderkey", "posting_date").agg(F.sum("cost").alias("allocated"))
    three = shared.select(kind.alias("kind"), "posting_date", "allocated").unionByName(
        lost.select(F.lit("missed").alias("kind"), "posting_date", money(F.col("allocated")).alias("allocated")))
    return three.groupBy("kind", month_start(F.col("posting_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("allocated").cast("double").alias("amount"))


@plan("convert_currency_second_chance", f"""
WITH {NATION_ORDERS}, {QUARTERLY_RATES}, own AS (SELECT * FROM quarterly_rates WHERE nation < 12),
cur AS (SELECT nation % 4 AS currency, month, max(rate) AS rate FROM quarterly_rates WHERE nation >= 6 GROUP BY 1, 2),
edge AS (SELECT currency, max_by(rate, month) AS rate FROM cur GROUP BY 1)
SELECT o_orderkey, coalesce(r.rate, c.rate, e.rate)::DOUBLE AS fx_rate,
       CAST(amount::DOUBLE / coalesce(r.rate, c.rate, e.rate)::DOUBLE AS DECIMAL(18,2))::DOUBLE AS amount_eur
FROM nation_orders o LEFT JOIN own r ON r.nation = o.nation AND r.month = date_trunc('month', o_date)
LEFT JOIN cur c ON c.currency = o.nation % 4 AND c.month = date_trunc('month', o_date) LEFT JOIN edge e ON e.currency = o.nation % 4
""")
def convert_currency_second_chance(t: Tables):
    """Half of the entities have no rates of their own: their currency's rate of the month, then its last one."""
    rates = stored_rates(t, filled=False)
    shared = rates.where("nation >= 6").groupBy((F.col("nation") % 4).alias("currency"), "month").agg(F.max("rate").alias("rate"))
    fact = nation_orders(t).withColumn("currency", F.col("nation") % 4)
    out = N.convert_by_currency(fact, rates.where("nation < 12"), shared, "nation", "currency", "o_date", "month", "rate", ["amount"])
    return out.select("o_orderkey", F.col("fx_rate").cast("double").alias("fx_rate"), F.col("amount_eur").cast("double").alias("amount_eur"))


@plan("gp_trueup", f"""
WITH {DOCUMENTS}, m AS (SELECT *, CASE WHEN l_returnflag = 'N' THEN 0 ELSE price - quantity END AS margin, CAST(date_trunc('month', o_date) AS DATE) AS month FROM doc_lines),
s AS (SELECT nation, month, l_returnflag, sum(margin) AS ms, sum(price) AS rs FROM m GROUP BY 1, 2, 3),
b AS (SELECT nation, CAST(date_trunc('month', o_date) AS DATE) AS month, sum(amount) AS booked FROM nation_orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN (CASE WHEN ms = 0 THEN rs ELSE ms END) = price THEN price ELSE margin END::DOUBLE
   / nullif((CASE WHEN ms = 0 THEN rs ELSE ms END)::DOUBLE, 0) * coalesce(booked, 0)::DOUBLE AS DECIMAL(18,2))::DOUBLE AS margin_trueup
FROM m JOIN s USING (nation, month, l_returnflag) LEFT JOIN b USING (nation, month)
""")
def gp_trueup(t: Tables):
    margin = F.when(F.col("l_returnflag") == "N", F.lit(0).cast("decimal(18,2)")).otherwise(money(F.col("price") - F.col("quantity")))
    heads = cut_lineage(nation_orders(t))  # read by the lines and by what is booked; the lines by their sums and by their shares
    d = cut_lineage(order_lines(t).join(heads.select("o_orderkey", "nation", "o_date"), "o_orderkey").select(
        "o_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "price", "nation", margin.alias("margin"), month_start(F.col("o_date")).alias("month")))
    booked = heads.where("o_orderstatus = 'F'").groupBy("nation", month_start(F.col("o_date")).alias("month")).agg(
        F.sum("amount").alias("booked"))
    per_flag = booked.withColumn("l_returnflag", F.explode(F.array(F.lit("A"), F.lit("N"), F.lit("R"))))
    out = N.true_up(d, per_flag, ["nation", "month", "l_returnflag"], "margin", "price", "booked")
    return out.select("o_orderkey", "l_linenumber", "l_partkey", F.col("margin_trueup").cast("double").alias("margin_trueup"))


def accounts(t: Tables) -> DataFrame:
    return documents(t).withColumn("account", F.concat("l_returnflag", "l_linestatus"))


GROUPS = {"AF": "Revenue", "AO": "Revenue", "NF": "COGS", "NO": "COGS", "RF": "Returns"}  # fixed values


@plan("account_groups", f"""
WITH {DOCUMENTS}
SELECT CASE l_returnflag || l_linestatus WHEN 'AF' THEN 'Revenue' WHEN 'AO' THEN 'Revenue' WHEN 'NF' THEN 'COGS' WHEN 'NO' THEN 'COGS'
  WHEN 'RF' THEN 'Returns' ELSE 'Others' END AS gl_group, nation, sum(price)::DOUBLE AS amount, count(*) AS n FROM doc_lines GROUP BY 1, 2
""")
def _(t: Tables):
    return N.account_groups(accounts(t), "account", GROUPS).groupBy("gl_group", "nation").agg(
        F.sum("price").cast("double").alias("amount"), F.count(F.lit(1)).alias("n"))


@plan("cost_only_documents", """
SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) = 0 AS cost_only FROM lineitem GROUP BY 1
""")
def _(t: Tables):
    return N.documents_with_only(t.lineitem, ["l_orderkey"], flag(F.col("l_returnflag") == "A"), "cost_only")


@plan("single_group_documents", """
SELECT l_orderkey, min(l_returnflag) AS l_returnflag FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1
""")
def _(t: Tables):
    return N.single_group_documents(t.lineitem, ["l_orderkey"], "l_returnflag")


@plan("top_side", f"""
WITH {NATION_ORDERS}, {FILLED_RATES}, edge AS (SELECT nation, max_by(rate, month) AS rate FROM filled_rates WHERE rate IS NOT NULL GROUP BY 1)
SELECT o_orderkey, CAST(amount::DOUBLE / coalesce(f.rate, e.rate)::DOUBLE AS DECIMAL(18,2))::DOUBLE AS amount_eur,
  CASE WHEN o.nation = 3 THEN 'moved' ELSE 'kept' END AS region
FROM nation_orders o LEFT JOIN filled_rates f ON f.nation = o.nation AND f.month = date_trunc('month', o_date)
LEFT JOIN edge e ON e.nation = o.nation
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')
""")
def _(t: Tables):
    sales = t.lineitem.where("l_returnflag = 'A'").select(F.col("l_orderkey").alias("o_orderkey"))
    top = N.top_side(nation_orders(t), sales, ["o_orderkey"]).withColumn("region", map_value(F.col("nation"), {3: "moved"}, F.lit("kept")))
    return N.convert(top, stored_rates(t), "nation", "o_date", "month", "rate", ["amount"]).select(
        "o_orderkey", F.col("amount_eur").cast("double").alias("amount_eur"), "region")


@plan("value_entry_adjustments", f"""
WITH {DOCUMENTS}
SELECT nation, p_brand, CAST(date_trunc('month', ship_date) AS DATE) AS month, sum(price)::DOUBLE AS cost, count(*) AS n
FROM doc_lines LEFT JOIN part ON p_partkey = l_partkey
WHERE l_linestatus = 'F' AND p_name NOT LIKE '%bolt' AND p_name NOT LIKE 'red%' GROUP BY 1, 2, 3
""")
def _(t: Tables):
    items = t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_name")
    kept = documents(t).where("l_linestatus = 'F'").join(items, "l_partkey", "left").where(
        exclude_patterns(F.col("p_name"), ["%bolt", "red%"]))
    return kept.groupBy("nation", "p_brand", month_start(F.col("ship_date")).alias("month")).agg(
        F.sum("price").cast("double").alias("cost"), F.count(F.lit(1)).alias("n"))


@plan("pivot_accounts", """
SELECT l_suppkey, sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)::DOUBLE AS "A",
  sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)::DOUBLE AS "N" FROM lineitem GROUP BY 1
""")
def pivot_accounts(t: Tables):
    lines = t.lineitem.select("l_suppkey", "l_returnflag", money(F.col("l_extendedprice")).alias("amount"))
    out = N.pivot_measures(lines, ["l_suppkey"], "l_returnflag", ["A", "N"], "amount")
    return out.select("l_suppkey", F.col("A").cast("double").alias("A"), F.col("N").cast("double").alias("N"))


@plan("journal_reshape", f"""
WITH {DOCUMENTS}, j AS (SELECT 'E' || nation AS entity, substr(x, strpos(x, 'VND') + 3, 4) AS vendor, l_returnflag, -price AS price
  FROM (SELECT *, 'post/VND' || lpad(CAST(l_suppkey % 10000 AS VARCHAR), 4, '0') || '/' || nation AS x FROM doc_lines))
SELECT entity, vendor, sum(CASE WHEN l_returnflag = 'A' THEN price END)::DOUBLE AS "A", sum(CASE WHEN l_returnflag = 'R' THEN price END)::DOUBLE AS "R" FROM j GROUP BY 1, 2
""")
def _(t: Tables):
    from tierwork.functions.text import after_marker

    text = F.concat(F.lit("post/VND"), F.lpad((F.col("l_suppkey") % 10000).cast("string"), 4, "0"), F.lit("/"), F.col("nation"))
    j = documents(t).select(F.concat(F.lit("E"), F.col("nation")).alias("entity"), after_marker(text, "VND", 4).alias("vendor"),
                            "l_returnflag", (-F.col("price")).alias("price"))
    out = N.pivot_measures(j, ["entity", "vendor"], "l_returnflag", ["A", "R"], "price")
    return out.select("entity", "vendor", *[F.col(c).cast("double").alias(c) for c in "AR"])


@plan("account_measures", """
SELECT l_orderkey, l_linenumber, l_partkey, (CASE WHEN l_returnflag = 'A' THEN a ELSE 0 END)::DOUBLE AS revenue,
  (CASE WHEN l_returnflag = 'N' THEN a ELSE 0 END)::DOUBLE AS cogs,
  (CASE WHEN l_returnflag = 'A' THEN a WHEN l_returnflag = 'N' THEN -a ELSE 0 END)::DOUBLE AS gp,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'returns desk' ELSE CAST(l_suppkey AS VARCHAR) END AS vendor
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS a FROM lineitem)
""")
def account_measures(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.concat("l_returnflag", "l_linestatus").alias("account"),
                              money(F.col("l_extendedprice")).alias("amount"), F.col("l_suppkey").cast("string").alias("vendor"))
    lookup = lines.select("account").distinct().select(
        "account", flag(F.col("account").startswith("A")).alias("is_revenue"), flag(F.col("account").startswith("N")).alias("is_cogs"),
        F.when(F.col("account") == "RF", "returns desk").alias("account_vendor"))
    out = N.account_measures(lines, lookup, "account", "amount", "vendor")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "vendor", *[F.col(c).cast("double").alias(c) for c in ("revenue", "cogs", "gp")])


@plan("default_currency", """
SELECT c_custkey, CASE c_nationkey WHEN 0 THEN 'CHF' WHEN 1 THEN 'GBP' WHEN 2 THEN 'SEK' ELSE 'EUR' END AS currency FROM customer
""")
def _(t: Tables):
    return t.customer.select("c_custkey", map_value(F.col("c_nationkey"), {0: "CHF", 1: "GBP", 2: "SEK"}, F.lit("EUR")).alias("currency"))


@plan("entity_map", """
SELECT n_name AS source_entity, CASE WHEN n_nationkey = 4 THEN 'GROUP-X' ELSE r_name END AS group_entity, 'nation' AS kind FROM nation JOIN region ON r_regionkey = n_regionkey
UNION SELECT s_name, n_name, 'supplier' FROM supplier JOIN nation ON n_nationkey = s_nationkey
""")
def _(t: Tables):
    nations = t.nation.join(t.region.withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey").select(
        F.col("n_name").alias("source_entity"), map_value(F.col("n_nationkey"), {4: "GROUP-X"}, F.col("r_name")).alias("group_entity"),
        F.lit("nation").alias("kind"))
    suppliers = t.supplier.join(t.nation.withColumnRenamed("n_nationkey", "s_nationkey"), "s_nationkey").select(
        F.col("s_name").alias("source_entity"), F.col("n_name").alias("group_entity"), F.lit("supplier").alias("kind"))
    return nations.unionByName(suppliers).distinct()


@plan("entity_remap", f"""
WITH {NATION_ORDERS} SELECT CASE nation WHEN 20 THEN 10 WHEN 21 THEN 10 ELSE nation END AS entity, year(o_date)::INT AS yr, sum(amount)::DOUBLE AS amount
FROM nation_orders GROUP BY 1, 2
""")
def _(t: Tables):
    return nation_orders(t).groupBy(map_value(F.col("nation"), {20: 10, 21: 10}, F.col("nation")).alias("entity"), F.year("o_date").alias("yr")).agg(
        F.sum("amount").cast("double").alias("amount"))


@plan("code_recode", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '100' WHEN 'O' THEN '200' ELSE 'NULL' END AS code FROM orders
""")
def _(t: Tables):
    from tierwork.sources.readers import recode

    o = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") == "P", "NaN").otherwise(F.col("o_orderstatus")).alias("code"))
    return recode(o, "code", {"F": "100", "O": "200"})


@plan("usage_explosion", """
SELECT o.o_orderkey, coalesce(l.l_partkey, -1) AS item, coalesce(CAST(l.l_extendedprice AS DECIMAL(18,2)), CAST(o_totalprice AS DECIMAL(18,2)))::DOUBLE AS price,
  l.l_orderkey IS NOT NULL AS from_usage
FROM orders o LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'N') l ON l.l_orderkey = o.o_orderkey
""")
def usage_explosion(t: Tables):
    heads = t.orders.select("o_orderkey", F.lit(-1).cast("long").alias("item"), money(F.col("o_totalprice")).alias("price"))
    usage = t.lineitem.where("l_returnflag = 'N'").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item"), money(F.col("l_extendedprice")).alias("price"))
    return N.explode_usage(heads, usage, "o_orderkey", ["item", "price"]).withColumn("price", F.col("price").cast("double"))


@plan("history_overlay", f"""
WITH {NATION_ORDERS}, h AS (SELECT nation, CASE WHEN nation > 3 THEN o_orderpriority END AS prio, CAST(date_trunc('month', o_date) AS DATE) AS month, min(o_orderstatus) AS status
  FROM nation_orders WHERE o_orderstatus <> 'P' AND o_date < DATE '1999-01-01' GROUP BY ALL)
SELECT o_orderkey, coalesce(h.status, o_orderstatus) AS status FROM nation_orders o
LEFT JOIN h ON h.nation = o.nation AND h.prio IS NOT DISTINCT FROM (CASE WHEN o.nation > 3 THEN o_orderpriority END) AND h.month = date_trunc('month', o_date)
""")
def history_overlay(t: Tables):
    prio = F.when(F.col("nation") > 3, F.col("o_orderpriority"))
    o = nation_orders(t).select("o_orderkey", "nation", prio.alias("prio"), "o_date", F.col("o_orderstatus").alias("status"))
    hist = o.where((F.col("status") != "P") & (F.col("o_date") < "1999-01-01")).withColumn("month", month_start(F.col("o_date")))
    return N.overlay_history(o, hist, ["nation", "prio"], "o_date", "month", ["status"]).select("o_orderkey", "status")


AS_OF = dt.date(2001, 7, 12)


@plan("provisional_vs_adjusted", f"""
WITH {DOCUMENTS} SELECT nation, CAST(date_trunc('month', o_date) AS DATE) AS month,
  sum(CASE WHEN o_date >= DATE '2001-07-01' THEN price ELSE price - quantity END)::DOUBLE AS margin FROM doc_lines GROUP BY 1, 2
""")
def _(t: Tables):
    d = documents(t).withColumn("adjusted", money(F.col("price") - F.col("quantity")))
    out = N.provisional_or_adjusted(d, "o_date", "price", "adjusted", AS_OF, "margin")
    return out.groupBy("nation", month_start(F.col("o_date")).alias("month")).agg(F.sum("margin").cast("double").alias("margin"))


@plan("cutover_union", f"""
WITH {NATION_ORDERS}, cut AS (SELECT DATE '2001-05-31' AS d)
SELECT 'ledger' AS origin, nation, o_date, sum(amount)::DOUBLE AS amount FROM nation_orders, cut WHERE o_date <= d AND o_orderstatus = 'F' GROUP BY ALL
UNION ALL SELECT 'transactions', nation, o_date, sum(amount)::DOUBLE FROM nation_orders, cut WHERE o_date > d GROUP BY ALL
""")
def _(t: Tables):
    # 12 July 2001 is before that July's 10th working day (13 July), so the ledger is used up to the end of May
    o = nation_orders(t)
    ledger_rows = o.where("o_orderstatus = 'F'").select(F.lit("ledger").alias("origin"), "nation", "o_date", "amount")
    sales = o.select(F.lit("transactions").alias("origin"), "nation", "o_date", "amount")
    return N.cut_over(ledger_rows, sales, "o_date", ledger_cut_off(F.lit(AS_OF))).groupBy("origin", "nation", "o_date").agg(
        F.sum("amount").cast("double").alias("amount"))


@plan("cost_group_first_date", f"""
WITH {DOCUMENTS} SELECT l_suppkey, o_orderkey, l_linenumber, l_partkey, count(*) OVER (PARTITION BY l_suppkey, o_date) AS lines_of_day FROM doc_lines
""")
def _(t: Tables):
    d = documents(t).select("l_suppkey", "o_orderkey", "l_linenumber", "l_partkey", "o_date")
    return with_group_stats(d, ["l_suppkey", "o_date"], lines_of_day=F.count(F.lit(1))).drop("o_date")
