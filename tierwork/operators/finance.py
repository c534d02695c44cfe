"""Rates, allocations, periods and account views.

Amounts are decimals. Conversions divide decimals and round once; shares of an allocation are doubles, so that they add
up to the amount shared out.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwork.functions.dates import fiscal_to_calendar, month_sequence, month_start
from tierwork.functions.values import map_value, money, safe_ratio
from tierwork.operators.ordered import keep_first, with_lattice_of


def fx_rates(rates: DataFrame, entities: DataFrame, scenario: str, period: str, currency: str, rate: str) -> DataFrame:
    """Actual-scenario rates on calendar months, per entity through its currency."""
    code = F.col(scenario)
    real = rates.where(code.rlike("^[0-9]{4}") & code.like("%ACT%") & ~code.like("%AUD%") & ~code.like("%OB%"))
    month = fiscal_to_calendar(F.left(scenario, F.lit(4)).cast("int"), F.col(period).cast("int"))
    return real.withColumn("month", month).withColumn("scenario_group", F.lit("Actual")).join(
        entities, currency, "left"
    )


def fill_gaps(rates: DataFrame, entity: str, month: str, carried: Sequence[str], start: Column, end: Column) -> DataFrame:
    """Entity x month spine with every ``carried`` column taken from the last month that has it.

    ``start`` and ``end`` are constants, so the spine unfolds per entity: no cross join. An entity has one row per
    month, which bounds the window's groups.
    """
    spine = rates.select(entity).distinct().select(entity, F.explode(month_sequence(start, end)).alias(month))
    w = Window.partitionBy(entity).orderBy(month).rowsBetween(Window.unboundedPreceding, 0)
    joined = spine.join(rates.select(entity, month, *carried), [entity, month], "left")
    return joined.select(entity, month, *[F.last(c, ignorenulls=True).over(w).alias(c) for c in carried])


def boundary_rates(rates: DataFrame, entity: str, month: str, rate: str, which: str) -> DataFrame:
    """One rate per entity at its latest or earliest month that has one."""
    pick = F.max_by if which == "latest" else F.min_by
    return rates.where(F.col(rate).isNotNull()).groupBy(entity).agg(pick(rate, month).alias(f"{which}_rate"))


def convert(fact: DataFrame, rates: DataFrame, entity: str, date: str, month: str, rate: str,
            amounts: Sequence[str], fallback: str = "latest", reporting: Column | None = None) -> DataFrame:
    """Amounts divided by the rate of the entity's month, else by its latest (or earliest) known rate.

    Rows for which ``reporting`` holds are already in the reporting currency.
    """
    monthly = rates.select(entity, F.col(month).alias("__month"), F.col(rate).alias("__rate"))
    edge = boundary_rates(rates, entity, month, rate, fallback)
    joined = fact.withColumn("__month", month_start(F.col(date))).join(monthly, [entity, "__month"], "left").join(
        edge, entity, "left"
    )
    used = F.coalesce("__rate", f"{fallback}_rate")
    if reporting is not None:
        used = F.when(reporting, F.lit(1).cast("decimal(18,4)")).otherwise(used)
    return joined.select(*fact.columns, used.alias("fx_rate"), *[
        money(F.try_divide(F.col(a), used)).alias(f"{a}_eur") for a in amounts
    ])


def convert_by_currency(
    fact: DataFrame, rates: DataFrame, currency_rates: DataFrame, entity: str, currency: str, date: str, month: str, rate: str,
    amounts: Sequence[str],
) -> DataFrame:
    """Amounts divided by the rate of entity and month, else of currency and month, else by the currency's last known rate."""
    own = rates.select(entity, F.col(month).alias("__month"), F.col(rate).alias("__own"))
    shared = currency_rates.select(currency, F.col(month).alias("__month"), F.col(rate).alias("__shared"))
    last = boundary_rates(currency_rates, currency, month, rate, "latest")
    joined = fact.withColumn("__month", month_start(F.col(date))).join(own, [entity, "__month"], "left").join(
        shared, [currency, "__month"], "left").join(last, currency, "left")
    used = F.coalesce("__own", "__shared", "latest_rate")
    return joined.select(*fact.columns, used.alias("fx_rate"), *[money(F.try_divide(F.col(a), used)).alias(f"{a}_eur") for a in amounts])


def unify_documents(invoices: DataFrame, credits: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """Invoices and sign-flipped credit memos in one shape."""
    flipped = credits.withColumns({a: -F.col(a) for a in amounts})
    return invoices.withColumn("document_type", F.lit("invoice")).unionByName(
        flipped.withColumn("document_type", F.lit("credit"))
    )


def signed_documents(lines: DataFrame, credit: Column, amounts: Sequence[str]) -> DataFrame:
    """The same shape where invoices and credit memos are rows of one table: one scan, sign and type by condition."""
    is_credit = F.coalesce(credit, F.lit(False))
    return lines.withColumns({
        **{a: F.when(is_credit, -F.col(a)).otherwise(F.col(a)) for a in amounts},
        "document_type": F.when(is_credit, F.lit("credit")).otherwise(F.lit("invoice")),
    })


def explode_usage(lines: DataFrame, usage: DataFrame, key: str, replaced: Sequence[str]) -> DataFrame:
    """A line with usage details becomes one row per detail with the detail's values; others stay.

    Inner join plus anti join instead of one left join: a line with very many details is then a skewed side that AQE
    can split.
    """
    detail = usage.select(key, *[F.col(c).alias(f"__{c}") for c in replaced])
    unfolded = lines.join(detail, key).select(*[
        F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in replaced else F.col(c) for c in lines.columns
    ], F.lit(True).alias("from_usage"))
    plain = lines.join(usage.select(key).distinct(), key, "left_anti").select(*lines.columns, F.lit(False).alias("from_usage"))
    return unfolded.unionByName(plain)


def own_or_group(group: Column, own: Column) -> Column:
    """Grouping key that is the group where there is one, else the row's own key."""
    return F.when(group.isNull() | group.isin("NaN", "No Group"), F.concat(F.lit("own:"), own)).otherwise(
        F.concat(F.lit("group:"), group)
    )


def first_seen(df: DataFrame, date: str, starts: Mapping[str, str]) -> DataFrame:
    """First date per key: ``starts`` names a new column for each key column. ``df`` is computed once."""
    return with_lattice_of(df, [([key], {into: ("min", date)}) for into, key in starts.items()])


def _month_shares(lines: DataFrame, start: str, end: str, amount: str, over: int, under: int) -> tuple[DataFrame, list[str]]:
    """Per line: number of months, first month and share of a month.

    Months unfold as numbers later (a date sequence costs far more per element), and the division is done once per line.
    """
    first, last = F.col(start), F.add_months(F.col(end), -1)
    span = F.months_between(last, first)
    deferred = F.coalesce((first < F.col(end)) & (span > over) & (span < under), F.lit(False))
    apart = (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)
    count = F.when(deferred, apart + (F.add_months(first, apart) <= last).cast("int")).otherwise(F.lit(1))
    shared = lines.withColumns({
        "is_deferred": deferred, "period_count": count, "__base": F.when(deferred, F.trunc(first, "MM")).otherwise(first),
    }).withColumn("__share", money(F.try_divide(F.col(amount), F.col("period_count"))))
    kept = [c for c in lines.columns if c not in (start, end, amount)]
    return shared, kept


def _unfold_months(df: DataFrame, start: str) -> DataFrame:
    return df.withColumn("__i", F.explode(F.sequence(F.lit(0), F.col("period_count") - 1))).withColumn(
        start, F.add_months("__base", F.col("__i"))
    ).drop("__i", "__base")


def spread_deferred(lines: DataFrame, start: str, end: str, amount: str, over: int = 2, under: int = 120) -> DataFrame:
    """Lines running more than ``over`` and less than ``under`` months become one row per month with an equal share,
    dated the first of the month; other lines stay as they are. The last month counts when it is reached day for day.
    """
    shared, kept = _month_shares(lines, start, end, amount, over, under)
    return _unfold_months(
        shared.select(*kept, "is_deferred", "period_count", "__base", F.col("__share").alias(amount)), start)


def deferred_totals(lines: DataFrame, keys: Sequence[str], start: str, end: str, amount: str, over: int = 2, under: int = 120) -> DataFrame:
    """Totals of ``spread_deferred`` per keys and month. Lines with equal start and length unfold alike, so they are summed
    first and only the sums unfold."""
    shared, _ = _month_shares(lines, start, end, amount, over, under)
    sums = shared.groupBy(*keys, "is_deferred", "period_count", "__base").agg(
        F.sum("__share").alias(amount), F.count(F.lit(1)).alias("n_rows"))
    return _unfold_months(sums, start).groupBy(*keys, "is_deferred", start).agg(
        F.sum(amount).alias(amount), F.sum("n_rows").alias("n_rows"))


def ytd_to_monthly(ytd: DataFrame, keys: Sequence[str], period: str, amount: str, close: bool = True) -> DataFrame:
    """Year-to-date balances -> movements per period (current minus previous).

    With ``close`` a key whose last period is before 12 gets a zero balance in the next one, so the balance is taken
    back. ``keys`` include the year: a group holds at most 12 periods.
    """
    balances = ytd.groupBy(*keys, period).agg(F.sum(amount).alias(amount))
    if close:
        ends = balances.groupBy(*keys).agg(F.max(period).alias("__last")).where("__last < 12")
        zero = ends.select(*keys, (F.col("__last") + 1).alias(period), F.lit(0).alias(amount))
        balances = balances.unionByName(zero)
    w = Window.partitionBy(*keys).orderBy(period)
    before = F.coalesce(F.lag(amount).over(w), F.lit(0))
    return balances.select(*keys, period, F.col(amount).alias("ytd_amount"), (F.col(amount) - before).alias(amount))


def cost_gap(ledger: DataFrame, lines: DataFrame, keys: Sequence[str], cost: str) -> tuple[DataFrame, DataFrame]:
    """(gap per document that has lines, cost of ledger documents without lines); keys compared on equality."""
    booked = ledger.groupBy(*keys).agg(F.sum(cost).alias("booked"))
    known = lines.groupBy(*keys).agg(F.sum(cost).alias("known"))
    gap = known.join(booked, list(keys), "left").select(
        *keys, (F.coalesce("booked", F.lit(0)) - F.col("known")).alias("gap")
    )
    missed = booked.join(known, list(keys), "left_anti").select(*keys, F.col("booked").alias("gap"))
    return gap, missed


def split_by_date(gap: DataFrame, ledger: DataFrame, keys: Sequence[str], date: str, cost: str) -> DataFrame:
    """A document's gap over the posting dates of its ledger rows by their share of the cost; equal parts if that is 0."""
    dated = ledger.groupBy(*keys, date).agg(F.sum(cost).alias("__c"))
    totals = dated.groupBy(*keys).agg(F.sum("__c").alias("__total"), F.count(F.lit(1)).alias("__n"))
    share = F.coalesce(safe_ratio(F.col("__c"), F.col("__total")), 1 / F.col("__n").cast("double"), F.lit(1.0))
    return gap.join(totals, list(keys), "left").join(dated, list(keys), "left").select(
        *keys, date, (F.col("gap").cast("double") * share).alias("gap")
    )


def allocate(gap: DataFrame, lines: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """Share each document's gap over its lines by weight, equally where the weights add up to 0.

    Lines keep all columns and get ``allocated``. Group sums come from a partial aggregation, so a document with a
    third of all lines is not brought into one task.
    """
    totals = lines.groupBy(*keys).agg(F.sum(weight).alias("__weight"), F.count(F.lit(1)).alias("__n"))
    per_doc = gap.groupBy(*keys).agg(F.sum("gap").alias("__gap")).where("__gap <> 0").join(totals, list(keys))
    share = F.coalesce(safe_ratio(F.col(weight), F.col("__weight")), 1 / F.col("__n").cast("double"))
    return lines.join(per_doc, list(keys)).select(
        *lines.columns, (F.col("__gap").cast("double") * share).alias("allocated")
    )


def allocate_dated(
    gap: DataFrame, lines: DataFrame, keys: Sequence[str], date: str, weight: str, line: str,
) -> DataFrame:
    """Each document's gap per date in cents: a row per line by weight, and one for the remainder that rounding leaves.

    ``gap`` has keys, ``date`` and ``gap``. Gives keys, ``date``, ``line`` (NULL for the remainder) and ``allocated``; per document and
    date they add up to the gap exactly. Lines are read once: their sums travel with them.
    """
    totals = lines.groupBy(*keys).agg(F.sum(weight).alias("__weight"), F.count(F.lit(1)).alias("__n"))
    per_line = lines.select(*keys, line, weight).join(totals, list(keys))
    share = F.coalesce(safe_ratio(F.col(weight), F.col("__weight")), 1 / F.col("__n").cast("double"))
    dated = gap.where("gap <> 0").select(*keys, date, F.col("gap").cast("double").alias("gap"))
    cents = lambda x: money(F.floor(x * 100 + 0.5).cast("decimal(18,0)") / 100)
    shared = per_line.join(dated, list(keys)).select(*keys, date, line, "gap", cents(F.col("gap") * share).alias("allocated"))
    # whole and parts of a document and date in one aggregation; a NULL date is a date
    left = shared.groupBy(*keys, date).agg((cents(F.max("gap")) - F.sum("allocated")).alias("allocated")).where("allocated <> 0")
    return shared.select(*keys, date, line, "allocated").unionByName(
        left.select(*keys, date, F.lit(None).cast(lines.schema[line].dataType).alias(line), money(F.col("allocated")).alias("allocated")))


def true_up(lines: DataFrame, booked: DataFrame, keys: Sequence[str], margin: str, revenue: str, booked_col: str) -> DataFrame:
    """Booked group margin shared by line margin over group margin.

    Where the group margin is 0 or NULL the group revenue divides instead; a line whose revenue equals the divisor
    counts with its revenue.
    """
    sums = lines.groupBy(*keys).agg(F.sum(margin).alias("__margin"), F.sum(revenue).alias("__revenue"))
    divisor = F.when(F.coalesce(F.col("__margin") == 0, F.lit(True)), F.col("__revenue")).otherwise(F.col("__margin"))
    own = F.when(divisor == F.col(revenue), F.col(revenue)).otherwise(F.col(margin))
    return lines.join(sums, list(keys), "left").join(booked.select(*keys, booked_col), list(keys), "left").select(
        *lines.columns,
        money(safe_ratio(own, divisor) * F.coalesce(F.col(booked_col), F.lit(0)).cast("double")).alias("margin_trueup"),
    )


def account_groups(ledger: DataFrame, account: str, groups: Mapping[str, str], other: str = "Others") -> DataFrame:
    return ledger.withColumn("gl_group", map_value(F.col(account), groups, F.lit(other)))


def documents_with_only(ledger: DataFrame, document: Sequence[str], flag: Column, into: str) -> DataFrame:
    """Mark documents none of whose rows reach above the flag (their highest flag is 0)."""
    tops = ledger.groupBy(*document).agg(F.max(flag).alias("__top"))
    return tops.withColumn(into, F.col("__top") == 0).drop("__top")


def single_group_documents(ledger: DataFrame, document: Sequence[str], group: str) -> DataFrame:
    """Documents all of whose rows are in one group, with that group."""
    return ledger.groupBy(*document).agg(F.min(group).alias(group), F.max(group).alias("__hi")).where(
        F.col(group) == F.col("__hi")
    ).drop("__hi")


def top_side(ledger: DataFrame, documents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ledger rows whose document is not a sales document."""
    return ledger.join(documents.select(*keys), list(keys), "left_anti")


def pivot_measures(df: DataFrame, keys: Sequence[str], by: str, values: Sequence[str], amount: str) -> DataFrame:
    """One column per named value; the list makes it one aggregation without a look at the data."""
    return df.groupBy(*keys).pivot(by, list(values)).agg(F.sum(amount))


def account_measures(df: DataFrame, lookup: DataFrame, account: str, amount: str, vendor: str) -> DataFrame:
    """Revenue, COGS and GP columns by account type; an account-level vendor overrides the row's."""
    flags = lookup.select(account, "is_revenue", "is_cogs", F.col("account_vendor").alias("__vendor"))
    zero = F.lit(0).cast("decimal(18,2)")
    rev = F.when(F.col("is_revenue") == 1, F.col(amount)).otherwise(zero)
    cogs = F.when(F.col("is_cogs") == 1, F.col(amount)).otherwise(zero)
    return df.join(flags, account, "left").withColumns({
        "revenue": rev, "cogs": cogs, "gp": rev - cogs, vendor: F.coalesce("__vendor", vendor),
    }).drop("__vendor", "is_revenue", "is_cogs")


def overlay_history(df: DataFrame, history: DataFrame, keys: Sequence[str], date: str, month: str,
                    attrs: Sequence[str]) -> DataFrame:
    """Attributes of the monthly history win over the row's own; joined NULL-safely on keys and month.

    The history is reduced to one row per key and month first, so it cannot multiply facts.
    """
    one = keep_first(history, [*keys, month], list(attrs)).select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.col(month).alias("__month"),
        *[F.col(a).alias(f"__{a}") for a in attrs],
    )
    cond = F.col("__month") == month_start(F.col(date))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return df.join(one, cond, "left").select(*[
        F.coalesce(F.col(f"__{c}"), F.col(c)).alias(c) if c in attrs else F.col(c) for c in df.columns
    ])


def provisional_or_adjusted(df: DataFrame, date: str, provisional: str, adjusted: str, as_of: dt.date, into: str) -> DataFrame:
    """The current month shows the provisional figure, earlier months the adjusted one."""
    first = as_of.replace(day=1)
    return df.withColumn(into, F.when(F.col(date) >= F.lit(first), F.col(provisional)).otherwise(F.col(adjusted)))


def cut_over(ledger: DataFrame, transactions: DataFrame, date: str, cut_off: Column) -> DataFrame:
    """Ledger up to the cut-off day, transactions after it."""
    return ledger.where(F.col(date) <= cut_off).unionByName(transactions.where(F.col(date) > cut_off))


def day_rate(fact: DataFrame, rates: DataFrame, date: str, source: str, target: str) -> DataFrame:
    """Exact-day rate of a currency pair: 1 for the same currency, the direct pair, else the reversed pair."""
    r = rates.select(F.col("rate_date").alias("__d"), F.col("from_currency").alias("__f"), F.col("to_currency").alias("__t"),
                     F.col("rate").alias("__r"))
    direct = r.toDF("d1", "f1", "t1", "direct")
    turned = r.toDF("d2", "f2", "t2", "turned")
    joined = fact.join(
        direct, (F.col(date) == F.col("d1")) & (F.col(source) == F.col("f1")) & (F.col(target) == F.col("t1")), "left"
    ).join(turned, (F.col(date) == F.col("d2")) & (F.col(source) == F.col("t2")) & (F.col(target) == F.col("f2")), "left")
    rate = F.when(F.col(source) == F.col(target), F.lit(1.0)).otherwise(
        F.coalesce(F.col("direct").cast("double"), safe_ratio(F.lit(1), F.col("turned")))
    )
    return joined.select(*fact.columns, rate.alias("day_rate"))
