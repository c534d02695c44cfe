"""Checks observed on several levels at once: grouping sets over one fine aggregate, layers of one master, ledgers side by side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwork.functions.text import MISSING
from tierwork.functions.values import safe_ratio


def level_keys(levels: Mapping[str, Sequence[str]]) -> list[str]:
    return list(dict.fromkeys(k for keys in levels.values() for k in keys))


def roll_up(fine: DataFrame, levels: Mapping[str, Sequence[str]], sums: Sequence[str], into: str = "level") -> DataFrame:
    """Sums of ``fine`` on every level, whose name stands in ``into``; keys that a level does not have are NULL.

    A key that is NULL in the data keeps its own row: levels are told apart by Spark's grouping id and not by NULLs. Two levels
    may not have the same keys.
    """
    keys = level_keys(levels)
    sets = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in own) for name, own in levels.items()}
    if len(set(sets.values())) < len(sets):
        raise ValueError("two levels have the same keys")
    name = F.lit(None).cast("string")
    for level, gid in sets.items():
        name = F.when(F.col("__gid") == gid, F.lit(level)).otherwise(name)
    rolled = fine.groupingSets([[F.col(k) for k in own] for own in levels.values()], *keys).agg(
        F.grouping_id().alias("__gid"), *[F.sum(c).alias(c) for c in sums])
    return rolled.select(name.alias(into), *keys, *sums)


def observe(df: DataFrame, levels: Mapping[str, Sequence[str]], checks: Mapping[str, Column]) -> DataFrame:
    """Per level and group: rows, and how many of them each check holds for (NULL is no hit).

    Rows are read and shuffled once, to the finest groups; the coarser levels are sums of those.
    """
    fine = df.groupBy(*level_keys(levels)).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(c).alias(n) for n, c in checks.items()])
    return roll_up(fine, levels, ["n_rows", *checks])


def null_and_default(defaults: Mapping[str, Sequence]) -> dict[str, Column]:
    """Two checks per column: it is NULL, it holds one of the values that stand for nothing."""
    out = {}
    for c, values in defaults.items():
        out |= {f"{c}_null": F.col(c).isNull(), f"{c}_default": F.col(c).isin(*values)}
    return out


def as_rows(observed: DataFrame, ids: Sequence[str], checks: Sequence[str]) -> DataFrame:
    """One row per group and check instead of one column per check."""
    return observed.unpivot([*ids], [*checks], "check_name", "n_hits")


def layer_counts(layers: Mapping[str, DataFrame], keys: Sequence[str], code: str) -> DataFrame:
    """One row: per layer of a master table its rows, rows with and without a code, and rows beyond the first of a (keys, code).

    NULL, blank and placeholder codes count as none and are no duplicates. Rows combine per key before the shuffle, so the rows
    without a code, which are one key, are one row per task.
    """
    stacked = None
    for name, df in layers.items():
        one = df.select(F.lit(name).alias("layer"), *keys, F.col(code).cast("string").alias("__code"))
        stacked = one if stacked is None else stacked.unionByName(one)
    none = F.col("__code").isNull() | F.trim("__code").isin("", MISSING)
    per_key = stacked.groupBy("layer", *keys, F.when(~none, F.col("__code")).alias("__code")).agg(F.count(F.lit(1)).alias("n"))
    has = F.col("__code").isNotNull()
    zero = F.lit(0)
    parts = []
    for name in layers:
        here = F.col("layer") == name
        parts += [
            F.coalesce(F.sum(F.when(here, F.col("n"))), zero).alias(f"{name}_rows"),
            F.coalesce(F.sum(F.when(here & has, F.col("n"))), zero).alias(f"{name}_with_code"),
            F.coalesce(F.sum(F.when(here & ~has, F.col("n"))), zero).alias(f"{name}_without_code"),
            F.coalesce(F.sum(F.when(here & has, F.col("n") - 1)), zero).alias(f"{name}_duplicates"),
        ]
    return per_key.agg(*parts)


def revenue_coverage(facts: DataFrame, master: DataFrame, keys: Sequence[str], amount: str, fact_name: str, master_name: str) -> DataFrame:
    """One row: partners of the facts inside and outside the master, with and without revenue, both revenues, and partners
    all of whose names differ from every name of the master.

    A master key with several rows counts once and multiplies nothing; revenue of partners with a NULL key is outside.
    """
    sums = facts.groupBy(*keys).agg(F.sum(amount).alias("__amount"))
    names = facts.select(*keys, F.col(fact_name).alias("__name")).where("__name is not null").distinct()
    known = master.select(*keys, F.col(master_name).alias("__name")).where("__name is not null").distinct()
    same = names.join(known, [*keys, "__name"], "left_semi").select(*keys, F.lit(True).alias("__same")).distinct()
    inside = master.select(*keys, F.lit(True).alias("__in")).distinct()
    per_key = sums.join(inside, list(keys), "left").join(same, list(keys), "left")
    within, earns = F.col("__in").isNotNull(), F.coalesce(F.col("__amount") != 0, F.lit(False))
    money = lambda c: F.coalesce(F.sum(F.when(c, F.col("__amount"))), F.lit(0)).cast("double")
    return per_key.agg(
        F.count_if(within & earns).alias("inside_with_revenue"), F.count_if(within & ~earns).alias("inside_without_revenue"),
        F.count_if(~within & earns).alias("outside_with_revenue"), F.count_if(~within & ~earns).alias("outside_without_revenue"),
        money(within).alias("inside_revenue"), money(~within).alias("outside_revenue"),
        F.count_if(within & F.col("__same").isNull()).alias("name_mismatches"))


def reconcile_levels(left: DataFrame, right: DataFrame, levels: Mapping[str, Sequence[str]], measures: Sequence[str]) -> DataFrame:
    """Both sides summed on every level, one row per group and measure: left, right, difference, difference in percent of the left.

    Both sides are stacked and summed to the finest groups in one aggregation, so there is no join; a side without rows counts as 0.
    """
    keys = level_keys(levels)
    stacked = None
    for side, df in (("l", left), ("r", right)):
        mine = [F.col(m).alias(f"{side}_{m}") for m in measures]
        other = [F.lit(0).cast(df.schema[m].dataType).alias(f"{'r' if side == 'l' else 'l'}_{m}") for m in measures]
        one = df.select(*keys, *mine, *other)
        stacked = one if stacked is None else stacked.unionByName(one)
    columns = [f"{s}_{m}" for m in measures for s in "lr"]
    rolled = roll_up(stacked.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns]), levels, columns)
    pairs = F.array(*[F.struct(
        F.lit(m).alias("measure"), F.coalesce(F.col(f"l_{m}"), F.lit(0)).alias("left_amount"),
        F.coalesce(F.col(f"r_{m}"), F.lit(0)).alias("right_amount")) for m in measures])
    return with_difference(rolled.select("level", *keys, F.inline(pairs)))


def with_difference(df: DataFrame, left: str = "left_amount", right: str = "right_amount", prefix: str = "") -> DataFrame:
    gap = F.col(left) - F.col(right)
    return df.withColumns({f"{prefix}difference": gap, f"{prefix}difference_pct": safe_ratio(gap, F.col(left)) * 100})


def year_to_date(df: DataFrame, keys: Sequence[str], year: str, period: str, amounts: Sequence[str]) -> DataFrame:
    """Amounts of the year up to each period, as ``ytd_`` columns; a period without a row has none.

    ``df`` holds at most one row per key, year and period, so a window is as long as a year has periods.
    """
    w = Window.partitionBy(*keys, year).orderBy(period).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumns({f"ytd_{c}": F.sum(c).over(w) for c in amounts})
