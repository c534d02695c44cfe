"""Choosing and linking master records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.text import MISSING
from tierwork.functions.values import map_value, priority_rank
from tierwork.operators.cdc import current_rows
from tierwork.operators.ordered import group_size, keep_first, rank, running
from tierwork.sources.storage import cut_lineage

FARTHEST = 2**63 - 1


def best_record(df: DataFrame, keys: Sequence[str], newest: str, tie: str, collect: str | None = None,
                into: str = "all_names") -> DataFrame:
    """Newest row per key, tie broken by the smallest ``tie``; optionally every distinct ``collect`` value of the key.

    The values are made distinct before they are gathered, so the array is as long as the number of different names,
    not as the number of rows. They come in the order of the record that carries them best.
    """
    best = keep_first(df, keys, [F.col(newest).desc_nulls_last(), F.col(tie)])
    if collect is None:
        return best
    age = F.coalesce(-F.unix_micros(F.col(newest).cast("timestamp")), F.lit(FARTHEST))
    position = F.struct(age.alias("age"), F.col(tie).alias("tie"))
    names = df.where(F.col(collect).isNotNull()).groupBy(*keys, collect).agg(F.min(position).alias("__at"))
    arrays = names.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("__at", collect))), lambda e: e[collect]).alias(into)
    )
    return best.join(arrays, list(keys), "left").select(
        *best.columns, F.coalesce(F.col(into), F.array().cast("array<string>")).alias(into)
    )


def name_positions(df: DataFrame, keys: Sequence[str], newest: str, tie: str, name: str) -> DataFrame:
    """Every distinct name of every key as a row (keys, name, position, n_names), in the order ``best_record`` lists them.

    Position 1 is the name whose best record is newest, then has the smallest ``tie``, then the smallest name; NULL times
    come last and NULL names not at all. Positions are counted over sampled ranges, so a key with any number of names never
    meets in one task. NULL keys are keys.
    """
    age = F.coalesce(-F.unix_micros(F.col(newest).cast("timestamp")), F.lit(FARTHEST))
    names = df.where(F.col(name).isNotNull()).groupBy(*keys, name).agg(F.min(F.struct(age.alias("age"), F.col(tie).alias("tie"))).alias("__at"))
    placed = names.select(*keys, name, F.col("__at.age").alias("__age"), F.col("__at.tie").alias("__tie"))
    out = running(placed, keys, ["__age", "__tie", name], None, {"position": rank(), "n_names": group_size()})
    return out.select(*keys, name, "position", "n_names")


def best_record_bounded(df: DataFrame, keys: Sequence[str], newest: str, tie: str, name: str, longest: int,
                        into: str = "all_names") -> tuple[DataFrame, DataFrame]:
    """``best_record`` whose list holds the first ``longest`` names of the key, and a table of all names beyond it.

    The records also carry ``n_names``, so a list that is not whole shows; list and table together hold each name once.
    Keys are compared NULL-safely; a key without names has an empty list and 0.
    """
    if longest < 1:
        raise ValueError("longest must be at least 1")
    names = cut_lineage(name_positions(df, keys, newest, tie, name))
    lists = names.where(F.col("position") <= longest).groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", name))), lambda e: e[name]).alias(into), F.max("n_names").alias("n_names"))
    right = lists.select(F.struct(*keys).alias("__of"), into, "n_names")
    best = keep_first(df, keys, [F.col(newest).desc_nulls_last(), F.col(tie)])
    listed = best.withColumn("__key", F.struct(*keys)).join(right, F.col("__key").eqNullSafe(F.col("__of")), "left")
    return listed.select(
        *best.columns, F.coalesce(F.col(into), F.array().cast(lists.schema[into].dataType)).alias(into),
        F.coalesce("n_names", F.lit(0)).alias("n_names"),
    ), names.where(F.col("position") > longest)


def with_customer_number(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) != MISSING)


def customer_source(accounts: DataFrame, number: str, tenant: str, newest: str, tie: str, name: str) -> DataFrame:
    """Current accounts with a customer number, best one per number and tenant, with all names."""
    return best_record(with_customer_number(current_rows(accounts), number), [number, tenant], newest, tie, name)


def grouped_customer_source(accounts: DataFrame, number: str, group: str, tenant: str, newest: str, tie: str) -> DataFrame:
    """Current accounts with a number and a group code, best one per number and tenant."""
    linked = with_customer_number(with_customer_number(current_rows(accounts), number), group)
    return best_record(linked, [number, tenant], newest, tie)


def group_source(groups: DataFrame, name: str, tenant: str, newest: str, tie: str) -> DataFrame:
    return best_record(current_rows(groups), [name, tenant], newest, tie)


def duplicate_profile(df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Column | None,
                      priority_col: str | None = None, ranks: Mapping[str, int] | None = None) -> DataFrame:
    """Add ``priority``, ``occurrence`` (rows of the key) and ``row_number`` (by priority, then ``order``)."""
    prio = priority_rank(F.col(priority_col), ranks or {}) if priority_col else F.lit(999)
    return running(
        df.withColumn("priority", prio), keys, ["priority", *order], F.struct(F.col("priority"), split),
        {"row_number": rank(), "occurrence": group_size()},
    )


def duplicates_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of keys that occur more than once: a semi join on the counted keys."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select(*keys)
    return df.join(repeated, list(keys), "left_semi")


def parent_child(df: DataFrame, id_col: str, keys: Sequence[str], order: Sequence[str], split: Column | None,
                 priority_col: str | None = None, ranks: Mapping[str, int] | None = None) -> DataFrame:
    """The first row of a key is the parent (no parent id); the others point to it."""
    prof = duplicate_profile(df, keys, order, split, priority_col, ranks)
    prio = priority_rank(F.col(priority_col), ranks or {}) if priority_col else F.lit(999)
    parents = keep_first(df.withColumn("__p", prio), keys, ["__p", *order]).select(
        *keys, F.col(id_col).alias("__parent")
    )
    is_parent = F.col("row_number") == 1
    return prof.join(parents, list(keys)).select(
        *prof.columns, is_parent.alias("is_parent"), F.when(~is_parent, F.col("__parent")).alias("parent_id")
    )


def link_groups(links: DataFrame, customers: DataFrame, groups: DataFrame, number: str, tenant: str, group: str,
                customer_pk: str, group_pk: str) -> DataFrame:
    """Winning links joined to the surrogate keys of customers and groups."""
    return links.select(number, tenant, group).join(
        customers.select(number, tenant, customer_pk), [number, tenant]
    ).join(groups.select(group, tenant, group_pk), [group, tenant]).select(
        number, tenant, group, customer_pk, group_pk
    )


def one_label(df: DataFrame, code: str, label: str) -> DataFrame:
    """One description per code: the largest."""
    return df.groupBy(code).agg(F.max(label).alias(label))


def longest_label(df: DataFrame, key: str, label: str) -> DataFrame:
    return keep_first(df.select(key, label).distinct(), [key], [F.length(label).desc(), label])


def resolve_label(df: DataFrame, name: str, group: str, code: str) -> DataFrame:
    """One group per name. A name with several groups keeps those of numeric (or missing) codes; then the largest."""
    m = df.select(F.lower(name).alias(name), F.lower(group).alias(group), code).distinct()
    spread = m.groupBy(name).agg((F.min(group) != F.max(group)).alias("__many"))
    numeric = (F.col(code) == MISSING) | ~F.col(code).rlike("[^0-9]")
    return m.join(spread, name).where(~F.col("__many") | numeric).groupBy(name).agg(F.max(group).alias(group))


def vendor_list(ledger: DataFrame, others: DataFrame, code: str, label: str, overrides: Mapping[str, str]) -> DataFrame:
    """Distinct (code, label) of two sources, labels overridden by code, longest label per code."""
    both = ledger.select(code, label).union(others.select(code, label)).distinct()
    return longest_label(both.withColumn(label, map_value(F.col(code), overrides, F.col(label))), code, label)


def latest_version(df: DataFrame, keys: Sequence[str], date: str, version: str, independent: bool = False) -> DataFrame:
    """Rows of the newest (date, version) per key.

    ``independent`` takes the maximum of both columns separately, so that a key without a row that has both drops out.
    """
    if independent:
        top = df.groupBy(*keys).agg(F.max(date).alias(date), F.max(version).alias(version))
    else:
        top = df.groupBy(*keys).agg(F.max(F.struct(date, version)).alias("t")).select(*keys, f"t.{date}", f"t.{version}")
    return df.join(top, [*keys, date, version], "left_semi")


def match_dimensions(dim: DataFrame, shared: DataFrame, name: str) -> DataFrame:
    """Members both name lists have, compared without case and outer blanks."""
    def norm(df: DataFrame) -> DataFrame:
        return df.withColumn("__n", F.lower(F.trim(F.col(name))))

    return norm(dim).join(norm(shared).select("__n").distinct(), "__n", "left_semi").drop("__n")
