"""Counts, checks, comparisons. One pass per table wherever the reference of a check is the table itself."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.functions.text import MISSING, is_missing
from tierwork.functions.values import safe_ratio
from tierwork.operators.profiles import value_counts
from tierwork.sources.storage import stored


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(is_missing(F.col(c).cast("string"))).alias(c) for c in columns])


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, non-null, null, distinct, missing. Values are counted once for all columns."""
    n_of = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    has = F.col("value").isNotNull()
    return value_counts(df, columns).groupBy("col_name").agg(
        F.sum("n").alias("rows"), n_of(has).alias("non_null_col"), n_of(~has).alias("null_col"),
        F.count("value").alias("distinct_col"), n_of(F.col("is_missing")).alias("missing_col"))


def multiple_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Number of keys with more than one distinct value (NULL does not count as one).

    min and max differ exactly when there are two values, and both combine before the shuffle.
    """
    spread = df.groupBy(key).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    return spread.agg(F.count_if(F.col("lo") != F.col("hi")).alias("multiple_count"))


def conflicting_groups(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that carry more than one value, with how many."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n_values")).where("n_values > 1")


def catalogue_conflicts(df: DataFrame, kind: str, group: str, together: Sequence[str]) -> DataFrame:
    """Kinds in several run groups and groups with several kinds, one row per (side, value, other) with ``n_others``.

    Kinds in ``together`` may lie in several groups, and a group whose kinds are exactly these is right. Entries without a kind or
    group are left out. The pairs are made distinct once; both sides come from them.
    """
    pairs = df.where(F.col(kind).isNotNull() & F.col(group).isNotNull()).select(
        F.col(kind).cast("string").alias("kind"), F.col(group).cast("string").alias("grp")).distinct()
    sides = pairs.select("kind", "grp", F.explode(F.array(
        F.struct(F.lit("kind").alias("side"), F.col("kind").alias("value"), F.col("grp").alias("other")),
        F.struct(F.lit("group").alias("side"), F.col("grp").alias("value"), F.col("kind").alias("other")))).alias("e")).select(
        "e.*", F.col("kind").isin(*together).alias("__free"))
    sizes = sides.groupBy("side", "value").agg(F.count(F.lit(1)).alias("n_others"), F.count_if("__free").alias("__n_free"))
    right = F.when(F.col("side") == "kind", F.col("__n_free") > 0).otherwise(
        (F.col("__n_free") == len(set(together))) & (F.col("n_others") == F.col("__n_free")))
    return sides.join(sizes.where((F.col("n_others") > 1) & ~right), ["side", "value"]).select("side", "value", "other", "n_others")


def catalogue_listing(df: DataFrame, active: str, order: str, wanted: Mapping[str, object]) -> DataFrame:
    """Active entries whose attributes have the wanted values (compared as text), with ``sort_key``: the order, 0 without one."""
    out = df.where(F.col(active).cast("string") == "1")
    for name, value in wanted.items():
        out = out.where(F.col(name).cast("string") == str(value))
    return out.withColumn("sort_key", F.coalesce(F.col(order), F.lit(0)))


def group_span(df: DataFrame, kind: str, group: str) -> DataFrame:
    """Least and greatest run group of each kind: what to offer where a listing is empty."""
    return df.where(F.col(kind).isNotNull()).groupBy(kind).agg(
        F.min(group).alias("first_group"), F.max(group).alias("last_group"), F.count(F.lit(1)).alias("n_entries"))


def accepted_values(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """One row: number of rows outside the list, an example, and OK / ERROR (WARNING for NULLs only)."""
    c = F.col(column)
    bad = ~c.isin(*allowed)
    return df.agg(
        F.count_if(bad).alias("n_bad"), F.count_if(c.isNull()).alias("n_null"),
        F.min(F.when(bad, c.cast("string"))).alias("example"),
    ).withColumn(
        "status", F.when(F.col("n_bad") > 0, "ERROR").when(F.col("n_null") > 0, "WARNING").otherwise("OK")
    )


def keys_without_active_row(df: DataFrame, keys: Sequence[str], active: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(active).alias("any_active")).where(~F.col("any_active")).select(*keys)


def orphan_keys(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    return child.select(*keys).distinct().join(parent.select(*keys), list(keys), "left_anti")


def not_positive(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(~F.coalesce(F.col(c) > 0, F.lit(False))).alias(c) for c in columns])


def placeholder_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c) == MISSING).alias(c) for c in columns])


def sentinel_counts(df: DataFrame, keys: Sequence[Column], sentinels: Mapping[str, Sequence]) -> DataFrame:
    """Per group: rows, and per column how many are NULL or one of its sentinel values."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull() | F.col(c).isin(*vals)).alias(f"{c}_missing") for c, vals in sentinels.items()],
    )


def check_constraints(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """One row per rule with its violations; as in SQL, a NULL outcome is no violation."""
    one = df.agg(*[F.count_if(~c).alias(n) for n, c in checks.items()])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in checks
    ])))


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def dataset_diff(
    a: DataFrame, b: DataFrame, keys: Sequence[str], fields: Sequence[str],
    tolerance: Mapping[str, float] | None = None, extra: Sequence[str] = (),
) -> DataFrame:
    """Full comparison by key: status, and per field what changed.

    Keys are compared NULL-safely and should be unique on both sides. ``tolerance`` is relative to the left value; a left
    value of 0 agrees only with 0. A value on one side only is a difference.
    """
    tolerance = dict(tolerance or {})
    left = a.select(*[F.col(c).alias(f"a_{c}") for c in dict.fromkeys([*keys, *fields, *extra])], F.lit(1).alias("in_a"))
    right = b.select(*[F.col(c).alias(f"b_{c}") for c in dict.fromkeys([*keys, *fields, *extra])], F.lit(1).alias("in_b"))
    cond = reduce(lambda x, y: x & y, [F.col(f"a_{k}").eqNullSafe(F.col(f"b_{k}")) for k in keys])

    def differs(f: str) -> Column:
        x, y = F.col(f"a_{f}"), F.col(f"b_{f}")
        if f not in tolerance:
            return ~x.eqNullSafe(y)
        apart = safe_ratio(F.abs(x - y), F.abs(x)) > tolerance[f]
        return F.when(x.isNull() | y.isNull() | (x == 0), ~x.eqNullSafe(y)).otherwise(apart)

    def change(f: str) -> Column:
        x, y = (F.coalesce(F.col(f"{s}_{f}").cast("string"), F.lit("NULL")) for s in "ab")
        either = F.col(f"a_{f}").isNotNull() | F.col(f"b_{f}").isNotNull()
        if f not in tolerance:
            return F.when(either, F.when(differs(f), F.concat_ws(" -> ", x, y)).otherwise(F.concat_ws(" == ", x, y)))
        pct = f"{tolerance[f] * 100}%"
        return F.when(
            F.col(f"a_{f}").isNotNull() & F.col(f"b_{f}").isNotNull(),
            F.when(differs(f), F.concat_ws(" -> ", x, y, F.lit(f"(diff: {pct})")))
            .otherwise(F.concat_ws(" ≈ ", x, y, F.lit(f"(within {pct})"))),
        ).when(either, F.concat_ws(" -> ", x, y))

    status = (
        F.when(F.col("in_a").isNull(), "ONLY_IN_DF2").when(F.col("in_b").isNull(), "ONLY_IN_DF1")
        .when(reduce(lambda x, y: x | y, [differs(f) for f in fields]), "DIFFERENT_VALUES").otherwise("EXACT_MATCH")
    )
    return left.join(right, cond, "full_outer").select(
        status.alias("comparison_status"),
        *[F.coalesce(f"a_{k}", f"b_{k}").alias(k) for k in keys],
        *[change(f).alias(f"{f}_changes") for f in fields],
        *[(safe_ratio(F.abs(F.col(f"a_{f}") - F.col(f"b_{f}")), F.abs(F.col(f"a_{f}"))) * 100).alias(f"{f}_difference_pct")
          for f in tolerance],
        *[F.lit(t * 100).alias(f"{f}_tolerance_pct") for f, t in tolerance.items()],
        *[F.coalesce(f"b_{c}", f"a_{c}").alias(c) for c in extra],
    )


def diff_summary(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct keys only left, only right, on both sides: one union and one aggregation, no join."""
    sides = a.select(*keys, F.lit(1).alias("side")).unionByName(b.select(*keys, F.lit(2).alias("side")))
    per_key = sides.groupBy(*keys).agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    label = F.when(F.col("lo") != F.col("hi"), "BOTH").when(F.col("lo") == 1, "ONLY_LEFT").otherwise("ONLY_RIGHT")
    return per_key.groupBy(label.alias("coverage")).agg(F.count(F.lit(1)).alias("n_keys"))


def prepare_report(df: DataFrame, mapping: Mapping[str, str], scale: int = 4) -> DataFrame:
    """target <- source; decimals rounded up to ``scale`` places, texts trimmed, NULLs filled."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def one(src: str) -> Column:
        c, kind = F.col(src), kinds[src]
        if isinstance(kind, T.DecimalType):
            return F.coalesce(F.ceil(c, scale), F.lit(0))
        if isinstance(kind, T.StringType):
            return F.coalesce(F.trim(c), F.lit(""))
        return c

    return df.select(*[one(src).alias(dst) for dst, src in mapping.items()])


def reconcile(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: counts of both sides and of the multiset and set differences both ways.

    Rows are grouped by their whole content with one count per side, so each side is read once and equal rows
    combine before the shuffle.
    """
    cols = a.columns
    both = a.select(*cols, F.lit(1).alias("__a"), F.lit(0).alias("__b")).unionByName(
        b.select(*cols, F.lit(0).alias("__a"), F.lit(1).alias("__b"))
    )
    n = both.groupBy(*cols).agg(F.sum("__a").alias("na"), F.sum("__b").alias("nb"))
    zero = F.lit(0)
    return n.agg(
        F.coalesce(F.sum("na"), zero).alias("rows_left"), F.coalesce(F.sum("nb"), zero).alias("rows_right"),
        F.coalesce(F.sum(F.greatest(F.col("na") - F.col("nb"), zero)), zero).alias("except_all_left"),
        F.coalesce(F.sum(F.greatest(F.col("nb") - F.col("na"), zero)), zero).alias("except_all_right"),
        F.count_if((F.col("na") > 0) & (F.col("nb") == 0)).alias("subtract_left"),
        F.count_if((F.col("nb") > 0) & (F.col("na") == 0)).alias("subtract_right"),
    )


def compare_by_period(a: DataFrame, b: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Both sides summed per key: left, right, difference, and difference in percent of the left."""
    left = a.groupBy(*keys).agg(F.sum(amount).alias("left_amount"))
    right = b.groupBy(*keys).agg(F.sum(amount).alias("right_amount"))
    gap = F.coalesce("left_amount", F.lit(0)) - F.coalesce("right_amount", F.lit(0))
    return left.join(right, list(keys), "full_outer").withColumn("difference", gap).withColumn(
        "difference_pct", safe_ratio(F.col("difference"), F.col("left_amount")) * 100
    )


def share_of_total(df: DataFrame, parent: Sequence[str], child: str, amount: Column) -> DataFrame:
    """Amount of each child group and its share of the parent's; aggregates twice, rows shuffle once."""
    per_child = df.groupBy(*parent, child).agg(F.sum(amount).alias("amount"), F.count(F.lit(1)).alias("n_rows"))
    totals = per_child.groupBy(*parent).agg(F.sum("amount").alias("parent_amount"))
    return per_child.join(totals, list(parent)).withColumn("share", safe_ratio(F.col("amount"), F.col("parent_amount")))


def schema_diff(a: DataFrame, b: DataFrame, spark) -> DataFrame:
    """Columns that are on one side only or differ in type; built from the two schemas, no data read."""
    left, right = dict(a.dtypes), dict(b.dtypes)
    rows = [
        (c, left.get(c), right.get(c)) for c in dict.fromkeys([*left, *right]) if left.get(c) != right.get(c)
    ]
    return spark.createDataFrame(rows, "column_name string, left_type string, right_type string")


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def summarise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_rows, n_nulls, n_distinct, mean, stddev, min_value, q1, median, q3, max_value) per column.

    Rows are counted per value first, so all columns are one aggregation of their values, which are stored in sampled ranges. Quartiles are exact
    (interpolated between neighbours) and, like mean and deviation, NULL for texts; least and greatest values are shown as text.
    """
    plain = ("decimal", "double", "float", "int", "bigint", "smallint", "tinyint")
    numeric = {f.name for f in df.schema.fields if f.dataType.simpleString().startswith(plain)}
    cells = F.explode(F.array(*[F.struct(
        F.lit(c).alias("column_name"), F.col(c).cast("string").alias("text"),
        (F.col(c).cast("double") if c in numeric else F.lit(None).cast("double")).alias("number")) for c in columns]))
    values = df.select(cells.alias("c")).groupBy("c.column_name", "c.text", "c.number").agg(F.count(F.lit(1)).alias("n"))
    counted = stored(values.repartitionByRange("column_name", "number", "text").withColumn("range", F.spark_partition_id()))
    total = F.sum(F.when(F.col("number").isNotNull(), F.col("n")))
    present = F.coalesce(F.sum(F.when(F.col("text").isNotNull(), F.col("n"))), F.lit(0))
    base = counted.groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), (F.sum("n") - present).alias("n_nulls"), F.count("text").alias("n_distinct"),
        (F.sum(F.col("number") * F.col("n")) / total).alias("mean"), F.coalesce(F.min_by("text", "number"), F.min("text")).alias("min_value"),
        F.coalesce(F.max_by("text", "number"), F.max("text")).alias("max_value"))
    apart = counted.join(base.select("column_name", "mean"), "column_name").groupBy("column_name").agg(
        F.sqrt(F.sum((F.col("number") - F.col("mean")) ** 2 * F.col("n")) / (total - 1)).alias("stddev"))
    return base.join(apart, "column_name").join(_quartiles(counted), "column_name", "left").select(
        "column_name", "n_rows", "n_nulls", "n_distinct", "mean", "stddev", "min_value", "q1", "median", "q3", "max_value")


def _quartiles(counted: DataFrame) -> DataFrame:
    """(column_name, q1, median, q3) of (column_name, number, text, n, range): one count per column and range tells which ranges hold a quartile,
    and only those are ordered, each by itself."""
    numbers = counted.where("number IS NOT NULL")
    sizes: dict[str, list[tuple[int, int]]] = {}
    for r in numbers.groupBy("column_name", "range").agg(F.sum("n").alias("n")).orderBy("column_name", "range").collect():
        sizes.setdefault(r.column_name, []).append((r.range, r.n))
    place = {c: {q: (sum(n for _, n in of) - 1) * p for q, p in QUARTILES.items()} for c, of in sizes.items()}
    before = F.lit(None).cast("long")  # values of the column in earlier ranges, NULL where the range holds no quartile
    for c, of in sizes.items():
        wanted = {f(x) for x in place[c].values() for f in (math.floor, math.ceil)}
        passed = 0
        for number, n in of:
            if any(passed <= x < passed + n for x in wanted):
                before = F.when((F.col("column_name") == c) & (F.col("range") == number), F.lit(passed).cast("long")).otherwise(before)
            passed += n
    ordered = Window.partitionBy("column_name", "range").orderBy("number", "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = numbers.withColumn("before", before).where("before IS NOT NULL").withColumn("upto", F.col("before") + F.sum("n").over(ordered))

    def at(q: str, step) -> Column:
        position = F.lit(None).cast("long")
        for c, of in place.items():
            position = F.when(F.col("column_name") == c, F.lit(step(of[q])).cast("long")).otherwise(position)
        return F.max(F.when((F.col("upto") > position) & (F.col("upto") - F.col("n") <= position), F.col("number")))

    ends = placed.groupBy("column_name").agg(
        *[at(q, f).alias(f"{q}_{side}") for q in QUARTILES for side, f in (("low", math.floor), ("high", math.ceil))])

    def between(q: str) -> Column:
        share = F.lit(None).cast("double")
        for c, of in place.items():
            share = F.when(F.col("column_name") == c, F.lit(of[q] - math.floor(of[q]))).otherwise(share)
        low, high = F.col(f"{q}_low"), F.col(f"{q}_high")
        return F.when(low == high, low).otherwise((1 - share) * low + share * high).alias(q)

    return ends.select("column_name", *[between(q) for q in QUARTILES])
