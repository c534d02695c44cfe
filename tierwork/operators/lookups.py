"""Join shapes. Small sides carry no broadcast hint: AQE decides by the size it measures, whatever the table grew to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup_all(fact: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str], Sequence[str]]]) -> DataFrame:
    """Chain of left lookups: (dimension, keys, columns to add). Dimensions are unique on their keys."""
    for dim, keys, cols in lookups:
        fact = fact.join(dim.select(*keys, *cols), list(keys), "left")
    return fact


def full_outer_on_key(a: DataFrame, b: DataFrame, keys: Sequence[str], left: Sequence[str], right: Sequence[str]) -> DataFrame:
    """All rows of both sides on NULL-safe keys."""
    x = a.select(*[F.col(k).alias(f"__a{i}") for i, k in enumerate(keys)], *left)
    y = b.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)], *right)
    cond = reduce(lambda p, q: p & q, [F.col(f"__a{i}").eqNullSafe(F.col(f"__b{i}")) for i in range(len(keys))])
    return x.join(y, cond, "full_outer").select(
        *[F.coalesce(f"__a{i}", f"__b{i}").alias(k) for i, k in enumerate(keys)], *left, *right
    )


def join_on_expr(a: DataFrame, b: DataFrame, expr_a: Column, expr_b: Column, how: str = "left") -> DataFrame:
    """The expressions become key columns, so the join is an equi-join."""
    return a.withColumn("__key", expr_a).join(b.withColumn("__key", expr_b), "__key", how).drop("__key")


def join_either(a: DataFrame, b: DataFrame, first: str, second: str, key: str, value: str) -> DataFrame:
    """Value by the first key, else by the second: two equi-joins instead of an OR (which would be a nested loop)."""
    one = b.select(F.col(key).alias(first), F.col(value).alias("__v1"))
    two = b.select(F.col(key).alias(second), F.col(value).alias("__v2"))
    return a.join(one, first, "left").join(two, second, "left").select(
        *a.columns, F.coalesce("__v1", "__v2").alias(value)
    )


UNIT_BLOCK = 1000


def unit_blocks(df: DataFrame, quantity: str, after: str | None = None) -> DataFrame:
    """A row per block of at most ``UNIT_BLOCK`` pieces, numbered ``__first`` to ``__last``; ``after`` names a column with the pieces left out at the front."""
    n = F.floor(F.col(quantity)).cast("long")
    skipped = F.lit(0).cast("long") if after is None else F.col(after)
    block = lambda last: F.floor((last - 1) / UNIT_BLOCK)
    none = F.array().cast("array<long>")
    blocks = df.withColumn("__block", F.explode(F.when(n > skipped, F.sequence(block(skipped + 1), block(n))).otherwise(none)))
    start = F.col("__block") * UNIT_BLOCK
    return blocks.withColumns({"__first": F.greatest(start, skipped) + 1, "__last": F.least(start + UNIT_BLOCK, n)}).drop("__block")


def explode_quantity(df: DataFrame, quantity: str, into: str = "unit_no", after: str | None = None) -> DataFrame:
    """A line of n pieces becomes n rows numbered 1..n, or from the number behind the column ``after``; lines below 1 give none.

    Blocks of pieces unfold first, then the pieces of each, so no row holds an array in proportion to its quantity.
    """
    return unit_blocks(df, quantity, after).withColumn(into, F.explode(F.sequence("__first", "__last"))).drop("__first", "__last")


def stacked_quantities(df: DataFrame, keys: Sequence[str], quantity: str, sums: Mapping[str, Column], units: str = "units", after: str = "fewer") -> DataFrame:
    """(keys, units, after, sums): per key and quantity the sums over all lines of at least that many pieces, and the next smaller quantity.

    The pieces ``after`` + 1 to ``units`` have exactly these lines, so they unfold to their final rows and nothing is grouped behind ``explode_quantity``.
    """
    alike = df.groupBy(*keys, F.floor(F.col(quantity)).cast("long").alias(units)).agg(*[c.alias(n) for n, c in sums.items()]).where(F.col(units) >= 1)
    down = Window.partitionBy(*keys).orderBy(F.col(units).desc())
    upto = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return alike.select(*keys, units, F.coalesce(F.lead(units).over(down), F.lit(0)).cast("long").alias(after), *[F.sum(n).over(upto).alias(n) for n in sums])


def spine(entities: DataFrame, values: Column, into: str) -> DataFrame:
    """Every entity with every element of a constant array, unfolded in place."""
    return entities.distinct().withColumn(into, F.explode(values))


def link_intercompany(sales: DataFrame, purchase_lines: DataFrame, purchase_heads: DataFrame) -> DataFrame:
    """Sales line -> its purchase line -> purchase head -> the sister company's sales line -> that line's purchase line.

    sales(trans_id, company, order_id, ref_trans_id), purchase_lines(trans_id, company, purchase_id, sister_trans_id),
    purchase_heads(purchase_id, company, sister_company). Four left equi-joins on (transaction, company) pairs.
    """
    line = purchase_lines.select(
        F.col("trans_id").alias("ref_trans_id"), "company", "purchase_id", "sister_trans_id")
    head = purchase_heads.select("purchase_id", "company", F.upper("sister_company").alias("sister_company"))
    sister = sales.select(
        F.col("trans_id").alias("sister_trans_id"), F.col("company").alias("sister_company"),
        F.col("order_id").alias("sister_order_id"), F.col("ref_trans_id").alias("sister_ref"))
    sister_line = purchase_lines.select(
        F.col("trans_id").alias("sister_ref"), F.col("company").alias("sister_company"),
        F.col("purchase_id").alias("sister_purchase_id"))
    return (
        sales.join(line, ["ref_trans_id", "company"], "left")
        .join(head, ["purchase_id", "company"], "left")
        .join(sister, ["sister_trans_id", "sister_company"], "left")
        .join(sister_line, ["sister_ref", "sister_company"], "left")
        .select("trans_id", "company", "order_id", "purchase_id", "sister_company", "sister_trans_id",
                "sister_order_id", "sister_purchase_id")
    )


def match_external(ext: DataFrame, own: DataFrame, keys: Sequence[str], rule: str, loose_rules: Sequence[str],
                   note: str, own_cols: Sequence[str]) -> DataFrame:
    """External rows full-joined to own rows on the keys and - except under loose rules - on the delivery note.

    Split by kind of rule, so that both parts are equi-joins instead of one join on an OR.
    """
    mine = own.select(*[F.col(c).alias(f"own_{c}") for c in dict.fromkeys([*keys, note, *own_cols])])
    same = reduce(lambda p, q: p & q, [F.col(k) == F.col(f"own_{k}") for k in keys])
    loose = F.coalesce(F.col(rule).isin(*loose_rules), F.lit(False))
    strict_hits = ext.where(~loose).join(mine, same & (F.col(note) == F.col(f"own_{note}")), "left")
    loose_hits = ext.where(loose).join(mine, same, "left")
    alone = mine.join(
        ext.where(~loose).select(*keys, note).distinct(), same & (F.col(note) == F.col(f"own_{note}")), "left_anti"
    ).join(ext.where(loose).select(*keys).distinct(), same, "left_anti").select(
        *[F.lit(None).cast(kind).alias(c) for c, kind in ext.dtypes], *mine.columns
    )
    return strict_hits.unionByName(loose_hits).unionByName(alone)
