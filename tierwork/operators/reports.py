"""Report shapes driven by configuration held as data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Line:
    """One configured report line; without a level it is a placeholder."""

    description: str
    level: str | None = None
    value: str | None = None


def report_rows(actual: DataFrame, budget: DataFrame, lines: Sequence[Line], report: str, keys: Sequence[str], amount: str) -> DataFrame:
    """Per line and key: revenue rows from the actuals and budget rows from the budget, plus placeholder rows.

    The data is read once: both sides are stacked and summed to (keys, levels) first; each small sum is then
    unfolded to the lines it belongs to.
    """
    levels = list(dict.fromkeys(x.level for x in lines if x.level))
    zero = F.lit(0).cast("decimal(18,2)")
    both = actual.select(*keys, *levels, F.col(amount).alias("revenue"), zero.alias("budget"), F.lit(True).alias("is_actual")).unionByName(
        budget.select(*keys, *levels, zero.alias("revenue"), F.col(amount).alias("budget"), F.lit(False).alias("is_actual"))
    )
    small = both.groupBy(*keys, *levels, "is_actual").agg(F.sum("revenue").alias("revenue"), F.sum("budget").alias("budget"))
    hits = F.filter(
        F.array(*[
            F.when(F.col(x.level) == x.value, F.struct(F.lit(i).alias("order_id"), F.lit(x.description).alias("description")))
            for i, x in enumerate(lines, 1) if x.level
        ]),
        lambda e: e.isNotNull(),
    )
    body = small.withColumn("line", F.explode(hits)).groupBy(
        *keys, "line.order_id", "line.description", "is_actual"
    ).agg(F.sum("revenue").alias("revenue"), F.sum("budget").alias("budget")).drop("is_actual")
    spark = actual.sparkSession
    blanks = spark.createDataFrame(
        [("<placeholder>", "1900-01-01", i, x.description) for i, x in enumerate(lines, 1) if not x.level],
        f"{keys[0]} string, {keys[1]} string, order_id int, description string",
    ).select(
        F.col(keys[0]), F.col(keys[1]).cast("date").alias(keys[1]), "order_id", "description",
        zero.alias("revenue"), zero.alias("budget"),
    )
    return body.unionByName(blanks).withColumn("report_type", F.lit(report))


def ageing_bucket(days: Column) -> Column:
    """Days on site: fixed limits and labels of the demo-order report."""
    return F.when(days < 55, "1. OK").when(days <= 60, "2. In Danger").when(days > 60, "3. Overdue")


@dataclass(frozen=True)
class VendorRule:
    """How one vendor wants its rows: a row filter and an expression per report column, as SQL text (absent ones stay NULL)."""

    vendor: str
    keep: str
    columns: Mapping[str, str]


def vendor_report(df: DataFrame, vendor: str, rules: Sequence[VendorRule], columns: Mapping[str, str], common: Sequence[str]) -> DataFrame:
    """One wide report over all vendors: a CASE per column and one combined row filter, in a single projection."""
    keep = F.lit(False)
    for r in rules:
        keep = keep | ((F.col(vendor) == r.vendor) & F.expr(r.keep))

    def one(name: str, kind: str) -> Column:
        out = F.lit(None)
        for r in reversed(rules):
            if name in r.columns:
                out = F.when(F.col(vendor) == r.vendor, F.expr(r.columns[name])).otherwise(out)
        return out.cast(kind).alias(name)

    return df.where(keep).select(*common, *[one(n, k) for n, k in columns.items()])


def variants(df: DataFrame, names: Mapping[str, Column], into: str = "report") -> DataFrame:
    """Each row once per report variant whose condition it meets."""
    hits = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in names.items()]), lambda e: e.isNotNull())
    return df.withColumn(into, F.explode(hits))


def explode_attempts(df: DataFrame, column: str, fields: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """Array of string maps -> one distinct row per element with the named entries, cast."""
    return df.select(*keep, F.explode(column).alias("__m")).select(
        *keep, *[F.try_element_at("__m", F.lit(k)).cast(t).alias(k) for k, t in fields.items()]
    ).distinct()


def collapse_max(df: DataFrame, key: str, excluded: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """One row per key with the maximum of every column; rows of the catch-all keys stay as they are."""
    other = F.col(key).isin(*excluded)
    return df.where(~other).groupBy(key).agg(*[F.max(c).alias(c) for c in cols]).unionByName(
        df.where(other).select(key, *cols)
    )
