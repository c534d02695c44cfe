"""Ordered work inside groups that stays parallel when one group holds a large part of the table.

Three shapes, by what is asked for:

* first row per key: ``row_number() = 1``. Spark prunes each map task to one row per key before the shuffle
  (WindowGroupLimit), so a hot key costs one row per map task.
* group totals: partial aggregation, then a join back. A hot key is split by AQE's skew join, which a window
  over the same key would not be.
* running values (rank, running sum, previous row, forward fill): ``running`` cuts each group into cells along its
  order, by sampled ranges or by a given expression, computes inside the cells in parallel, and carries one summary row per cell
  across. A group then never needs one task, whatever its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierwork.sources.storage import cut_lineage

GROUP, CELL, PLACE = "__group", "__cell", "__place"


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``, which must be total for a repeatable result."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def with_group_stats(df: DataFrame, keys: Sequence[str], nullable_keys: bool = False, **stats: Column) -> DataFrame:
    """Add per-group aggregates to every row.

    NULL keys form a group of their own with ``nullable_keys=True``; otherwise such rows get NULL statistics.
    """
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    if not nullable_keys:
        return df.join(totals, list(keys), "left").select(*df.columns, *stats)
    right = totals.select(F.struct(*keys).alias(GROUP), *stats)
    return df.withColumn(GROUP, F.struct(*keys)).join(right, GROUP, "left").select(*df.columns, *stats)


def with_stats_of(df: DataFrame, groupings: Sequence[tuple[Sequence[str], Mapping[str, Column]]]) -> DataFrame:
    """Aggregates of several groupings at once. Each is computed from ``df`` itself, so n groupings read it n + 1 times
    (nesting ``with_group_stats`` would read it 2 ** n times)."""
    out, names = df, list(df.columns)
    for keys, stats in groupings:
        out = out.join(df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()]), list(keys), "left")
        names += list(stats)
    return out.select(*names)


_MERGED_BY = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.sum}


def with_lattice_of(df: DataFrame, groupings: Sequence[tuple[Sequence[str], Mapping[str, tuple[str, str]]]]) -> DataFrame:
    """As ``with_stats_of`` for stats that merge, named (min, max, sum or count; column): ``df`` is computed once and stored.

    The finest groups, of all keys together, are aggregated once; every grouping is merged from them. Rows with a NULL key get
    NULL statistics. Worth it where ``df`` is a join; a plain table is cheaper to read again.
    """
    rows = cut_lineage(df)
    parts = list(dict.fromkeys(part for _, stats in groupings for part in stats.values()))
    first = {"min": F.min, "max": F.max, "sum": F.sum, "count": F.count}
    finest = list(dict.fromkeys(k for keys, _ in groupings for k in keys))
    fine = rows.groupBy(*finest).agg(*[first[f](c).alias(f"__{i}") for i, (f, c) in enumerate(parts)])
    out, names = rows, list(rows.columns)
    for keys, stats in groupings:
        merged = fine.groupBy(*keys).agg(*[
            _MERGED_BY[part[0]](f"__{parts.index(part)}").alias(into) for into, part in stats.items()])
        out = out.join(merged, list(keys), "left")
        names += list(stats)
    return out.select(*names)


@dataclass(frozen=True)
class _Running:
    """One running output: value inside the cell, summary of a cell, what earlier cells hand over, and the merge."""

    kind: str
    col: Column | None = None
    default: object = None


def rank() -> _Running:
    return _Running("rank")


def running_sum(col: Column) -> _Running:
    return _Running("sum", col)


def running_max(col: Column) -> _Running:
    return _Running("max", col)


def previous(col: Column, default=None) -> _Running:
    return _Running("previous", col, default)


def following(col: Column, default=None) -> _Running:
    return _Running("following", col, default)


def last_seen(col: Column) -> _Running:
    """Last value that is not NULL, the row's own included."""
    return _Running("last_seen", col)


def group_size() -> _Running:
    """Rows of the whole group; comes with the cell summaries."""
    return _Running("size")


def _inside(s: _Running, w, upto) -> Column:
    if s.kind == "size":
        return F.lit(None).cast("long")
    if s.kind == "rank":
        return F.row_number().over(w).cast("long")
    if s.kind == "sum":
        return F.sum(s.col).over(upto)
    if s.kind == "max":
        return F.max(s.col).over(upto)
    if s.kind == "previous":
        return F.lag(F.struct(s.col.alias("v"))).over(w)
    if s.kind == "following":
        return F.lead(F.struct(s.col.alias("v"))).over(w)
    return F.last(s.col, ignorenulls=True).over(upto)


def _of_cell(s: _Running, position: Column) -> Column:
    if s.kind in ("rank", "size"):
        return F.count(F.lit(1))
    if s.kind == "sum":
        return F.sum(s.col)
    if s.kind == "max":
        return F.max(s.col)
    if s.kind == "previous":
        return F.max_by(F.struct(s.col.alias("v")), position)
    if s.kind == "following":
        return F.min_by(F.struct(s.col.alias("v")), position)
    return F.max_by(s.col, F.when(s.col.isNotNull(), position))


def _handed_over(s: _Running, name: str, across) -> Column:
    if s.kind == "size":
        return F.sum(name).over(across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    if s.kind in ("rank", "sum"):
        return F.sum(name).over(before)
    if s.kind == "max":
        return F.max(name).over(before)
    if s.kind == "previous":
        return F.lag(name).over(across)
    if s.kind == "following":
        return F.lead(name).over(across)
    return F.last(name, ignorenulls=True).over(before)


def _merged(s: _Running, inside: Column, carried: Column) -> Column:
    if s.kind in ("rank", "sum"):
        return F.coalesce(inside + carried, inside, carried)
    if s.kind == "max":
        return F.greatest(inside, carried)
    if s.kind in ("previous", "following"):
        found = F.coalesce(inside, carried)
        return found["v"] if s.default is None else F.when(found.isNull(), F.lit(s.default)).otherwise(found["v"])
    return F.coalesce(inside, carried)


def running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], split: Column | None, outputs: Mapping[str, _Running]
) -> DataFrame:
    """Add running values per key in ascending ``order`` (column names, total inside a key).

    Without a ``split`` cells follow the data: rows are dealt to ranges of (keys, order) whose bounds Spark samples, so a
    cell holds what one range task holds whatever the keys are, and a key has at most as many cells as there are
    ranges. The ranges are checkpointed, because both passes must see the same ones. A given ``split`` saves that: it must
    not decrease along ``order`` and should keep every (key, cell) small enough for one task. Keys may be empty (a
    table-wide sequence). Use ``split=F.lit(0)`` where groups are known to be small.
    """
    # One hash of group and cell places rows for the window and for the join with the summaries, so the rows shuffle once
    # and sort on a long first. Keys are still compared themselves (NULL-safely) after the hash.
    cell = [*keys, CELL]
    if split is None:
        ranges = df.repartitionByRange(*[F.col(c) for c in (*keys, *order)])
        celled = cut_lineage(ranges.withColumn(CELL, F.spark_partition_id()))
    else:
        celled = df.withColumn(CELL, split)
    base = celled.withColumn(PLACE, F.xxhash64(*cell))
    w = Window.partitionBy(PLACE, *cell).orderBy(*order)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    inside = base.repartition(PLACE).select("*", *[_inside(s, w, upto).alias(f"__in_{n}") for n, s in outputs.items()])
    position = F.struct(*order)
    summary = base.groupBy(PLACE, *cell).agg(*[_of_cell(s, position).alias(f"__sum_{n}") for n, s in outputs.items()])
    across = Window.partitionBy(*keys).orderBy(CELL)
    carry = summary.select(
        PLACE, *[F.col(c).alias(f"__of_{c}") for c in cell],
        *[_handed_over(s, f"__sum_{n}", across).alias(f"__from_{n}") for n, s in outputs.items()],
    ).withColumnRenamed(PLACE, "__at")
    # a test over both sides at once stays a filter on the join; as a plain equality it would join it as keys and
    # shuffle the rows again
    own = F.struct(*cell)
    same = F.array_contains(F.array(F.struct(*[F.col(f"__of_{c}").alias(c) for c in cell])), own)
    return inside.join(carry, (F.col(PLACE) == F.col("__at")) & same, "left").select(
        *df.columns,
        *[_merged(s, F.col(f"__in_{n}"), F.col(f"__from_{n}")).alias(n) for n, s in outputs.items()],
    )


def by_width(col: str, width: int) -> Column:
    """Cells of ``width`` consecutive numbers."""
    return F.floor(F.col(col) / F.lit(width))


def by_period(col: str, unit: str = "month") -> Column:
    return F.date_trunc(unit, F.col(col))
