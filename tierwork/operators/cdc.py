"""Change capture: current flags, de-duplication, snapshot merges, soft delete, fact deltas.

Plain Parquet has no MERGE, so a merge is a function (target, source) -> new target: one full outer join on the keys,
one pass over both sides. Both sides must be unique on the keys (``keep_first`` makes them so).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwork.functions.text import normalise_missing
from tierwork.operators.ordered import keep_first, with_group_stats


def current_flag(df: DataFrame, mode: str, keys: Sequence[str], mark: str, flag: str = "is_current") -> DataFrame:
    """``delta``: newest mark per key; ``most-recent``: newest mark of the table; ``full``: every row."""
    if mode == "full":
        return df.withColumn(flag, F.lit(True))
    if mode == "most-recent":
        return df.withColumn(flag, F.col(mark) == df.select(F.max(mark)).scalar())
    if mode == "delta":
        newest = with_group_stats(df, keys, nullable_keys=True, __newest=F.max(mark))
        return newest.withColumn(flag, F.col(mark) == F.col("__newest")).drop("__newest")
    raise ValueError(f"unknown mode {mode!r}")


def current_rows(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.where(F.col(flag))


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], hash_col: str | None = None) -> DataFrame:
    """First row per key, then (as stored hashes demand) first row per hash."""
    unique = keep_first(df, keys, order)
    return keep_first(unique, [hash_col], [*keys]) if hash_col else unique


def fill_missing(df: DataFrame, trim: bool = True) -> DataFrame:
    """Every text column: NULL and blank become the missing literal; one projection."""
    return df.select(*[
        normalise_missing(F.col(n), trim=trim).alias(n) if t == "string" else F.col(n) for n, t in df.dtypes
    ])


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(keys))


def _sides(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("t__here"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("s__here"))
    cond = reduce(lambda a, b: a & b, [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys])
    return t.join(s, cond, "full_outer")


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_col: str | None = None,
    current_col: str | None = None,
    keep_cols: Sequence[str] = (),
    force: bool = False,
    follow_flag: bool = True,
    deactivate_absent: bool = True,
) -> DataFrame:
    """New snapshot of ``target`` after merging ``source``.

    Matched and hash differs (or ``force``, or no hash): take the source, except ``keep_cols`` (insert time).
    Matched, same hash: take only the source's current flag (``follow_flag``). Absent from the source: current flag
    becomes false (``deactivate_absent``). New: insert.
    """
    both = _sides(target, source, keys)
    is_new = F.col("t__here").isNull()
    gone = F.col("s__here").isNull()
    changed = F.lit(True) if force or hash_col is None else ~F.col(f"t_{hash_col}").eqNullSafe(F.col(f"s_{hash_col}"))

    def merged(c: str) -> Column:
        t, s = F.col(f"t_{c}"), F.col(f"s_{c}")
        if c == current_col:
            left_alone = F.lit(False) if deactivate_absent else t
            return F.when(gone, left_alone).when(is_new | changed | F.lit(follow_flag), s).otherwise(t)
        if c in keys:
            return F.coalesce(t, s)
        if c not in source.columns:
            return t
        if c in keep_cols:
            return F.when(is_new, s).otherwise(t)
        return F.when(gone, t).when(is_new | changed, s).otherwise(t)

    return both.select(*[merged(c).alias(c) for c in target.columns])


def merge_current(target: DataFrame, source: DataFrame, keys: Sequence[str], hash_col: str, current_col: str,
                  keep_cols: Sequence[str] = ()) -> DataFrame:
    """Merge on keys + current flag: rows already closed are never touched, a returning key becomes a new row."""
    return merge_upsert(target, source, [*keys, current_col], hash_col, current_col, keep_cols)


def load_or_merge(target: DataFrame | None, source: DataFrame, keys: Sequence[str], **merge) -> DataFrame:
    """First load takes the source as it is; later loads merge."""
    return source if target is None or target.isEmpty() else merge_upsert(target, source, keys, **merge)


def soft_delete(target: DataFrame, present_keys: DataFrame, keys: Sequence[str], flag: str = "is_deleted") -> DataFrame:
    """Flag rows whose key is not in the extract of existing keys, and unflag those that came back."""
    marks = present_keys.select(*keys).distinct().withColumn("__present", F.lit(True))
    return target.drop(flag).join(marks, list(keys), "left").select(
        *[F.col(c) for c in target.columns if c != flag], F.col("__present").isNull().alias(flag)
    )


def fact_delta(source: DataFrame, fact: DataFrame, key: str, active: str) -> DataFrame:
    """Source rows never loaded, plus source rows that are deleted while the fact still holds them as active."""
    unseen = source.join(fact.select(key), key, "left_anti")
    retired = source.where("is_deleted").join(fact.where(active).select(key), key, "left_semi")
    return unseen.unionByName(retired).distinct()


def deactivate_and_append(fact: DataFrame, delta: DataFrame, keys: Sequence[str], active: str = "is_active",
                          deleted: str = "is_deleted") -> DataFrame:
    """Old active versions of the delta's keys become inactive; its rows that are not deleted come in as active."""
    hit = delta.select(*keys).distinct().withColumn("__hit", F.lit(True))
    old = fact.join(hit, list(keys), "left").withColumn(active, F.col(active) & F.col("__hit").isNull())
    new = delta.where(~F.col(deleted)).withColumn(active, F.lit(True))
    return old.select(*fact.columns).unionByName(new.select(*fact.columns))


def delta_by_source(source: DataFrame, marks: DataFrame, source_col: str, ts_col: str, mark_col: str) -> DataFrame:
    """Rows newer than their own source's stored mark; all rows of a source without one."""
    m = marks.select(source_col, F.col(mark_col).alias("__mark"))
    late = F.col("__mark").isNull() | (F.col(ts_col) > F.col("__mark"))
    return source.join(m, source_col, "left").where(late).select(*source.columns)


def new_marks(df: DataFrame, source_col: str, ts_col: str, mark_col: str) -> DataFrame:
    return df.groupBy(source_col).agg(F.max(ts_col).alias(mark_col))


def advance_watermark(marks: DataFrame, seen: DataFrame, keys: Sequence[str], mark: str) -> DataFrame:
    """Stored marks moved up to the newest value seen, never down."""
    return marks.select(*keys, mark).unionByName(seen.select(*keys, mark)).groupBy(*keys).agg(F.max(mark).alias(mark))


def latest_stats(df: DataFrame, keys: Sequence[str], as_of: str, order: Sequence[str] = ()) -> DataFrame:
    """Newest snapshot row per natural key of a metrics table."""
    return keep_first(df, keys, [F.col(as_of).desc(), *order])


def one_set_per_day(df: DataFrame, as_of: str) -> DataFrame:
    """Only the day's last result set; all its rows share one ``as_of``."""
    last = df.groupBy(F.to_date(as_of).alias("__day")).agg(F.max(as_of).alias(as_of)).select(as_of)
    return df.join(last, as_of, "left_semi")
