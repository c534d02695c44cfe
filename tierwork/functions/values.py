"""Numbers, hashes and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

def money(col: Column, precision: int = 18, scale: int = 2) -> Column:
    return col.cast(f"decimal({precision},{scale})")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL when b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def row_hash(cols: Sequence[Column], bits: int = 256) -> Column:
    """Digest of the columns in their order: each field is its length, a colon and its text, a NULL field is ``-``.

    So a NULL differs from an empty text, and no text can end early or run into the next column.
    """
    text = [c.cast("string") for c in cols]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text]), bits)


def is_not_false(col: Column) -> Column:
    return F.coalesce(col, F.lit(True))


def flag(cond: Column) -> Column:
    """1 when the condition holds, else 0 (also for NULL)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def exclude_patterns(col: Column, patterns: Sequence[str]) -> Column:
    """True when the text matches none of the LIKE patterns; NULL text is kept."""
    keep = F.lit(True)
    for p in patterns:
        keep = keep & ~F.coalesce(col.like(p), F.lit(False))
    return keep


def map_value(key: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Constant code table applied in the projection: no join, no shuffle."""
    expr = default if default is not None else F.lit(None)
    branches = None
    for k, v in mapping.items():
        branches = F.when(key == F.lit(k), F.lit(v)) if branches is None else branches.when(key == F.lit(k), F.lit(v))
    return expr if branches is None else branches.otherwise(expr)


def priority_rank(col: Column, ranks: Mapping[str, int], other: int = 999) -> Column:
    """Rank of the first name contained in the text, whatever its case."""
    expr = None
    for name, rank in ranks.items():
        hit = F.lower(col).contains(name.lower())
        expr = F.when(hit, F.lit(rank)) if expr is None else expr.when(hit, F.lit(rank))
    return F.lit(other) if expr is None else expr.otherwise(F.lit(other))


def sum_when(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))
