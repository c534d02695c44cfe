"""Renaming, mapping, casting and aligning columns. Narrow projections only, never a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.functions.text import MISSING, parquet_name, snake_name


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def _rename_all(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    names = [rule(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"cleaned names collide: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def clean_for_parquet(df: DataFrame) -> DataFrame:
    return _rename_all(df, parquet_name)


def clean_column_names(df: DataFrame) -> DataFrame:
    return _rename_all(df, snake_name)


def mapped_columns(column_map: Mapping[str, str | None]) -> list[Column]:
    """Target <- source; a target without source becomes the missing-text literal."""
    return [(F.col(src) if src else F.lit(MISSING)).alias(dst) for dst, src in column_map.items()]


def cast_to_schema(df: DataFrame, schema: T.StructType, strict: bool = True) -> DataFrame:
    """Columns in the order and types of the target; ``strict=False`` turns bad values into NULL."""
    def one(f: T.StructField) -> Column:
        c = F.col(f.name)
        return (c.cast(f.dataType) if strict else c.try_cast(f.dataType)).alias(f.name)

    return df.select(*[one(f) for f in schema.fields])


def project_to_target(df: DataFrame, target: Sequence[str], fill: bool = False) -> DataFrame:
    """Columns both sides have, in target order; with ``fill`` absent ones become NULL."""
    have = set(df.columns)
    if fill:
        return df.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in target])
    return df.select(*[c for c in target if c in have])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Unified shape: typed NULL for what the source does not have."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def land_typed(df: DataFrame, mapping: Mapping[str, tuple[str, str]], **stamps) -> DataFrame:
    """target -> (source, type), then one literal column per keyword (load time, file, sheet)."""
    return df.select(
        *[F.col(src).cast(kind).alias(dst) for dst, (src, kind) in mapping.items()],
        *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in stamps.items()],
    )
