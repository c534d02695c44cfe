"""Staging from several source systems: one shape for all, and one record per key with every attribute from the best source that has it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MISSING_TEXT = "N/A"


def in_shape(df: DataFrame, source: str, shape: T.StructType, columns: Mapping[str, Column | str]) -> DataFrame:
    """A source's rows in the common ``shape``: named columns cast to its types, all others missing, ``document_source`` set.

    A null text becomes the missing literal in every source, so that a reader need not know which source has which column; other types stay null.
    """
    unknown = set(columns) - set(shape.names)
    if unknown:
        raise ValueError(f"not in the shape: {sorted(unknown)}")
    given = {**columns, "document_source": F.lit(source)} if "document_source" in shape.names else dict(columns)

    def one(field: T.StructField) -> Column:
        col = given.get(field.name)
        col = (F.lit(None) if col is None else F.col(col) if isinstance(col, str) else col).cast(field.dataType)
        return (F.coalesce(col, F.lit(MISSING_TEXT)) if isinstance(field.dataType, T.StringType) else col).alias(field.name)

    return df.select(*[one(f) for f in shape.fields])


def survive(rows: DataFrame, keys: Sequence[str], source: str, changed: str, precedence: Mapping[str, Sequence[str]], missing: Sequence[str] = ("", "N/A", "NaN")) -> DataFrame:
    """One row per key: of every attribute the value of the first source of its precedence that has one, and ``<attribute>_source``.

    ``rows``: all sources one under the other; ``precedence``: attribute -> sources, best first; sources that are not listed do not count for it. Within a source
    the newest value by ``changed`` counts, then the least one. Null and the ``missing`` texts are no values. An attribute that no listed source
    has is null, and so is its source; keys with a null are dropped. All attributes come from one aggregate, which Spark sums in every
    task before the shuffle, so a key with very many rows is no large group.
    """
    def held(name: str) -> Column:
        text = isinstance(rows.schema[name].dataType, T.StringType)
        return F.when(~F.trim(F.col(name)).isin(*missing), F.col(name)) if text else F.col(name)

    def best(name: str, sources: Sequence[str]) -> Column:
        place = F.lit(None).cast("int")
        for n, s in reversed(list(enumerate(sources))):
            place = F.when(F.col(source) == s, n).otherwise(place)
        value, age = held(name), -F.coalesce(F.unix_micros(F.col(changed).cast("timestamp")), F.lit(-(1 << 62)))
        return F.min(F.when(value.isNotNull() & place.isNotNull(), F.struct(place.alias("p"), age.alias("a"), value.alias("v"), F.col(source).alias("s")))).alias(f"__{name}")

    kept = rows.dropna(subset=list(keys)).groupBy(*keys).agg(*[best(n, s) for n, s in precedence.items()])
    return kept.select(*keys, *[c for n in precedence for c in (F.col(f"__{n}.v").alias(n), F.col(f"__{n}.s").alias(f"{n}_source"))])
