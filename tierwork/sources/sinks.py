"""Writing. A snapshot is never written over the files it was read from: it goes to a new folder or table version."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read a folder whose appended files differ in columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Only the partitions present in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def replace_slice(old: DataFrame, new: DataFrame, pred: Column) -> DataFrame:
    """Rows of the slice come from ``new``, all others from ``old``; a NULL outcome is outside the slice."""
    inside = F.coalesce(pred, F.lit(False))
    return old.where(~inside).unionByName(new.where(inside).select(*old.columns))


def delete_then_append(old: DataFrame, new: DataFrame, pred: Column) -> DataFrame:
    """Rows of the slice leave ``old``; all of ``new`` is appended."""
    return old.where(~F.coalesce(pred, F.lit(False))).unionByName(new.select(*old.columns))


def clear_keep_reserved(dim: DataFrame, pk: str) -> DataFrame:
    return dim.where(F.col(pk) <= 0)


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write a result to a new folder and go on from the files."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def publish_version(df: DataFrame, name: str, version: int) -> None:
    """Save ``name_v<version>`` and point the view ``name`` at it; readers see the old or the new one, never half."""
    df.write.mode("errorifexists").saveAsTable(f"{name}_v{version}")
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_v{version}")
