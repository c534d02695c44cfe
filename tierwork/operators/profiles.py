"""Column profiles that are stored per run and merged without reading old data again.

The state of a run is two tables: how often each column has each value, and per id the least and greatest value of each
column. Both merge by an ordinary aggregation, so profiles of parts add up to the profile of the whole. Values of more than
64 characters are kept as their digest, so a state row is small however long the texts are.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwork.functions.text import is_missing

LONGEST = 64
COUNTS = "col_name string, value string, is_missing boolean, n long"


def _short(name: str) -> Column:
    text = F.col(name).cast("string")
    return F.when(F.length(text) > LONGEST, F.concat(F.lit("sha256:"), F.sha2(text, 256))).otherwise(text)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(col_name, value, is_missing, n): one aggregation for all columns, combined per task.

    Every column has one more row with n = 0, so that a column of an empty table differs from one that is not there.
    """
    cells = F.array(*[F.struct(
        F.lit(c).alias("col_name"), _short(c).alias("value"), is_missing(F.col(c).cast("string")).alias("is_missing"),
        F.lit(1).cast("long").alias("n")) for c in columns])
    marks = df.sparkSession.createDataFrame([(c, None, True, 0) for c in columns], COUNTS)
    return merge_counts(df.select(F.inline(cells)).unionByName(marks))


def merge_counts(parts: DataFrame) -> DataFrame:
    return parts.groupBy("col_name", "value", "is_missing").agg(F.sum("n").alias("n"))


def id_spread(df: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """Per id (as text) the least and greatest value of each column; a column that ``df`` lacks is NULL."""
    value = lambda c: _short(c) if c in df.columns else F.lit(None).cast("string")
    return df.groupBy(F.col(id_column).cast("string").alias("id")).agg(
        *[f(value(c)).alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))])


def merge_spread(parts: DataFrame, columns: Sequence[str]) -> DataFrame:
    return parts.groupBy("id").agg(*[f(f"{p}_{c}").alias(f"{p}_{c}") for c in columns for p, f in (("lo", F.min), ("hi", F.max))])


def profile_rows(counts: DataFrame, spread: DataFrame, id_column: str, columns: Sequence[str]) -> DataFrame:
    """One row per requested column: type, rows, non-null, null, distinct, missing texts, ids with several values.

    A column without counts is of type column_missing and has NULLs only; the id column has neither missing nor multiple count.
    """
    wanted = counts.sparkSession.createDataFrame(
        [(c, i) for i, c in enumerate(dict.fromkeys([id_column, *columns]))], "col_name string, position int")
    has = F.col("value").isNotNull()
    n_of = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    # the mark of a column may be a group of its own only where the column has no NULL; its n of 0 adds nothing
    per_column = counts.groupBy("col_name").agg(
        F.sum("n").alias("rows"), n_of(has).alias("non_null_col"), n_of(~has).alias("null_col"),
        F.count("value").alias("distinct_col"), n_of(F.col("is_missing")).alias("missing_names"))
    several = spread.agg(*[F.count_if(F.col(f"lo_{c}") != F.col(f"hi_{c}")).alias(f"m_{c}") for c in columns]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("col_name"), F.col(f"m_{c}").alias("multiple_names")) for c in columns])))
    is_id, there = F.col("col_name") == id_column, F.col("rows").isNotNull()
    kind = F.when(~there, "column_missing").when(is_id, "column_id").otherwise("column_attr")
    return wanted.join(per_column, "col_name", "left").join(several, "col_name", "left").select(
        "col_name", kind.alias("column_type"), "rows", "non_null_col", "null_col", "distinct_col",
        F.when(~is_id, F.col("missing_names")).alias("missing_names"),
        F.when(~is_id & there, F.col("multiple_names")).alias("multiple_names"))


def _folder(root: str, part: str, source: str) -> str:
    return f"{root.rstrip('/')}/{part}/source={source}"


def load_profile(df: DataFrame, root: str, source: str, env: str, id_column: str, columns: Sequence[str], run: str,
                 as_of: dt.datetime, recreate: bool = False) -> DataFrame:
    """Profile ``df`` as one run of ``source`` (``schema.table``) and store state and rows under ``root``; returns the rows.

    Writing the same run again replaces it; ``recreate`` removes all earlier runs of the source. Without the id column nothing
    is stored and an error is raised; other columns that are not there get a column_missing row.
    """
    if id_column not in df.columns:
        raise ValueError(f"{source} has no column {id_column}")
    spark, columns = df.sparkSession, [c for c in dict.fromkeys(columns) if c != id_column]

    def store(part: str, rows: DataFrame) -> DataFrame:
        folder = _folder(root, part, source)
        if recreate:  # the whole folder is written anew
            rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("run").parquet(folder)
            return spark.read.schema(rows.schema).parquet(folder)
        rows.write.mode("overwrite").parquet(f"{folder}/run={run}")
        return spark.read.schema(rows.schema).parquet(f"{folder}/run={run}")

    counts = store("counts", value_counts(df, [c for c in [id_column, *columns] if c in df.columns]))
    spread = store("spread", id_spread(df, id_column, columns))
    return store("profile", _stamped(profile_rows(counts, spread, id_column, columns), source, env, as_of))


def _stamped(rows: DataFrame, source: str, env: str, as_of: dt.datetime) -> DataFrame:
    schema, table = source.split(".", 1)
    return rows.select(F.lit(schema).alias("schema"), F.lit(table).alias("table"), F.lit(env).alias("env"), *rows.columns,
                       F.lit(as_of).alias("as_of"))


def merged_profile(spark: SparkSession, root: str, source: str, env: str, id_column: str, columns: Sequence[str],
                   as_of: dt.datetime) -> DataFrame:
    """The profile of all stored runs of a source together, from their states alone."""
    columns = [c for c in dict.fromkeys(columns) if c != id_column]
    kept = ", ".join(["id string", *[f"`{p}_{c}` string" for c in columns for p in ("lo", "hi")]])
    counts = merge_counts(spark.read.schema(COUNTS).parquet(_folder(root, "counts", source)))
    spread = merge_spread(spark.read.schema(kept).parquet(_folder(root, "spread", source)), columns)
    return _stamped(profile_rows(counts, spread, id_column, columns), source, env, as_of)
