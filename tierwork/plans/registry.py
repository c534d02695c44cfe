"""Names -> plans, and names -> equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_SCHEMAS: dict[str, object] = {}


class Tables:
    """The given tables as attributes; the schema of a file is looked up once per process."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        path = self.path(name)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)


def plan(name: str, sql: str | None = None):
    """Register a function (Tables) -> DataFrame."""
    def wrap(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} registered twice")
        QUERIES[name] = lambda spark, root: fn(Tables(spark, root))
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return wrap


def hash_sql(*exprs: str) -> str:
    """SQL of ``row_hash``: length-prefixed fields, ``-`` for NULL."""
    fields = [f"coalesce(length(CAST({e} AS VARCHAR)) || ':' || CAST({e} AS VARCHAR), '-')" for e in exprs]
    return f"sha256({' || '.join(fields)})"


def money_sql(expr: str) -> str:
    return f"CAST({expr} AS DECIMAL(18,2))"
