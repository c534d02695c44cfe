"""Incremental and full reads, landing of text and nested rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.functions.values import row_hash
from tierwork.functions.values import map_value
from tierwork.operators.ordered import rank, running


def read_table(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(f"{root.rstrip('/')}/{name}.parquet" if fmt == "parquet" else f"{root}/{name}")


def register_tables(spark: SparkSession, root: str, names: Sequence[str], prefix: str = "", recreate: bool = False) -> None:
    """One temporary view per table folder; existing views stay unless ``recreate``."""
    for n in names:
        view = f"{prefix}{n}"
        if recreate or not spark.catalog.tableExists(view):
            read_table(spark, root, n).createOrReplaceTempView(view)


def read_increment(source: DataFrame, mark: str, low, high=None, **stamps) -> DataFrame:
    """Rows with low < mark (<= high), plus literal stamp columns; the range test reaches the scan."""
    rows = source.where(F.col(mark) > F.lit(low))
    if high is not None:
        rows = rows.where(F.col(mark) <= F.lit(high))
    return rows.withColumns({k: v if isinstance(v, Column) else F.lit(v) for k, v in stamps.items()}) if stamps else rows


def load_increment(source: DataFrame, loaded: DataFrame, ts: str) -> DataFrame:
    """Rows newer than anything loaded, all rows when nothing is. The mark is a scalar subquery, not a cross join."""
    mark = loaded.select(F.max(ts)).scalar()
    return source.where(mark.isNull() | (F.col(ts) > mark))


def load_full(source: DataFrame, stamp: str, at) -> DataFrame:
    return source.withColumn(stamp, F.lit(at))


def extract_keys(df: DataFrame, keys: Sequence[str], bits: int = 256) -> DataFrame:
    """Distinct business keys with their hash, for later soft deletes."""
    return df.select(*keys).distinct().withColumn("key_hash", row_hash([F.col(k) for k in keys], bits))


def assign_line_number(df: DataFrame, document: Sequence[str], order: Sequence[str], split: Column | None, into: str = "line_no") -> DataFrame:
    return running(df, document, order, split, {into: rank()})


def add_sequence(df: DataFrame, order: Sequence[str], split: Column | None, into: str = "seq_id") -> DataFrame:
    """Table-wide 1..n in a total order without sorting everything in one task."""
    return running(df, [], order, split, {into: rank()})


def split_hash_union(df: DataFrame, cond: Column, keys_if: Sequence[str], keys_else: Sequence[str],
                     into: str = "hash_id", bits: int = 512) -> DataFrame:
    """Rows that meet the condition are identified by one key list, the others by another; one projection."""
    def digest(keys: Sequence[str]) -> Column:
        return row_hash([F.col(k) for k in keys], bits)

    return df.withColumn(into, F.when(cond, digest(keys_if)).otherwise(digest(keys_else)))


def with_file_part(df: DataFrame, pattern: str, into: str) -> DataFrame:
    """Part of the file name by regex, from the scan's metadata column."""
    return df.select("*", F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).alias(into))


def valid_window(df: DataFrame, start: str, end: str, since, until) -> DataFrame:
    """Rows that start at or after ``since``, or end within [since, until]."""
    return df.where((F.col(start) >= F.lit(since)) | F.col(end).between(F.lit(since), F.lit(until)))


def parse_json(df: DataFrame, column: str, schema: str | T.StructType) -> DataFrame:
    """JSON text under an explicit schema, its fields as columns; malformed text gives NULLs."""
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.from_json(column, schema).alias("__j")).select(*kept, "__j.*")


def append_with_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """Columns either side lacks become NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def land_day(rows: DataFrame, ts: str, day, **stamps) -> DataFrame:
    """Rows of one day, as a half-open range on the raw column, stamped."""
    start = F.lit(day).cast("timestamp")
    return rows.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("interval 1 day"))).withColumns(
        {k: F.lit(v) for k, v in stamps.items()}
    )


def unloaded_units(available: DataFrame, loaded: DataFrame, unit: str) -> DataFrame:
    return available.select(unit).distinct().join(loaded.select(unit), unit, "left_anti")


def read_jdbc(spark: SparkSession, url: str, table: str, partition: tuple[str, int, int, int] | None = None,
              **options: str) -> DataFrame:
    """Database table; ``partition`` = (numeric column, low, high, number of parallel reads)."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partition:
        col, lo, hi, n = partition
        r = r.option("partitionColumn", col).option("lowerBound", lo).option("upperBound", hi).option("numPartitions", n)
    return r.load()


def recode(df: DataFrame, column: str, codes: Mapping[str, str], missing: str = "NULL") -> DataFrame:
    """Old code -> new code from a constant table; unknown codes stay, missing ones become the placeholder text."""
    c = F.col(column)
    return df.withColumn(column, F.coalesce(F.nullif(map_value(c, codes, c), F.lit("NaN")), F.lit(missing)))


def next_start(loaded: DataFrame, ts: str) -> DataFrame:
    """Where the next pull starts: the newest date loaded, 1900-01-01 when nothing is."""
    return loaded.agg(F.coalesce(F.max(ts), F.lit("1900-01-01").cast(loaded.schema[ts].dataType)).alias("next_start"))
