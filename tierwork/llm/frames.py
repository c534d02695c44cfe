"""Small helpers of the llm operators: row keys, names that clash with nothing, numbering, summing arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierwork.sources.storage import cut_lineage, fresh_dir

WORD = r"[^\x20\x09-\x0D]+"


def own_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def crc_rest(id_col: str, by: int) -> Column:
    """Remainder of the CRC32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % by


def numbered(df: DataFrame, order: Column, out: str) -> DataFrame:
    """Rows of ``df`` with their place (from 0) in ``order``: ranges are sorted apart, their sizes summed."""
    part = own_name(df, "_part")
    ranged = cut_lineage(df.repartitionByRange(order).withColumn(part, F.spark_partition_id()))
    sizes = ranged.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(
        F.col(part), F.coalesce(F.sum("_n").over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(part).orderBy(order)) - 1
    return ranged.withColumn(out, place).join(before, part).withColumn(out, (F.col(out) + F.col("_before")).cast("long")).drop(part, "_before")


_WIDTHS = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.int64}


def _pack(x: np.ndarray) -> bytes:
    """Counters of a block in the narrowest type that holds them; its width follows from the length."""
    most = int(x.max(initial=0))
    return x.astype(np.uint8 if most < 1 << 8 else np.uint16 if most < 1 << 16 else np.uint32 if most < 1 << 32 else np.int64).tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=_WIDTHS[len(data) // width])


def _block_batch(blocks: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int32()), "data": pa.array(data, pa.binary())})


def block_rows(counts: np.ndarray, width: int) -> pa.RecordBatch:
    """Counters as rows (block, bytes); blocks without a count are left out."""
    parts = counts.reshape(-1, width)
    full = np.flatnonzero(parts.any(axis=1)).tolist()
    return _block_batch(full, [_pack(parts[i]) for i in full])


def sum_blocks(rows: DataFrame, size: int, width: int) -> np.ndarray:
    """Sum of counter blocks of all tasks: added within groups of tasks first, then per block. ``size`` is fixed, so is the result."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for no, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if no not in sums:
                    sums[no] = np.zeros(width, dtype=np.int64)
                sums[no] += _unpack(data, width)
        if sums:
            yield _block_batch(list(sums), [_pack(x) for x in sums.values()])

    tasks = max(1, min(16, rows.sparkSession.sparkContext.defaultParallelism))
    kind = "block int, data binary"
    first = rows.withColumn("_to", F.pmod(F.spark_partition_id(), F.lit(tasks))).repartition(tasks, "_to").drop("_to").mapInArrow(add, kind)
    total = np.zeros(size, dtype=np.int64).reshape(-1, width)
    for r in first.repartition(tasks, "block").mapInArrow(add, kind).toLocalIterator():
        total[r.block] += _unpack(bytes(r.data), width)
    return total.reshape(-1)


@contextmanager
def _brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query planned within go when its action ends; else they stay until the driver happens to collect its garbage.

    Only for actions that have read all when they return: ``toLocalIterator`` has not.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: smaller than a checkpoint for tables of many rows."""
    to = fresh_dir(df.sparkSession, label)
    with _brief_shuffles(df.sparkSession):
        df.write.parquet(to)
    out = df.sparkSession.read.schema(df.schema).parquet(to)
    out._stored_at = to
    return out


def settled(df: DataFrame) -> DataFrame:
    """``cut_lineage`` that leaves no shuffle files."""
    with _brief_shuffles(df.sparkSession):
        return cut_lineage(df.select("*"))


def discard(*tables: DataFrame) -> None:
    """Deletes the files of tables that ``stored`` has returned; nothing may read them any more."""
    for df in tables:
        context = df.sparkSession.sparkContext
        at = context._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


FILTER_BITS = 1 << 27  # at most: 16 MB


def _key_map(wanted: DataFrame) -> np.ndarray:
    """A bit per key of ``wanted`` (one long column), in about 16 bits per key but never over ``FILTER_BITS``."""
    n = wanted.count()
    bits = min(FILTER_BITS, max(1 << 15, 1 << math.ceil(math.log2(16 * n + 1))))
    width = 1 << 12

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(bits // 8, dtype=np.uint8)
        for b in batches:
            at = b.column(0).to_numpy().view(np.uint64) % np.uint64(bits)
            np.bitwise_or.at(seen, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        parts = seen.reshape(-1, width)
        full = np.flatnonzero(parts.any(axis=1)).tolist()
        yield _block_batch(full, [parts[i].tobytes() for i in full])

    total = np.zeros((bits // 8 // width, width), dtype=np.uint8)
    tasks = max(1, min(16, wanted.sparkSession.sparkContext.defaultParallelism))
    for r in wanted.repartition(tasks).mapInArrow(mark, "block int, data binary").toLocalIterator():
        total[r.block] |= np.frombuffer(bytes(r.data), dtype=np.uint8)
    return total.reshape(-1)


def _marked(seen: np.ndarray, keys: pa.Array) -> pa.Array:
    at = keys.to_numpy().view(np.uint64) % np.uint64(8 * len(seen))
    return pa.array((seen[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1, pa.bool_())


def may_contain(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows of ``df`` whose long ``key`` may be among ``wanted`` (one long column): all that are, and few others.

    A bit per key (``_key_map``) thins out a table before it is shuffled for an exact join. With so many keys that the map fills up it only keeps more.
    """
    shared = df.sparkSession.sparkContext.broadcast(_key_map(wanted).tobytes())
    place = df.columns.index(key)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(shared.value, dtype=np.uint8)
        for b in batches:
            yield b.filter(_marked(seen, b.column(place)))

    return df.mapInArrow(keep, df.schema)


def may_be_among(key: Column, wanted: DataFrame) -> Column:
    """Whether a long ``key`` without nulls may be among ``wanted``, as in ``may_contain``; only the key goes to Python, so other columns may be of any type."""
    shared = wanted.sparkSession.sparkContext.broadcast(_key_map(wanted).tobytes())

    def run(keys: pa.Array) -> pa.Array:
        return _marked(np.frombuffer(shared.value, dtype=np.uint8), keys)

    return F.arrow_udf(run, "boolean")(key)
