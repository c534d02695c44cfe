"""Dimensions with history: validity intervals, reserved members, late members, surrogate keys."""

from __future__ import annotations

import datetime as dt
import itertools
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from tierwork.operators.ordered import keep_first, last_seen, rank, running
from tierwork.sources.storage import cut_lineage

OPEN_END = dt.datetime(9999, 12, 31)
FIRST_START = dt.datetime(1990, 1, 1)
UNKNOWN = -1


def _range_runs(key: str, hash_col: str, ts: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of equal hashes in one sorted range, each as its first row with ``__next`` (start of the key's next run in the range), ``__cell``
    and whether it is the range's first or last run."""
    def codes(column: pa.Array) -> np.ndarray:
        return pc.dictionary_encode(column, null_encoding="encode").indices.to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = held = None  # the row before the batch; the run whose next one is still to come
        cell, first = TaskContext.get().partitionId(), True

        def told(runs: pa.Table, following: pa.Array, ends: bool) -> Iterator[pa.RecordBatch]:
            nonlocal first
            n = len(runs)
            marks = {"__next": following, "__cell": pa.array(np.full(n, cell), pa.int32()), "__first": pa.array(np.arange(n) == (0 if first else -1)), "__last": pa.array(np.arange(n) == (n - 1 if ends else -1))}
            for name, column in marks.items():
                runs = runs.append_column(name, column)
            first = False
            yield from runs.to_batches()

        for b in batches:
            if not len(b):
                continue
            rows = pa.Table.from_batches([b])
            joined = rows if last is None else pa.concat_tables([last, rows])
            k, h = codes(joined[key].combine_chunks()), codes(joined[hash_col].combine_chunks())
            new = (k[1:] != k[:-1]) | (h[1:] != h[:-1])
            starts = np.flatnonzero(new if last is not None else np.append(True, new))
            last = rows.slice(len(rows) - 1)
            runs = rows.take(pa.array(starts)) if held is None else pa.concat_tables([held, rows.take(pa.array(starts))])
            held, done = runs.slice(len(runs) - 1), runs.slice(0, len(runs) - 1)
            if len(done):
                k = codes(runs[key].combine_chunks())
                yield from told(done, pc.if_else(pa.array(k[1:] == k[:-1]), runs[ts].slice(1).combine_chunks(), pa.scalar(None, runs.schema.field(ts).type)), False)
        if held is not None:
            yield from told(held, pa.nulls(1, held.schema.field(ts).type), True)

    return run


def _across(ends: list) -> tuple[dict, dict]:
    """(ranges whose first run goes on from the range before, start after the last run of a range) from the first and last runs of all ranges."""
    going_on, after = set(), {}
    cells = sorted({r.cell for r in ends})
    first, last = ({r.cell: r for r in ends if getattr(r, side)} for side in ("is_first", "is_last"))
    for before, c in itertools.pairwise(cells):
        if (last[before].key, last[before].hash) == (first[c].key, first[c].hash):
            going_on.add(c)
    upcoming = None  # (key, start): the first start of a key in the ranges behind
    for c in reversed(cells):
        if upcoming is not None and upcoming[0] == last[c].key:
            after[c] = upcoming[1]
        one_run = last[c].key == first[c].key and first[c].next is None and last[c].is_first
        if c not in going_on:
            upcoming = (first[c].key, first[c].start)
        elif first[c].next is not None:
            upcoming = (first[c].key, first[c].next)
        elif not one_run:
            upcoming = None
    return going_on, after


def log_runs(log: DataFrame, key: str, hash_col: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The first row of every unbroken run of equal hashes of a key, with ``__next``: the start of the key's next run, if there is one.

    Rows are dealt to sampled ranges of (key, order) once, so a key is never one task, and every range is read once, sorted. A range's first and last run
    are its summary: only these can go on in the ranges beside it. The summaries, two rows a range, are scanned by the driver, which tells
    the ranges what their neighbours hold; starts and ends so come from one pass. Its runs are checkpointed.
    """
    order = [F.col(c) for c in (key, ts, *ties)]
    marks = StructType([
        StructField("__next", log.schema[ts].dataType), StructField("__cell", IntegerType()), StructField("__first", BooleanType()), StructField("__last", BooleanType())])
    ranged = log.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = cut_lineage(ranged.mapInArrow(_range_runs(key, hash_col, ts), StructType([*log.schema.fields, *marks.fields])))
    ends = runs.where("__first OR __last").select(
        F.col("__cell").alias("cell"), F.col(key).alias("key"), F.col(hash_col).alias("hash"), F.col(ts).alias("start"), F.col("__next").alias("next"),
        F.col("__first").alias("is_first"), F.col("__last").alias("is_last")).collect()  # two rows a range at most
    going_on, after = _across(ends)
    kind = log.schema[ts].dataType.simpleString()
    told = log.sparkSession.createDataFrame(
        [(c, c in going_on, after.get(c)) for c in sorted({r.cell for r in ends})], f"__cell int, __going_on boolean, __after {kind}")
    return runs.join(F.broadcast(told), "__cell").where(~(F.col("__first") & F.col("__going_on"))).select(
        *log.columns, F.when(F.col("__last"), F.col("__after")).otherwise(F.col("__next")).alias("__next"))


def versions_from_log(log: DataFrame, key: str, hash_col: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """Change log -> one row per unbroken run of equal hashes, with ``start_datetime`` and ``end_datetime``.

    A run starts where the hash differs from the previous row of the key and ends where the next run starts. ``ties`` order
    rows of one key and time; without them such rows have no order.
    """
    return log_runs(log, key, hash_col, ts, ties).withColumn("start_datetime", F.col(ts)).withColumn(
        "end_datetime", F.coalesce("__next", F.lit(OPEN_END))).drop("__next", ts)


def apply_log(dim: DataFrame, log: DataFrame, key: str, hash_col: str, ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """New snapshot of a dimension (key, attributes, hash, start, end, is_current) after a change log.

    Rows of unseen keys and rows later than the current version count. Each is compared with the row before it, the current
    version standing in front: a value that returns is a version again, so a log applied in parts gives the same
    history as the whole log. The current version of a key that gets new versions is closed at the first new start.
    ``ties`` (columns of dimension and log) order rows of one key and time. New versions and closings come from one pass over the runs.
    """
    current = dim.where("is_current = 1")
    now = current.select(key, F.col("start_datetime").alias("__start"), *[F.col(c).alias(f"__{c}") for c in ties])
    place = lambda mark, names: F.struct(mark, *names)
    later = place(F.col(ts), map(F.col, ties)) > place(F.col("__start"), [F.col(f"__{c}") for c in ties])
    fresh = log.join(now, key, "left").where(F.col("__start").isNull() | later).select(*log.columns, F.lit(False).alias("__held"))
    front = current.join(log.select(key).distinct(), key, "left_semi").withColumn(ts, F.col("start_datetime").cast(log.schema[ts].dataType))
    rows = fresh.unionByName(front.select(*log.columns, F.lit(True).alias("__held")))
    runs = log_runs(rows, key, hash_col, ts, ties)
    added = runs.where(~F.col("__held")).withColumn("start_datetime", F.col(ts)).withColumn("end_datetime", F.coalesce("__next", F.lit(OPEN_END))).withColumn(
        "is_current", F.col("__next").isNull().cast("int")).select(*dim.columns)
    closings = runs.where(F.col("__held") & F.col("__next").isNotNull()).select(key, F.col("__next").alias("__closed"))
    return close_current(dim, closings, key, F.col("__closed")).unionByName(added)


def close_current(dim: DataFrame, closings: DataFrame, key: str, end: Column) -> DataFrame:
    """Close the current row of every key in ``closings`` (unique on the key)."""
    hit = F.col("__hit").isNotNull() & (F.col("is_current") == 1)
    joined = dim.join(closings.withColumn("__hit", F.lit(True)), key, "left")
    return joined.withColumn("end_datetime", F.when(hit, end).otherwise(F.col("end_datetime"))).withColumn(
        "is_current", F.when(hit, F.lit(0)).otherwise(F.col("is_current"))
    ).select(*dim.columns)


def close_and_insert(dim: DataFrame, updates: DataFrame, key: str, run_at: dt.datetime) -> DataFrame:
    """Every updated key: close its current row one second before the run, insert the new version.

    ``updates`` carries the dimension's columns without the validity ones and is unique on the key.
    """
    ends = updates.select(key).distinct()
    closed = close_current(dim, ends, key, F.lit(run_at - dt.timedelta(seconds=1)))
    added = updates.withColumns({
        "start_datetime": F.lit(run_at), "end_datetime": F.lit(OPEN_END), "is_current": F.lit(1),
    })
    return closed.unionByName(added.select(*dim.columns))


def merge_dimension(
    dim: DataFrame, source: DataFrame, key: str, source_col: str, ts: str, dim_ts: Sequence[str], run_at: dt.datetime,
) -> DataFrame:
    """One load of a dimension fed by several sources: rows changed since their source's last load, the last per key, replace
    the current versions; rows equal to the current version change nothing.

    Key, source and attributes are the columns that dimension and source share; ``run_at`` is the new versions' start and insert time.
    """
    changed = keep_first(changed_since(source, dim, source_col, ts, dim_ts), [key, source_col], [F.col(ts).desc()])
    shared = [c for c in dim.columns if c in source.columns and c not in dim_ts]
    now = dim.where("is_current = 1").select(*shared)
    fresh = changed.select(*shared).exceptAll(now)
    stamped = fresh.withColumns({dim_ts[0]: F.lit(run_at), **{c: F.lit(None).cast("timestamp") for c in dim_ts[1:]}})
    return close_and_insert(dim, stamped, key, run_at)


def changed_since(source: DataFrame, dim: DataFrame, source_col: str, ts: str, dim_ts: Sequence[str]) -> DataFrame:
    """Source rows newer than the dimension's last insert or update of the same source system."""
    last = dim.groupBy(source_col).agg(F.max(F.greatest(*dim_ts) if len(dim_ts) > 1 else F.col(dim_ts[0])).alias("__last"))
    return source.join(last, source_col, "left").where(
        F.col(ts) > F.coalesce("__last", F.lit(FIRST_START))
    ).select(*source.columns)


def overwrite_or_insert(dim: DataFrame, source: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Overwrite the value where it changed, insert unseen keys, keep the rest."""
    new = source.select(*keys, F.col(value).alias("__new"))
    kept = dim.join(new, list(keys), "left").withColumn(value, F.coalesce("__new", value)).select(*dim.columns)
    return kept.unionByName(source.join(dim.select(*keys), list(keys), "left_anti").select(*dim.columns))


def default_members(dim: DataFrame, sources: DataFrame, source_key: str, types: Sequence[str], type_col: str,
                    member: Mapping[str, Column]) -> DataFrame:
    """One reserved member per source x type that the dimension lacks.

    ``types`` is a fixed list, unfolded per source row: no cross join.
    """
    wanted = sources.select(source_key).distinct().withColumn(
        type_col, F.explode(F.array(*[F.lit(t) for t in types]))
    ).withColumns(dict(member))
    return wanted.join(dim, [source_key, type_col, *member], "left_anti")


def late_members(facts: DataFrame, dim: DataFrame, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """Members that facts refer to and the dimension lacks, staged with the given attributes."""
    return facts.select(key).where(F.col(key).isNotNull()).distinct().join(
        dim.select(key), key, "left_anti"
    ).withColumns(dict(columns))


def staged_start(df: DataFrame, dim: DataFrame, keys: Sequence[str], as_of: dt.datetime) -> DataFrame:
    """Start of a staged member: 1990-01-01 when it is new, the run time when the dimension knows it."""
    known = dim.select(*keys).distinct().withColumn("__known", F.lit(True))
    return df.join(known, list(keys), "left").withColumn(
        "start_datetime", F.when(F.col("__known"), F.lit(as_of)).otherwise(F.lit(FIRST_START))
    ).select(*df.columns, "start_datetime")


def surrogate_keys(new: DataFrame, order: Sequence[str], split: Column | None, existing: DataFrame | None, pk: str) -> DataFrame:
    """Consecutive keys after the highest existing one, in a total order; no single-task sort."""
    numbered = running(new, [], order, split, {"__n": rank()})
    if existing is None:
        return numbered.withColumn(pk, F.col("__n")).drop("__n")
    top = existing.select(F.coalesce(F.max(F.greatest(F.col(pk), F.lit(0))), F.lit(0))).scalar()
    return numbered.withColumn(pk, F.col("__n") + top).drop("__n")


def point_in_time(fact: DataFrame, dim: DataFrame, key: str, ts: str, pk: str, fk: str) -> DataFrame:
    """Key of the version valid at the fact's time (start <= t < end), -1 when there is none.

    Equality on the key is the join; the interval is a residual, at most one version survives it. For keys with few
    versions; see ``point_in_time_ordered`` for the others.
    """
    d = dim.select(
        F.col(key).alias("__key"), F.col(pk).alias(fk), F.col("start_datetime").alias("__from"),
        F.coalesce("end_datetime", F.lit(OPEN_END)).alias("__to"),
    )
    cond = (F.col(key) == F.col("__key")) & (F.col(ts) >= F.col("__from")) & (F.col(ts) < F.col("__to"))
    return fact.join(d, cond, "left").select(*fact.columns, F.coalesce(F.col(fk), F.lit(UNKNOWN)).alias(fk))


def point_in_time_ordered(fact: DataFrame, dim: DataFrame, key: str, ts: str, pk: str, fk: str, split: Column | None) -> DataFrame:
    """``point_in_time`` for keys with many versions: facts and version starts are laid in time order, each fact sees the
    last start before it. No fact meets all versions of its key, and a hot key is cut into cells.

    ``split`` is an expression on ``ts`` (see ``running``).
    """
    kind = fact.schema[ts].dataType
    starts = dim.select(
        key, F.col("start_datetime").cast(kind).alias(ts), F.lit(0).alias("__side"),
        F.struct(F.col(pk).alias("pk"), F.coalesce("end_datetime", F.lit(OPEN_END)).cast(kind).alias("until")).alias("__v"))
    rows = fact.withColumn("__side", F.lit(1))
    seen = running(rows.unionByName(starts, allowMissingColumns=True), [key], [ts, "__side"], split, {"__at": last_seen(F.col("__v"))})
    hit = F.when(F.col(ts) < F.col("__at.until"), F.col("__at.pk"))
    return seen.where("__side = 1").select(*fact.columns, F.coalesce(hit, F.lit(UNKNOWN)).alias(fk))


def fallback_earliest(fact: DataFrame, dim: DataFrame, key: str, pk: str, fk: str) -> DataFrame:
    """Facts without a version get the key's earliest one."""
    first = keep_first(dim.select(key, pk, "start_datetime"), [key], ["start_datetime", pk]).select(
        key, F.col(pk).alias("__pk")
    )
    return fact.join(first, key, "left").withColumn(
        fk, F.when(F.col(fk) == UNKNOWN, F.coalesce("__pk", F.lit(UNKNOWN))).otherwise(F.col(fk))
    ).select(*fact.columns)


def lookup_dimension_keys(fact: DataFrame, dims: Sequence[tuple[DataFrame, Sequence[str], str]]) -> DataFrame:
    """Per (dimension, business keys, pk): swap the business keys for ``<name>_fk``, -1 when unknown.

    No broadcast hint: AQE broadcasts a dimension by its measured size and shuffles a large one.
    """
    for dim, keys, pk in dims:
        fk = f"{pk.removesuffix('_pk')}_fk"
        found = dim.select(*keys, F.col(pk).alias(fk))
        fact = fact.join(found, list(keys), "left").withColumn(fk, F.coalesce(F.col(fk), F.lit(UNKNOWN))).drop(*keys)
    return fact
