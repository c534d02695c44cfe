"""The incremental batch jobs with a checkpoint in place of the stored mark.

``availableNow`` processes everything that has arrived, in batches, and stops; the next run continues from the
checkpoint. State is kept as versioned buckets in shared storage: a batch never overwrites what it reads, and a repeated
batch (after a failure) writes the same version again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwork.operators.cdc import merge_upsert
from tierwork.operators.history import UNKNOWN
from tierwork.operators.ordered import keep_first
from tierwork.sources.storage import cut_lineage


def file_stream(spark: SparkSession, root: str, name: str, schema: T.StructType, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*").option(
        "maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", "true").parquet(root)


def append_new(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append what has arrived since the last run."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(
        availableNow=True).start()
    query.awaitTermination()


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder, as Spark itself sees it."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete manifests, in order."""
    fs, place = _files(spark, f"{path}/manifest")
    if not fs.exists(place):
        return []
    done = [s.getPath() for s in fs.listStatus(place)]
    return sorted(int(p.getName()[2:]) for p in done if p.getName().startswith("v=") and fs.exists(p.suffix("/_SUCCESS")))


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict[int, int]:
    """{bucket: version that holds its rows} of a complete state, the newest one if none is named; as many rows as there are buckets."""
    known = _versions(spark, path)
    if not known:
        raise ValueError(f"no complete state in {path}")
    rows = spark.read.schema("bucket int, held long").parquet(f"{path}/manifest/v={known[-1] if version is None else version}")
    return {r.bucket: r.held for r in rows.collect()}


def _bucket_paths(path: str, held: dict[int, int]) -> list[str]:
    return [f"{path}/data/v={v}/bucket={b}" for b, v in sorted(held.items())]


def current_state(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete state: of every bucket the version its manifest names. A manifest is written after the rows it names."""
    return spark.read.parquet(*_bucket_paths(path, manifest(spark, path)))


def _drop_unnamed(spark: SparkSession, path: str, keep: int) -> None:
    """Remove buckets that none of the newest ``keep`` manifests names, and older manifests."""
    known = _versions(spark, path)
    named = {(b, v) for version in known[-keep:] for b, v in manifest(spark, path, version).items()}
    fs, data = _files(spark, f"{path}/data")
    for folder in fs.listStatus(data):
        version = int(folder.getPath().getName()[2:])
        if version > known[-1]:
            continue
        held = [s.getPath() for s in fs.listStatus(folder.getPath()) if s.getPath().getName().startswith("bucket=")]
        dead = [p for p in held if (int(p.getName()[7:]), version) not in named]
        for p in ([folder.getPath()] if len(dead) == len(held) else dead):
            fs.delete(p, True)
    for version in known[:-keep]:
        fs.delete(_files(spark, f"{path}/manifest/v={version}")[1], True)


def upsert_batches(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], latest: Sequence[str], buckets: int = 16, keep: int = 2, **merge,
) -> None:
    """Merge every micro-batch into the current table (see ``current_state``).

    Of all rows of a key, in whatever batch they come, the last by ``latest`` counts: a batch's rows are reduced to one
    per key, and those that are not after the stored row of their key are left out.

    The state lies in ``buckets`` by a hash of the keys. A batch writes only buckets in which a row changes, as a new version, and a manifest that names
    for every bucket the version that holds it; all other buckets keep their files. A batch that is repeated after a failure starts from the
    same manifest and writes the same version again. What none of the newest ``keep`` manifests names is removed. A bucket is
    written by one task: choose as many as the state has times what a task can hold. Their number must stay.
    """
    order = [F.col(c).desc() for c in latest]
    number = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")

    def one(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = [v for v in _versions(spark, path) if v < batch_id]
        held = manifest(spark, path, before[-1]) if before else {}
        rows = keep_first(batch, keys, order).withColumn("bucket", number)
        if held:
            rows = cut_lineage(rows)
            met = {b: held[b] for b in _touched(rows) if b in held}
            if met:
                stored = spark.read.parquet(*_bucket_paths(path, met)).select(*keys, F.struct(*latest).alias("__stored"))
                after = F.col("__stored").isNull() | (F.struct(*latest) > F.col("__stored"))
                rows = cut_lineage(rows.join(stored, list(keys), "left").where(after).select(*rows.columns))
            changed = _touched(rows)
            met = {b: held[b] for b in changed if b in held}
            if met:
                state = spark.read.parquet(*_bucket_paths(path, met))
                rows = merge_upsert(state, rows.drop("bucket"), keys, deactivate_absent=False, **merge).withColumn("bucket", number)
        rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/v={batch_id}")
        if not held:
            changed = _touched(spark.read.schema("bucket int").option("basePath", f"{path}/data/v={batch_id}").parquet(f"{path}/data/v={batch_id}"))
        named = sorted((held | dict.fromkeys(changed, batch_id)).items())
        spark.createDataFrame(named, "bucket int, held long").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/v={batch_id}")
        _drop_unnamed(spark, path, keep)

    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _touched(rows: DataFrame) -> list[int]:
    """The buckets rows fall into; no more than there are buckets."""
    return [r.bucket for r in rows.select("bucket").distinct().collect()]


def rekey_late(facts: DataFrame, dim: DataFrame, key: str, pk: str, fk: str) -> DataFrame:
    """Facts that came before their dimension member (-1) get its key once it exists; the others keep theirs."""
    found = dim.select(key, F.col(pk).alias("__pk"))
    return facts.join(found, key, "left").withColumn(
        fk, F.when(F.col(fk) == UNKNOWN, F.coalesce("__pk", F.lit(UNKNOWN))).otherwise(F.col(fk))
    ).select(*facts.columns)

