"""Streaming jobs over the event files, compared on their final state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tierwork.plans.registry import Tables, plan
from tierwork.sources.storage import fresh_dir
from tierwork.streaming import increments as S

ALL_FILES = 2**31 - 1  # a batch takes all files that have arrived


@plan("stream_increment", "SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'error'")
def stream_increment(t: Tables):
    base = fresh_dir(t.spark, "stream")
    events = S.file_stream(t.spark, t.root, "events", t.events.schema).where("event_type <> 'error'")
    S.append_new(events.select("event_id", "user_id", "event_type"), f"{base}/out", f"{base}/offsets")
    return t.spark.read.parquet(f"{base}/out")


@plan("stream_upsert", """
SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
""")
def stream_upsert(t: Tables):
    """Three batches, each with rows of the whole time span, so that later ones bring late rows."""
    base = fresh_dir(t.spark, "stream")
    for part in range(3):
        t.events.where(F.col("event_id") % 3 == 2 - part).write.parquet(f"{base}/landing/{part}")
        events = S.file_stream(t.spark, f"{base}/landing", "part-", t.events.schema, files_per_batch=ALL_FILES)
        S.upsert_batches(events, f"{base}/state", f"{base}/offsets", ["user_id"], ["ts", "event_id"])
    return S.current_state(t.spark, f"{base}/state").select("user_id", "event_id", "event_type")


@plan("late_dimension_rekey", """
SELECT l_orderkey, l_linenumber, l_partkey, l_partkey + 1 AS part_fk FROM lineitem
""")
def late_dimension_rekey(t: Tables):
    from tierwork.operators.history import lookup_dimension_keys

    full = t.part.select("p_partkey", (F.col("p_partkey") + 1).alias("part_pk"), "p_size")
    early = full.where("p_size < 30").select(F.col("p_partkey").alias("l_partkey"), "part_pk")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_partkey").alias("code"))
    loaded = lookup_dimension_keys(lines, [(early, ["l_partkey"], "part_pk")]).withColumnRenamed("code", "l_partkey")
    return S.rekey_late(loaded, full.withColumnRenamed("p_partkey", "l_partkey"), "l_partkey", "part_pk", "part_fk").select(
        "l_orderkey", "l_linenumber", "l_partkey", "part_fk")
