"""Streams continue where they stopped; state follows."""

import datetime as dt

from pyspark.sql import types as T

from tierwork.streaming import increments as S

SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType()), T.StructField("ts", T.TimestampType())])


def _land(spark, folder, rows):
    data = [(k, v, dt.datetime(2024, 1, d)) for k, v, d in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_append_continues_from_its_checkpoint(spark, tmp_path):
    src, out, marks = (str(tmp_path / x) for x in ("src", "out", "marks"))
    _land(spark, src, [(1, "a", 1), (2, "b", 1)])
    stream = S.file_stream(spark, src, "part-", SCHEMA)
    S.append_new(stream, out, marks)
    S.append_new(stream, out, marks)
    assert spark.read.parquet(out).count() == 2
    _land(spark, src, [(3, "c", 2)])
    S.append_new(S.file_stream(spark, src, "part-", SCHEMA), out, marks)
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_upsert_state_over_several_runs(spark, tmp_path):
    src, state, marks = (str(tmp_path / x) for x in ("src", "state", "marks"))

    def run():
        S.upsert_batches(S.file_stream(spark, src, "part-", SCHEMA, files_per_batch=1), state, marks, ["k"], ["ts"])
        return {r.k: r.v for r in S.current_state(spark, state).collect()}

    _land(spark, src, [(1, "a", 1), (1, "b", 2), (2, "x", 1)])
    assert run() == {1: "b", 2: "x"}
    assert run() == {1: "b", 2: "x"}
    _land(spark, src, [(1, "c", 3)])
    _land(spark, src, [(3, "n", 3)])
    assert run() == {1: "c", 2: "x", 3: "n"}
    _land(spark, src, [(1, "late", 2), (2, "y", 2), (3, "late", 1), (4, "m", 1)])
    assert run() == {1: "c", 2: "y", 3: "n", 4: "m"}


def test_upsert_writes_touched_buckets_only_and_drops_what_no_manifest_names(spark, tmp_path):
    src, state = (str(tmp_path / x) for x in ("src", "state"))

    def run(marks="marks"):
        S.upsert_batches(S.file_stream(spark, src, "part-", SCHEMA, files_per_batch=1), state, str(tmp_path / marks), ["k"], ["ts"], buckets=4)
        return {r.k: (r.v, r.ts.day) for r in S.current_state(spark, state).collect()}

    def files():
        return {str(p.relative_to(state)): p.stat().st_mtime_ns for p in (tmp_path / "state/data").rglob("*.parquet")}

    _land(spark, src, [(k, "a", 10) for k in range(40)])
    want = {k: ("a", 10) for k in range(40)}
    assert run() == want
    first, held = files(), S.manifest(spark, state)
    assert set(held) == {0, 1, 2, 3} and set(held.values()) == {0}
    _land(spark, src, [(7, "b", 11), (8, "late", 9)])  # one row that counts
    want[7] = ("b", 11)
    assert run() == want
    second, held = files(), S.manifest(spark, state)
    assert sorted(held.values()) == [0, 0, 0, 1] and first.items() <= second.items()
    hot = next(b for b, v in held.items() if v == 1)
    _land(spark, src, [(k, "late", 1) for k in range(40)])  # nothing that counts: no bucket is written
    assert run() == want and S.manifest(spark, state) == held
    kept = files()
    assert not any(f"v=0/bucket={hot}/" in p for p in kept) and {p: t for p, t in first.items() if f"bucket={hot}/" not in p}.items() <= kept.items()
    assert run() == want and files() == kept  # nothing new has arrived
    # the last batch comes again, as after a failure before its offsets were stored
    offsets = sorted((tmp_path / "marks/commits").glob("2*")) + sorted((tmp_path / "marks/commits").glob(".2*"))
    for p in offsets:
        p.unlink()
    assert run() == want and S.manifest(spark, state) == held and files() == kept


def test_upsert_of_new_keys_only(spark, tmp_path):
    src, state, marks = (str(tmp_path / x) for x in ("src", "state", "marks"))
    for k in range(3):
        _land(spark, src, [(k, "a", 1)])
        S.upsert_batches(S.file_stream(spark, src, "part-", SCHEMA), state, marks, ["k"], ["ts"], buckets=64)
    assert sorted(r.k for r in S.current_state(spark, state).collect()) == [0, 1, 2]


def test_rekey_late(spark):
    facts = spark.createDataFrame([(1, -1), (2, 20), (3, -1)], "code long, fk long")
    dim = spark.createDataFrame([(1, 10), (2, 99)], "code long, pk long")
    assert {r.code: r.fk for r in S.rekey_late(facts, dim, "code", "pk", "fk").collect()} == {1: 10, 2: 20, 3: -1}


def test_upsert_plan_lands_each_part_in_parallel(spark, tmp_path, monkeypatch):
    from tierwork.plans import QUERIES, streams

    rows = [(i, i % 7, "abc"[i % 3], dt.datetime(2024, 1, 1 + i * 11 % 28)) for i in range(200)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, ts timestamp").repartition(4).write.parquet(f"{tmp_path}/in/events.parquet")
    monkeypatch.setattr(streams, "fresh_dir", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a task per file
    try:
        got = {r.user_id: r.event_id for r in QUERIES["stream_upsert"](spark, f"{tmp_path}/in").collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {u: max((r[3], r[0]) for r in rows if r[1] == u)[1] for u in range(7)}
    assert len(list((tmp_path / "stream/landing").rglob("part-*.parquet"))) == 12
    assert S._versions(spark, f"{tmp_path}/stream/state") == [1, 2] and max(S.manifest(spark, f"{tmp_path}/stream/state").values()) == 2
