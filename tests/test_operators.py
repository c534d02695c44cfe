"""Edge cases of single operators on small frames."""

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.testing import assertDataFrameEqual

from tierwork.functions import dates as D
from tierwork.functions import text as X
from tierwork.functions.values import exclude_patterns, row_hash
from tierwork.operators import cdc, columns, finance, hierarchy, history, lookups, mastering, matching, ordered, quality, reports, staging
from tierwork.operators.hierarchy import flatten_levels, resolve_root, root_paths
from tierwork.sources import readers, sinks


def values(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- counts and columns ---------------------------------------------------------------------------------------------

def test_missing_strings(spark):
    texts = ["\t", "\u00a0", "0", None, None, " x ", "   ", "NULL", ""]
    df = spark.createDataFrame([(t, None, i) for i, t in enumerate(texts)], "s string, nothing string, n int")
    got = quality.missing_counts(df, ["s", "nothing"]).first()
    assert (got.nothing, got.s) == (9, 5)  # tabs and spaces are blank, a no-break space is not


def test_profile_counts_rows_nulls_and_distinct(spark):
    df = spark.createDataFrame([(i % 5 if i % 4 else None, None) for i in range(23)], "n long, nothing string")
    n, nothing = (quality.profile(df, [c]).first() for c in ("n", "nothing"))
    assert (n.rows, n.null_col, n.non_null_col, n.distinct_col) == (23, 6, 17, 5)
    assert (nothing.rows, nothing.null_col, nothing.non_null_col, nothing.distinct_col) == (23, 23, 0, 0)


def test_multiple_values_ignore_nulls(spark):
    rows = [(7, 1.5), (7, 2.5), (7, None), (8, None), (9, 3.0), (9, 3.0), (10, 0.0), (10, -1.0), (10, 4.0)]
    assert quality.multiple_values(spark.createDataFrame(rows, "k long, v double"), "k", "v").first().multiple_count == 2


def test_summary_is_exact(spark):
    df = spark.createDataFrame([(float(i % 10), "b" if i % 3 else None) for i in range(101)], "x double, s string")
    got = {r.column_name: r for r in quality.summarise(df, ["x", "s"]).collect()}
    xs = sorted(float(i % 10) for i in range(101))
    assert (got["x"].q1, got["x"].median, got["x"].q3, got["x"].n_distinct) == (xs[25], xs[50], xs[75], 10)
    assert (got["s"].n_rows, got["s"].n_nulls, got["s"].min_value, got["s"].mean) == (101, 34, "b", None)


def test_quartiles_come_from_ranges_and_not_from_one_task(spark):
    """As Spark's own percentile over several ranges: a hot value, few and no values, negative ones; no task gathers a column."""
    rows = [(float(i * 37 % 101) - 50.5, 7 if i % 3 else i, None, i if i < 2 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "x double, k int, e double, two int")
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = quality.summarise(df, df.columns)
        assert "percentile" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
        got = {r.column_name: (r.q1, r.median, r.q3) for r in out.collect()}
        want = {c: df.select(*[F.percentile(c, F.lit(p)) for p in (0.25, 0.5, 0.75)]).first() for c in df.columns}
        assert got == {c: tuple(r) for c, r in want.items()}
        assert quality.summarise(df.limit(0), ["x"]).count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_years_of_any_length_are_read(spark):
    from tierwork.operators.rules import RULE_TARGETS, finish_rules

    texts = ["a 4 year plan", "11 Years", "10years", "no time", "1 yea"]
    df = spark.createDataFrame([(t,) for t in texts], "description string")
    for c in RULE_TARGETS:
        df = df.withColumn(c, F.lit("Not Assigned"))
    got = {r.description: (r.duration, r.mrr_ratio) for r in finish_rules(df).collect()}
    assert got == {"A 4 YEAR PLAN": ("4.00 YR", 48.0), "11 YEARS": ("11.00 YR", 132.0), "10YEARS": ("10.00 YR", 120.0),
                   "NO TIME": ("Not Assigned", 0.0), "1 YEA": ("1.00 YR", 12.0)}


def test_large_quantities_unfold_whole(spark):
    df = spark.createDataFrame([(1, 2500.9), (2, 1000.0), (3, 1001.0), (4, 0.5), (5, None)], "k long, q double")
    got = lookups.explode_quantity(df, "q").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("unit_no").alias("d"), F.max("unit_no").alias("m"))
    assert values(got) == [(1, 2500, 2500, 2500), (2, 1000, 1000, 1000), (3, 1001, 1001, 1001)]


def test_stacked_quantities_unfold_to_final_rows(spark):
    """As many lines per unit as plain unfolding counts, without a grouping behind it; nulls, fractions, equal and large quantities."""
    rows = [(1, 3.0, 5), (1, 3.7, None), (1, 1.0, 2), (1, 0.5, 9), (2, 2500.0, 1), (2, 999.0, 1), (2, 1000.0, 1), (None, 2.0, 4), (None, None, 4), (3, -1.0, 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "k long, q double, v long")
    out = lookups.explode_quantity(lookups.stacked_quantities(df, ["k"], "q", {"n": F.count(F.lit(1)), "v": F.sum("v")}), "units", after="fewer")
    plain = lookups.explode_quantity(df, "q").groupBy("k", "unit_no").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("v"))
    cols = ["k", "unit_no", "n", "v"]
    assert sorted(map(str, out.select(cols).collect())) == sorted(map(str, plain.select(cols).collect()))


def test_serial_expansion_groups_nothing_behind_the_units(spark):
    from tierwork.plans import QUERIES

    for name in ("serial_expansion", "explode_quantity"):
        text = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "explode" in text and "Aggregate" not in text[:text.index("Generate explode")], text


def test_mapped_columns_fill_missing_source(spark):
    df = spark.createDataFrame([(1, "a")], "x long, y string")
    assert values(df.select(*columns.mapped_columns({"p": "y", "q": None}))) == [("a", "NaN")]


def test_name_cleaning_refuses_collisions(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` long, `a-b` long")
    with pytest.raises(ValueError):
        columns.clean_column_names(df)
    assert X.snake_name("  Customer -- No. ") == "customer_no"
    assert X.parquet_name("Line No; (x)") == "LineNox"


def test_current_rows_need_the_flag(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id long, cur boolean")
    assert values(cdc.current_rows(df, "cur")) == [(1, True)]
    with pytest.raises(Exception):
        cdc.current_rows(df).collect()


def test_only_exact_placeholder_is_dropped(spark):
    df = spark.createDataFrame([(1, "NaN"), (2, "XNaN"), (3, "C1")], "id long, code string")
    assert [r.id for r in mastering.with_customer_number(df, "code").orderBy("id").collect()] == [2, 3]


def test_row_hash_tells_moved_values_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert df.select(row_hash([F.col("x"), F.col("y")]).alias("h")).distinct().count() == 3
    odd = [("a~", "b"), ("a", "~b"), ("a:1", "b"), ("a", ":1b"), (None, "a"), ("a", None), ("", "a"), ("-", None), (None, "-"), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(odd, "x string, y string")
    assert df.select(row_hash([F.col("x"), F.col("y")]).alias("h")).distinct().count() == len(odd)
    assert readers.extract_keys(df, ["x", "y"]).select("key_hash").distinct().count() == len(odd)


def test_exclude_patterns_keeps_null(spark):
    df = spark.createDataFrame([("IC-1",), ("x",), (None,)], "s string")
    assert df.where(exclude_patterns(F.col("s"), ["IC-%"])).count() == 2


# --- master records -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_best_record_equals_sorting_every_group(spark, seed):
    """Drawn rows: null and equal times, placeholder keys, names that repeat within a key and across tenants."""
    rng = random.Random(seed)
    rows = [
        (n, str(rng.randint(1, 300)), rng.choice(["NaN", "N/A", "c1", "c2", "c3"]), rng.choice("pq"), rng.choice([None, dt.datetime(2001, 1, rng.randint(1, 5))]),
         rng.choice([None, "Birch", "birch", "Birch AG", f"own {n}"])) for n in range(400)]
    age = lambda r: (r[4] is None, -r[4].timestamp() if r[4] else 0, r[1])
    want = {}
    for key in {r[2:4] for r in rows}:
        mine = sorted((r for r in rows if r[2:4] == key), key=age)
        want[key] = (age(mine[0]), list(dict.fromkeys(r[5] for r in sorted(mine, key=lambda r: (*age(r), r[5] or "")) if r[5])))
    df = spark.createDataFrame(rows, "id long, account string, number string, tenant string, modified timestamp, name string")
    got = mastering.best_record(df, ["number", "tenant"], "modified", "account", "name").collect()
    assert len(got) == len(want)
    for r in got:
        best, names = want[r.number, r.tenant]
        assert age(tuple(r)) == best and r.all_names == names


def test_parent_child_points_to_first_by_priority(spark):
    df = spark.createDataFrame([(1, "k", "SystemDE"), (2, "k", "SystemUK"), (3, "k", "other"), (4, None, "x"), (5, None, "x")], "id long, k string, src string")
    got = mastering.parent_child(df.where("k is not null"), "id", ["k"], ["id"], F.lit(0), "src", {"uk": 1, "de": 2})
    assert {r.id: r.parent_id for r in got.collect()} == {1: 2, 2: None, 3: 2}
    prof = mastering.duplicate_profile(df, ["k"], ["id"], F.lit(0))
    assert {r.id: (r.row_number, r.occurrence) for r in prof.collect()} == {1: (1, 3), 2: (2, 3), 3: (3, 3), 4: (1, 2), 5: (2, 2)}


def test_hierarchy_depth_cycle_and_dangling_parent(spark):
    chain = [(i, i - 1 if i else None) for i in range(40)] + [(100, 99)]
    df = spark.createDataFrame(chain, "id long, up long")
    got = {r.id: (r.root, r.depth) for r in resolve_root(df, "id", "up").collect()}
    assert got[39] == (0, 39) and got[0] == (0, 0) and got[100] == (100, 0)
    with pytest.raises(ValueError):
        root_paths(spark.createDataFrame([(1, 2), (2, 1)], "id long, up long"), "id", "up")
    levels = flatten_levels(df.where("id < 3"), "id", "up", 3)
    assert values(levels) == [(0, 0, 0, 0), (1, 0, 1, 1), (2, 0, 1, 2)]
    with pytest.raises(Exception, match="more than 3 levels"):
        flatten_levels(df.where("id < 4"), "id", "up", 3).collect()


def test_deep_chain_two_parents_and_a_tail_into_a_cycle(spark):
    deep = spark.createDataFrame([(i, i - 1 if i else None) for i in range(1000)], "id long, up long")
    assert {r.depth for r in resolve_root(deep, "id", "up").where("id = 999").collect()} == {999}
    two = spark.createDataFrame([(1, None), (2, None), (3, 1), (3, 2), (4, 3)], "id long, up long")
    assert sorted(tuple(r.path) for r in root_paths(two, "id", "up").collect()) == [(1,), (2,), (3, 1), (3, 2), (4, 3, 1), (4, 3, 2)]
    with pytest.raises(ValueError):
        root_paths(spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 4), (6, None)], "id long, up long"), "id", "up")


# --- running values: every split gives the same answer ---------------------------------------------------------------

@pytest.fixture
def ranges_stay(spark):
    """Small tables keep several ranges."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, before)


def test_ranges_split_a_key_with_half_the_rows(spark, ranges_stay):
    df = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("t"))
    got = ordered.running(df, ["k"], ["t"], None, {"rn": ordered.rank()})
    assert got.where("k = 0").agg(F.max("rn"), F.countDistinct("rn")).first()[:] == (2000, 2000)
    per = df.repartitionByRange("k", "t").groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count"), F.avg("count")).first()
    assert per[0] <= 2 * per[1]


@pytest.mark.parametrize("width", [1, 7, 1000, None])
def test_running_equals_plain_windows(spark, ranges_stay, width):
    from pyspark.sql import Window

    rng = random.Random(width or 0)
    rows = [(rng.choice(["hot", "hot", "a", None]), i, rng.choice([None, rng.randint(0, 9)])) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    got = ordered.running(df, ["k"], ["t"], width and ordered.by_width("t", width), {
        "rn": ordered.rank(), "total": ordered.running_sum(F.col("v")), "top": ordered.running_max(F.col("v")),
        "prev": ordered.previous(F.col("v"), -1), "next": ordered.following(F.col("t")), "last": ordered.last_seen(F.col("v")),
        "n": ordered.group_size(),
    })
    w = Window.partitionBy("k").orderBy("t")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "*", F.row_number().over(w).cast("long").alias("rn"), F.sum("v").over(upto).alias("total"), F.max("v").over(upto).alias("top"),
        F.when(F.row_number().over(w) == 1, -1).otherwise(F.lag("v").over(w)).cast("long").alias("prev"), F.lead("t").over(w).alias("next"),
        F.last("v", True).over(upto).alias("last"), F.count(F.lit(1)).over(Window.partitionBy("k")).alias("n"))
    assert values(got) == values(want)


def test_group_stats_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 5), ("a", 2)], "k string, v long")
    assert values(ordered.with_group_stats(df, ["k"], nullable_keys=True, top=F.max("v"))) == [("a", 2, 2), (None, 1, 5), (None, 5, 5)]


# --- merges and history ----------------------------------------------------------------------------------------------

SNAP = "k long, v string, hash string, cur boolean, ins long"


def test_merge_upsert_cases_and_idempotence(spark):
    target = spark.createDataFrame([(1, "a", "h1", True, 0), (2, "b", "h2", True, 0), (3, "c", "h3", True, 0), (4, "d", "h4", True, 0)], SNAP)
    source = spark.createDataFrame([(1, "a", "h1", True, 9), (2, "B", "H2", True, 9), (3, "x", "h3", False, 9), (5, "e", "h5", True, 9)], SNAP)
    args = (["k"], "hash", "cur", ["ins"])
    once = cdc.merge_upsert(target, source, *args)
    assert values(once) == [
        (1, "a", "h1", True, 0), (2, "B", "H2", True, 0), (3, "c", "h3", False, 0), (4, "d", "h4", False, 0), (5, "e", "h5", True, 9)]
    assertDataFrameEqual(cdc.merge_upsert(once, source, *args), once)
    forced = cdc.merge_upsert(target, source, *args, force=True)
    assert (3, "x", "h3", False, 0) in values(forced)


def test_merge_current_adds_a_new_row_for_a_returning_key(spark):
    target = spark.createDataFrame([(1, "a", "h1", False, 0), (2, "b", "h2", True, 0)], SNAP)
    source = spark.createDataFrame([(1, "z", "hz", True, 9)], SNAP)
    got = cdc.merge_current(target, source, ["k"], "hash", "cur", ["ins"])
    assert values(got) == [(1, "a", "h1", False, 0), (1, "z", "hz", True, 9), (2, "b", "h2", False, 0)]


def test_soft_delete_and_return(spark):
    target = spark.createDataFrame([(1, True), (2, False), (3, False)], "k long, is_deleted boolean")
    keys = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    assert values(cdc.soft_delete(target, keys, ["k"])) == [(1, False), (2, False), (3, True)]


def test_versions_do_not_overlap(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 3), rng.choice("xyz"), dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(120)]
    log = spark.createDataFrame(rows, "k long, hash string, ts timestamp")
    got = history.versions_from_log(log, "k", "hash", "ts").collect()
    for k in range(4):
        mine = sorted((r.start_datetime, r.end_datetime, r.hash) for r in got if r.k == k)
        assert all(a[1] == b[0] and a[2] != b[2] for a, b in zip(mine, mine[1:]))
        assert mine[-1][1] == history.OPEN_END
        # every log row lies in a version with its hash
        for kk, h, ts in rows:
            if kk == k:
                assert [m[2] for m in mine if m[0] <= ts < m[1]] == [h]


def test_apply_log_closes_and_keeps_one_current(spark):
    day = [dt.datetime(2024, 1, d) for d in range(1, 8)]
    log1 = spark.createDataFrame([(1, "x", day[0]), (1, "y", day[1]), (2, "x", day[0])], "k long, hash string, ts timestamp")
    dim = history.versions_from_log(log1, "k", "hash", "ts").withColumn(
        "is_current", (F.col("end_datetime") == F.lit(history.OPEN_END)).cast("int"))
    log2 = spark.createDataFrame([(1, "y", day[2]), (1, "z", day[3]), (2, "x", day[2]), (3, "q", day[4])], "k long, hash string, ts timestamp")
    out = history.apply_log(dim, log2, "k", "hash", "ts")
    got = {(r.k, r.hash, r.start_datetime, r.end_datetime, r.is_current) for r in out.collect()}
    end = history.OPEN_END
    assert got == {(1, "x", day[0], day[1], 0), (1, "y", day[1], day[3], 0), (1, "z", day[3], end, 1), (2, "x", day[0], end, 1), (3, "q", day[4], end, 1)}


def test_log_in_parts_equals_the_whole_log_with_returns_and_ties(spark):
    rng = random.Random(11)
    rows = [(rng.randint(0, 4), rng.choice("xyz"), dt.datetime(2023, 5, 1) + dt.timedelta(hours=rng.randint(0, 40)), i) for i in range(150)]
    schema = "k long, hash string, ts timestamp, no long"
    whole = history.versions_from_log(spark.createDataFrame(rows, schema), "k", "hash", "ts", ["no"])
    rows.sort(key=lambda r: (r[2], r[3]))
    dim = whole.limit(0).withColumn("is_current", F.lit(1))
    for cut in (40, 90, 150):
        dim = history.apply_log(dim, spark.createDataFrame(rows[max(0, cut - 60):cut], schema), "k", "hash", "ts", ["no"])
    assert values(dim.drop("is_current").select(whole.columns)) == values(whole)
    assert dim.where("is_current = 1").count() == len({r[0] for r in rows})


def test_point_in_time_and_unknown(spark):
    dim = spark.createDataFrame([(1, 10, dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)), (1, 11, dt.datetime(2021, 1, 1), None)],
                                "k long, pk long, start_datetime timestamp, end_datetime timestamp")
    fact = spark.createDataFrame([(1, dt.datetime(2019, 1, 1)), (1, dt.datetime(2021, 1, 1)), (2, dt.datetime(2021, 1, 1)), (1, dt.datetime(2020, 6, 1))], "k long, t timestamp")
    got = history.point_in_time(fact, dim, "k", "t", "pk", "fk")
    assert sorted(r.fk for r in got.collect()) == [-1, -1, 10, 11]
    assert sorted(r.fk for r in history.fallback_earliest(got, dim, "k", "pk", "fk").collect()) == [-1, 10, 10, 11]


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_runs_of_a_log_over_any_number_of_ranges(spark, ranges):
    """Keys over many ranges, ranges of one run, ranges of many keys: the same runs as by walking the log."""
    rng = random.Random(ranges)
    t0 = dt.datetime(2024, 1, 1)
    rows = [(rng.choice(["hot"] * 6 + ["a", "b", "c", "d", None]), t0 + dt.timedelta(seconds=rng.randint(0, 300)), n, rng.choice("xxxxxy") if n % 400 < 250 else "x") for n in range(1200)]
    want, runs = {}, {}
    for k, ts, n, h in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        if runs.get(k) is None or runs[k][1] != h:
            if k in runs:
                want[k, runs[k][0]] = ts
            runs[k] = (n, h)
            want[k, n] = None
    log = spark.createDataFrame(rows, "k string, ts timestamp_ntz, no long, hash string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for name, v in (("spark.sql.shuffle.partitions", str(ranges)), ("spark.sql.adaptive.coalescePartitions.enabled", "false"), ("spark.sql.execution.arrow.maxRecordsPerBatch", "7")):
            spark.conf.set(name, v)
        got = history.log_runs(log, "k", "hash", "ts", ["no"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.k, r.no): r["__next"] for r in got} == want
    assert history.log_runs(log.limit(0), "k", "hash", "ts").count() == 0


def test_surrogates_skip_reserved_member(spark):
    have = spark.createDataFrame([(-1,)], "pk long")
    new = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "code string, n long")
    got = history.surrogate_keys(new, ["n"], ordered.by_width("n", 2), have, "pk")
    assert {r.code: r.pk for r in got.collect()} == {"a": 1, "b": 2, "c": 3}


def test_closure_of_many_ways_up_and_few_nodes(spark):
    """20 layers of two nodes, each below both nodes of the layer above: 2^20 ways, 40 nodes."""
    edges = [(f"{layer}{a}", f"{layer - 1}{b}") for layer in range(1, 21) for a in "xy" for b in "xy"]
    df = spark.createDataFrame([*edges, edges[0], ("0x", None), (None, "0y")], "n string, p string")
    got = {(r.n, r.ancestor): r.depth for r in hierarchy.closure(df, "n", "p").collect()}
    assert got == {(f"{i}{a}", f"{j}{b}"): i - j for i in range(21) for j in range(i) for a in "xy" for b in "xy"}
    short = spark.createDataFrame([("c", "b"), ("b", "a"), ("c", "a")], "n string, p string")
    assert {(r.n, r.ancestor): r.depth for r in hierarchy.closure(short, "n", "p").collect()} == {("c", "b"): 1, ("b", "a"): 1, ("c", "a"): 1}
    assert hierarchy.closure(df.limit(0), "n", "p").count() == 0
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "n string, p string"), "n", "p")


def test_closure_stores_each_pair_once(spark, monkeypatch):
    """Depths that are no powers of two, two ways of different length; what the rounds store adds up to the result."""
    stored = []
    for name in ("cut_lineage", "stored"):
        real = getattr(hierarchy, name, None)
        monkeypatch.setattr(hierarchy, name, lambda df, real=real: stored.append(real(df)) or stored[-1], raising=False)
    edges = [(i, i // 2) for i in range(1, 200)] + [(i, i // 3) for i in range(1, 200)] + [(i, 1000 + i % 5) for i in range(1, 200)]
    got = {(r.n, r.ancestor): r.depth for r in hierarchy.closure(spark.createDataFrame(edges, "n int, p int"), "n", "p").collect()}
    want, level, depth = {}, {(n, p) for n, p in edges}, 1
    while level:
        want |= {pair: depth for pair in level if pair not in want}
        level, depth = {(n, p) for n, a in level for m, p in edges if m == a}, depth + 1
    assert got == want
    rows = sum(df.count() for df in stored)
    assert rows == len(got), (rows, len(got))


def test_described_levels_and_what_they_refuse(spark):
    edges = spark.createDataFrame([("c", "b"), ("b", "a"), ("d", "a"), ("a", None)], "n string, p string")
    texts = spark.createDataFrame([("a", "top"), ("c", "leaf")], "code string, text string")
    got = {r.n: tuple(r)[1:] for r in hierarchy.described_levels(edges, "n", "p", texts, "code", "text", 3).collect()}
    assert got == {"a": ("a", "a", "a", "top", "top", "top"), "b": ("a", "b", "b", "top", None, None), "c": ("a", "b", "c", "top", None, "leaf"), "d": ("a", "d", "d", "top", None, None)}
    for more in ([("c", "d")], [("e", "c")]):  # two nodes of one level above c; a fourth level
        with pytest.raises(Exception, match="more than one node a level"):
            hierarchy.described_levels(edges.union(spark.createDataFrame(more, "n string, p string")), "n", "p", texts, "code", "text", 3).collect()


def test_survivorship_with_conflicts_and_gaps(spark):
    day = lambda d: dt.datetime(2024, 1, d)
    rows = spark.createDataFrame([
        (1, "a", day(1), "old", None), (1, "a", day(2), "new", None), (1, "b", day(9), "other", 5), (2, "a", day(1), " ", 1), (2, "b", day(1), "N/A", 2), (2, "b", None, "dated nowhere", 3),
        (3, "c", day(1), "unlisted", 7), (4, "b", day(1), "z", 1), (4, "b", day(1), "y", 2), (None, "a", day(1), "no key", 1), (5, None, day(1), "no source", 1)],
        "k long, source string, changed timestamp, name string, n int")
    got = {r.k: tuple(r)[1:] for r in staging.survive(rows, ["k"], "source", "changed", {"name": ("a", "b"), "n": ("b", "c", "a")}).collect()}
    assert got == {
        1: ("new", "a", 5, "b"), 2: ("dated nowhere", "b", 2, "b"), 3: (None, None, 7, "c"), 4: ("y", "b", 1, "b"), 5: (None, None, None, None)}
    assert staging.survive(rows.limit(0), ["k"], "source", "changed", {"name": ("a",)}).count() == 0


def test_a_shape_refuses_columns_it_does_not_have(spark):
    shape = T.StructType([T.StructField("document_source", T.StringType()), T.StructField("code", T.StringType()), T.StructField("amount", T.DoubleType())])
    df = spark.createDataFrame([(1, None)], "x long, y string")
    assert tuple(staging.in_shape(df, "s", shape, {"code": "y"}).first()) == ("s", "N/A", None)
    with pytest.raises(ValueError, match="not in the shape"):
        staging.in_shape(df, "s", shape, {"cod": "y"})


# --- matching: the segment join finds exactly what comparing everything finds ----------------------------------------

def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def _noisy_texts(seed, letters="abc", most=14):
    rng = random.Random(seed)
    base = [rng.choice(["", "ac-"]) + "".join(rng.choice(letters) for _ in range(rng.randint(1, most))) for _ in range(60)]

    def noisy(s):
        out = list(s)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(out))
            out[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        return "".join(out)

    return sorted({noisy(s) for s in base} | set(base)), sorted({noisy(s) for s in base})


@pytest.mark.parametrize(("pct", "letters", "most"), [(40, "abc", 14), (60, "abc", 14), (75, "ab", 14), (80, "abc", 30), (90, "abcdefgh", 60), (100, "abc", 14)])
def test_similar_texts_equal_brute_force(spark, monkeypatch, pct, letters, most):
    left, right = _noisy_texts(pct * 31, letters, most)
    a = spark.createDataFrame([("k", s) for s in left], "control string, a string")
    b = spark.createDataFrame([("k", s) for s in right], "control string, b string")
    far = {(x, y): (_distance(x, y), max(len(x), len(y))) for x, y in itertools.product(left, right) if x and y}
    want = {p: d / n for p, (d, n) in far.items() if (n - d) * 100 >= pct * n}
    assert {(r.a, r.b) for r in matching.similar_texts(a, b, pct).collect()} == set(want)
    best = {}
    for (x, y), share in sorted(want.items(), key=lambda kv: (kv[1], kv[0][1])):
        best.setdefault(x, y)
    monkeypatch.setattr(matching, "FIRST_EDITS", 1)  # several rounds
    got = matching.closest_texts(a.withColumn("pct", F.lit(pct)), b.withColumn("pct", F.lit(pct))).collect()
    assert {r.a: r.b for r in got} == best and all(r.similarity == pytest.approx(1 - want[r.a, r.b]) for r in got)


def test_names_that_share_most_characters_are_ruled_out_by_bits(spark, monkeypatch):
    """Names that differ by digits only have no rare pieces; the bits lose no near pair and let few others through. Cells change nothing."""
    names = [f"customer#{n:09d}" for n in random.Random(5).sample(range(300_000), 240)]
    known = [n.replace("er#", "er ") if i % 5 == 0 else n for i, n in enumerate(names[120:])]
    a = matching._with_bits(spark.createDataFrame([("k", x, False) for x in names[:120]], "control string, a string, few boolean"), "a", "x").drop("few")
    b = matching._with_bits(spark.createDataFrame([("k", x, False) for x in known], "control string, b string, few boolean"), "b", "y").drop("few")
    met = {(r.a, r.b) for r in a.join(b, "control").where(matching._may_be_near(F.lit(2))).select("a", "b").collect()}
    far = {(x, y): _distance(x, y) for x, y in itertools.product(names[:120], known)}
    assert {p for p, d in far.items() if d <= 2} <= met and len(met) < 0.1 * len(far)
    monkeypatch.setattr(matching, "FEW_TEXTS", 0)
    monkeypatch.setattr(matching, "CELL_PAIRS", 50)
    got = matching.closest_texts(a.select("control", "a", F.lit(80).alias("pct")), b.select("control", "b", F.lit(80).alias("pct"))).collect()
    want = {x: min((far[x, y], y) for y in known) for x in names[:120]}
    assert {r.a: r.b for r in got} == {x: y for x, (d, y) in want.items() if d <= 3}


def test_closest_texts_keep_controls_apart_and_their_thresholds(spark):
    a = spark.createDataFrame([("x", "abcdefghij", 90), ("y", "abcdefghij", 50), ("z", "abc", 50), ("x", "", 90), (None, "abc", 50)], "control string, a string, pct int")
    b = spark.createDataFrame([("x", "abcdefgh", 90), ("y", "abcdefgh", 50), ("y", "bcdefghi", 50), ("w", "abc", 50), ("y", "", 50)], "control string, b string, pct int")
    got = matching.closest_texts(a, b).collect()
    assert [(r.control, r.b, round(r.similarity, 2)) for r in got] == [("y", "abcdefgh", 0.8)]
    assert matching.closest_texts(a.limit(0), b).count() == 0 and matching.closest_texts(a, b.limit(0)).count() == 0


def test_bits_count_how_often_a_gram_occurs(spark):
    """Texts of the same characters and few different grams: not near by the number of their grams."""
    a, b = "aabb" * 5, "ab" * 10
    x = matching._with_bits(spark.createDataFrame([("k", a, False)], "control string, a string, few boolean"), "a", "x").drop("few")
    y = matching._with_bits(spark.createDataFrame([("k", b, False), ("k", a[1:], False)], "control string, b string, few boolean"), "b", "y").drop("few")
    assert [r.b for r in x.join(y, "control").where(matching._may_be_near(F.lit(2))).collect()] == [a[1:]]


@pytest.mark.parametrize(("pct", "letters", "most"), [(40, "abc", 14), (70, "abcdefgh", 40)])
def test_closest_texts_in_blocks_equal_brute_force(spark, monkeypatch, pct, letters, most):
    """Cells that go over several batches, blocks and tasks, of several controls, change nothing."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        for name, value in {"FEW_TEXTS": 3, "JOINED_PAIRS": 0, "BLOCK_PAIRS": 16, "CELL_PAIRS": 100, "FIRST_EDITS": 1}.items():
            monkeypatch.setattr(matching, name, value)
        sides = {k: _noisy_texts(pct + len(k), letters, most) for k in ("k", "kk")} | {"few": (["abcabc", "x"], ["abcab", "bcabc", "y"])}
        frame = lambda side, c: spark.createDataFrame([(k, t) for k, v in sides.items() for t in v[side]], f"control string, {c} string").withColumn("pct", F.lit(pct))
        got = {(r.control, r.a): (r.b, round(r.similarity, 9)) for r in matching.closest_texts(frame(0, "a"), frame(1, "b")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for k, (left, right) in sides.items():
        for x in filter(None, left):
            far = [(_distance(x, y) / max(len(x), len(y)), y) for y in filter(None, right)]
            share, y = min((round(share, 9), y) for share, y in far)
            if share * 100 <= 100 - pct:
                want[k, x] = (y, round(1 - share, 9))
    assert got == want


def test_a_likely_partner_leaves_one_round(spark, monkeypatch):
    """Texts whose best partner is 6 and more edits away do not look for nearer ones round after round."""
    rng = random.Random(3)
    texts = sorted("".join(rng.choice(["th", "e", "on", "r", "wh", "ti"]) for _ in range(24)) for _ in range(90))
    known = [t[:20].replace("th", "ht") + t[21:] for t in texts]
    rounds, real = [], matching._near_pairs
    monkeypatch.setattr(matching, "JOINED_PAIRS", 0)
    monkeypatch.setattr(matching, "_near_pairs", lambda *a: rounds.append(a[4]) or real(*a))
    got = matching.closest_texts(
        spark.createDataFrame([("k", t, 70) for t in texts], "control string, a string, pct int"), spark.createDataFrame([("k", t, 70) for t in known], "control string, b string, pct int")).collect()
    far = {x: min((round(_distance(x, y) / max(len(x), len(y)), 9), y) for y in known) for x in texts}
    assert {r.a: r.b for r in got} == {x: y for x, (share, y) in far.items() if share <= 0.3} and len(got) == 90
    assert any(share > 0.15 for share, _ in far.values()) and len(rounds) == 1


def test_cascade_order_codes_and_provenance(spark):
    facts = spark.createDataFrame([
        (1, "SKU1", "Acme"), (2, "SKU2", "Acmee Ltd"), (3, "SKU2", "other"), (4, "NaN", "NaN"), (5, "SKU9", "Acme"), (6, None, "Acme"),
    ], "id long, sku string, vendor string")
    lookup = spark.createDataFrame([("sku1", "acme", "t1"), ("sku2", "acme ltd", "t2"), ("sku2", "acmee lt", "t3"), ("nan", "nan", "t4")], "code string, vendor_code string, kind string")
    passes = [matching.MatchPass("sku", "vendor", "code", "vendor_code"), matching.MatchPass("sku", "vendor", "code", "vendor_code", (90, 80))]
    got = {r.id: (r.is_matched, r.matched_type, r.kind) for r in matching.match_cascade(facts, lookup, passes, ["kind"]).collect()}
    assert got[1] == (1, "mt=sku|vendor", "t1")
    # both are 1 edit of 9 away (0.89); the smaller text wins
    assert got[2] == (2, "mt=sku|vendor:th=0.8:lv=0.89", "t2")
    assert got[3][0] == got[4][0] == got[5][0] == got[6][0] == 0
    last = [matching.MatchPass("sku", "vendor", "code", "vendor_code", keep_missing=True)]
    assert {r.id: r.is_matched for r in matching.match_cascade(facts, lookup, last, ["kind"]).collect()}[4] == 1


# --- finance ---------------------------------------------------------------------------------------------------------

def test_gap_fill_does_not_leak_between_entities(spark):
    rates = spark.createDataFrame([("A", dt.date(2024, 1, 1), 2.0), ("B", dt.date(2024, 3, 1), 3.0)], "e string, m date, rate double")
    got = finance.fill_gaps(rates, "e", "m", ["rate"], F.lit(dt.date(2024, 1, 1)), F.lit(dt.date(2024, 3, 1)))
    assert [(r.e, r.rate) for r in got.orderBy("e", "m").collect()] == [("A", 2.0)] * 3 + [("B", None), ("B", None), ("B", 3.0)]


def test_ytd_to_monthly_sums_back_and_closes(spark):
    ytd = spark.createDataFrame([(1, 2024, 1, 10), (1, 2024, 2, 30), (1, 2024, 4, 25), (2, 2024, 12, 7)], "k long, fy int, p int, amt long")
    got = finance.ytd_to_monthly(ytd, ["k", "fy"], "p", "amt")
    assert values(got.select("k", "p", "amt")) == [(1, 1, 10), (1, 2, 20), (1, 4, -5), (1, 5, -25), (2, 12, 7)]


def test_allocation_adds_up(spark):
    lines = spark.createDataFrame([("d1", 1, 30), ("d1", 2, 70), ("d2", 1, 0), ("d2", 2, 0), ("d3", 1, 5)], "doc string, line long, w long")
    gap = spark.createDataFrame([("d1", 10), ("d2", 9), ("d3", 0), ("d4", 3)], "doc string, gap long")
    got = finance.allocate(gap, lines, ["doc"], "w")
    assert {(r.doc, r.line): round(r.allocated, 9) for r in got.collect()} == {("d1", 1): 3, ("d1", 2): 7, ("d2", 1): 4.5, ("d2", 2): 4.5}


def test_deferred_limits(spark):
    d = dt.date
    rows = [(1, d(2024, 1, 15), d(2024, 4, 15), 90), (2, d(2024, 1, 15), d(2024, 7, 15), 90), (3, d(2024, 1, 1), d(2034, 2, 1), 90), (4, d(2024, 2, 1), d(2024, 1, 1), 90), (5, d(2024, 1, 1), None, 90)]
    df = spark.createDataFrame(rows, "id long, s date, e date, amt long").withColumn("amt", F.col("amt").cast("decimal(18,2)"))
    got = finance.spread_deferred(df, "s", "e", "amt")
    n = {r.id: r.n for r in got.groupBy("id").agg(F.count("*").alias("n")).collect()}
    assert n == {1: 1, 2: 6, 3: 1, 4: 1, 5: 1}
    assert {(r.s, float(r.amt)) for r in got.where("id = 2").collect()} == {(d(2024, m, 1), 15.0) for m in range(1, 7)}


def test_day_rate_same_direct_reverse(spark):
    d = dt.date(2024, 1, 1)
    rates = spark.createDataFrame([(d, "GBP", "EUR", 1.25)], "rate_date date, from_currency string, to_currency string, rate double")
    fact = spark.createDataFrame([(d, "EUR", "EUR"), (d, "GBP", "EUR"), (d, "EUR", "GBP"), (d, "USD", "EUR")], "d date, s string, t string")
    assert sorted([r.day_rate for r in finance.day_rate(fact, rates, "d", "s", "t").collect()], key=str) == sorted([1.0, 1.25, 0.8, None], key=str)


# --- dates -----------------------------------------------------------------------------------------------------------

def _week(d):
    first = dt.date(d.year, 1, 1)
    while first.weekday() != 5:
        first += dt.timedelta(days=1)
    return _week(dt.date(d.year - 1, 12, 31)) if d < first else (d - first).days // 7 + 1


def test_company_week_over_30_years(spark):
    days = spark.sql("select explode(sequence(date '2000-01-01', date '2029-12-31', interval 1 day)) as d")
    for r in days.select("d", D.company_week(F.col("d")).alias("w"), F.dayofweek(D.company_week_start(F.col("d"))).alias("s")).collect():
        assert r.w == _week(r.d) and r.s == 7


def test_fiscal_calendar_round_trip(spark):
    df = spark.sql("select explode(sequence(date '2020-01-01', date '2024-12-01', interval 1 month)) as m")
    back = D.fiscal_to_calendar(D.fiscal_year(F.col("m")), D.fiscal_period(F.col("m")))
    assert df.where(back != F.col("m")).count() == 0
    assert spark.range(1).select(D.fiscal_to_calendar(F.lit(2021), F.lit(1)).alias("m")).first().m == dt.date(2020, 4, 1)


def test_cut_off(spark):
    def cut(*day):
        return spark.range(1).select(D.ledger_cut_off(F.lit(dt.date(*day)), {dt.date(2024, 10, 1): dt.date(2024, 10, 1)}).alias("d")).first().d

    assert cut(2024, 3, 13) == dt.date(2024, 1, 31)
    assert cut(2024, 3, 14) == dt.date(2024, 2, 29)
    assert cut(2024, 10, 2) == dt.date(2024, 9, 30)


def test_period_bounds():
    assert D.period_bounds(None, False, dt.date(2024, 1, 10)) == (dt.date(2023, 12, 1), dt.date(2024, 1, 1))
    assert D.period_bounds(None, False, dt.date(2024, 1, 11)) == (dt.date(2024, 1, 1), dt.date(2024, 2, 1))
    assert D.period_bounds("2024-05", True, dt.date(2024, 1, 11)) == (dt.date(2024, 1, 1), dt.date(2025, 1, 1))


# --- comparison, reports, storage ------------------------------------------------------------------------------------

def test_diff_with_itself_is_all_equal(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, None), (None, "c", 0.0)], "k long, s string, n double")
    got = quality.dataset_diff(df, df, ["k"], ["s", "n"], {"n": 0.05})
    assert {r.comparison_status for r in got.collect()} == {"EXACT_MATCH"} and got.count() == 3


def test_diff_zero_base_and_one_sided_null(spark):
    a = spark.createDataFrame([(1, 0.0), (2, None), (3, 100.0), (4, 1.0)], "k long, n double")
    b = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, 104.0), (5, 1.0)], "k long, n double")
    got = {r.k: r.comparison_status for r in quality.dataset_diff(a, b, ["k"], ["n"], {"n": 0.05}).collect()}
    assert got == {1: "DIFFERENT_VALUES", 2: "DIFFERENT_VALUES", 3: "EXACT_MATCH", 4: "ONLY_IN_DF1", 5: "ONLY_IN_DF2"}


def test_reconcile_counts_like_except_all(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "s string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "s string")
    r = quality.reconcile(a, b).first()
    assert (r.except_all_left, r.except_all_right) == (a.exceptAll(b).count(), b.exceptAll(a).count()) == (2, 1)
    assert (r.subtract_left, r.subtract_right) == (a.subtract(b).count(), b.subtract(a).count()) == (1, 1)


def test_report_rows_with_only_placeholders_left_over(spark):
    a = spark.createDataFrame([("DE", dt.date(2024, 1, 1), "x", 5)], "c string, d date, lvl string, amt int").withColumn("amt", F.col("amt").cast("decimal(18,2)"))
    got = reports.report_rows(a, a.where("false"), [reports.Line("one", "lvl", "x"), reports.Line("gap"), reports.Line("none", "lvl", "q")], "r", ["c", "d"], "amt")
    assert {(r.order_id, r.c, float(r.revenue)) for r in got.collect()} == {(1, "DE", 5.0), (2, "<placeholder>", 0.0)}


def test_explode_quantity_has_no_cap(spark):
    df = spark.createDataFrame([(1, 25000.0), (2, 0.0), (3, -4.0), (4, 1.0)], "id long, q double")
    assert values(lookups.explode_quantity(df, "q").groupBy("id").count()) == [(1, 25000), (4, 1)]


def test_replace_slice_keeps_null_rows_outside(spark):
    old = spark.createDataFrame([("a", 1), (None, 2)], "e string, v long")
    new = spark.createDataFrame([("a", 9), (None, 8)], "e string, v long")
    assert values(sinks.replace_slice(old, new, F.col("e") == "a")) == [("a", 9), (None, 2)]


def test_publish_version_switches_the_view(spark):
    for v in (1, 2):
        sinks.publish_version(spark.createDataFrame([(v,)], "v long"), "published_demo", v)
        assert spark.table("published_demo").first().v == v
    spark.sql("drop view published_demo")
    for v in (1, 2):
        spark.sql(f"drop table published_demo_v{v}")


def test_load_increment_into_empty_table_takes_all(spark):
    src = spark.createDataFrame([(1, 5), (2, 7)], "id long, ts long")
    assert readers.load_increment(src, src.where("false"), "ts").count() == 2
    assert readers.load_increment(src, src.where("ts = 5"), "ts").count() == 1


def test_malformed_json_and_schema_drift(spark):
    df = spark.createDataFrame([(1, '{"k": 3}'), (2, "oops")], "id long, j string")
    assert values(readers.parse_json(df, "j", "k long")) == [(1, 3), (2, None)]
    both = readers.append_with_drift(spark.createDataFrame([(1,)], "a long"), spark.createDataFrame([(2, "x")], "a long, b string"))
    assert values(both) == [(1, None), (2, "x")]


def test_cast_modes(spark):
    schema = T.StructType([T.StructField("n", T.IntegerType())])
    df = spark.createDataFrame([("1",), ("x",)], "n string")
    assert values(columns.cast_to_schema(df, schema, strict=False)) == [(1,), (None,)]
    with pytest.raises(Exception):
        columns.cast_to_schema(df, schema).collect()


def test_deferred_months_equal_a_date_sequence(spark):
    rng = random.Random(5)
    rows = []
    for i in range(300):
        s = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 700))
        rows.append((i, s, s + dt.timedelta(days=rng.randint(1, 1500)), 100))
    df = spark.createDataFrame(rows, "id long, s date, e date, amt long").withColumn("amt", F.col("amt").cast("decimal(18,2)"))
    got = finance.spread_deferred(df, "s", "e", "amt").where("is_deferred").groupBy("id").agg(
        F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b"))
    want = df.where("months_between(add_months(e, -1), s) > 2").select(
        "id", F.expr("sequence(s, add_months(e, -1), interval 1 month)").alias("m")).select(
        "id", F.size("m").cast("long").alias("n"), F.trunc(F.element_at("m", 1), "MM").alias("a"), F.trunc(F.element_at("m", -1), "MM").alias("b"))
    assert values(got) == values(want)


def test_dated_allocation_adds_up_to_the_gap(spark):
    gap = spark.createDataFrame([("a", 1, 10.0), ("a", 2, -0.01), ("b", None, 7.77), ("c", 1, 0.0), ("d", 1, 5.0)], "doc string, day int, gap double")
    lines = spark.createDataFrame([("a", i, w) for i, w in enumerate((1.0, 1.0, 1.0))] + [("b", 0, 0.0), ("b", 1, 0.0), ("c", 0, 1.0)], "doc string, line int, w double")
    got = finance.allocate_dated(gap, lines, ["doc"], "day", "w", "line").collect()
    sums = {}
    for r in got:
        sums[r.doc, r.day] = sums.get((r.doc, r.day), 0) + r.allocated
    assert {k: float(v) for k, v in sums.items()} == {("a", 1): 10.0, ("a", 2): -0.01, ("b", None): 7.77}
    assert [float(r.allocated) for r in got if r.line is None and r.doc == "a" and r.day == 1] == [0.01]
