"""Levels, layers and stored profiles against plain counting."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tierwork.operators import observations as O
from tierwork.operators import ordered as R
from tierwork.operators import profiles as P

NOW = dt.datetime(2024, 2, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_levels_keep_null_keys_apart_from_absent_ones(spark):
    rnd = random.Random(3)
    data = [(rnd.choice(["a", "b", None]), rnd.choice([1, 2, None]), rnd.choice([None, "NaN", "x"])) for _ in range(200)]
    df = spark.createDataFrame(data, "entity string, day int, v string")
    got = O.observe(df, {"fine": ["entity", "day"], "entity": ["entity"], "all": []}, O.null_and_default({"v": ["NaN"]}))
    want = Counter()
    for e, d, v in data:
        for key in (("fine", e, d), ("entity", e, None), ("all", None, None)):
            want[key] += 1
            want[(*key, "null")] += v is None
            want[(*key, "default")] += v == "NaN"
    fine = {(e, d) for e, d, _ in data}
    assert got.count() == len(fine) + len({e for e, _ in fine}) + 1
    for r in got.collect():
        key = (r.level, r.entity, r.day)
        assert (r.n_rows, r.v_null, r.v_default) == (want[key], want[(*key, "null")], want[(*key, "default")])
    long = O.as_rows(got, ["level", "entity", "day"], ["v_null", "v_default"])
    assert long.count() == 2 * got.count() and set(long.columns) == {"level", "entity", "day", "check_name", "n_hits"}


def test_levels_of_an_empty_table_and_equal_levels(spark):
    empty = spark.createDataFrame([], "entity string, v string")
    got = O.observe(empty, {"entity": ["entity"]}, {"x": F.col("v").isNull()})
    assert got.count() == 0
    with pytest.raises(ValueError, match="same keys"):
        O.observe(empty, {"a": ["entity"], "b": ["entity"]}, {"x": F.col("v").isNull()})


def test_observing_reads_and_shuffles_rows_once(spark):
    df = spark.range(50).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = O.observe(df, {"k": ["k"], "all": []}, {"odd": F.col("v") % 2 == 1})._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range") == 1 and plan.index("Expand") < plan.rindex("Exchange")  # rows are summed before levels unfold


def test_layers_count_codes_and_duplicates(spark):
    raw = spark.createDataFrame([("p", "1"), ("p", "1"), ("q", "1"), ("p", None), ("p", "NaN"), ("q", " ")], "db string, code string")
    empty = raw.where("false")
    got = O.layer_counts({"raw": raw, "none": empty}, ["db"], "code").first()
    assert (got.raw_rows, got.raw_with_code, got.raw_without_code, got.raw_duplicates) == (6, 3, 3, 1)
    assert (got.none_rows, got.none_duplicates) == (0, 0)


def test_coverage_counts_a_partner_once(spark):
    facts = spark.createDataFrame(
        [("1", 5, "Ann"), ("1", -5, "Ann"), ("2", 3, "Bob"), ("3", 4, None), (None, 7, "x"), ("4", None, "Dan")], "k string, a int, n string")
    master = spark.createDataFrame([("1", "Ann"), ("1", "Anna"), ("2", "Rob"), ("4", "Dan")], "k string, m string")
    got = O.revenue_coverage(facts, master, ["k"], "a", "n", "m").first()
    assert (got.inside_with_revenue, got.inside_without_revenue, got.outside_with_revenue, got.outside_without_revenue) == (1, 2, 2, 0)
    assert (got.inside_revenue, got.outside_revenue, got.name_mismatches) == (3.0, 11.0, 1)


def test_reconciled_levels_and_year_to_date(spark):
    left = spark.createDataFrame([("a", 2020, 1, 10), ("a", 2020, 3, 5), ("b", 2020, 1, 0)], "e string, y int, m int, x int")
    right = spark.createDataFrame([("a", 2020, 1, 8), ("c", 2021, 2, 1)], "e string, y int, m int, x int")
    got = O.reconcile_levels(left, right, {"month": ["e", "y", "m"], "total": []}, ["x"])
    month = {(r.e, r.y, r.m): (r.left_amount, r.right_amount, r.difference, r.difference_pct) for r in got.where("level = 'month'").collect()}
    assert month == {("a", 2020, 1): (10, 8, 2, 20.0), ("a", 2020, 3): (5, 0, 5, 100.0), ("b", 2020, 1): (0, 0, 0, None), ("c", 2021, 2): (0, 1, -1, None)}
    assert rows(got.where("level = 'total'").select("left_amount", "right_amount")) == [(15, 9)]
    ytd = O.year_to_date(got.where("level = 'month'"), ["e"], "y", "m", ["left_amount"])
    assert rows(ytd.select("e", "m", "ytd_left_amount")) == [("a", 1, 10), ("a", 3, 15), ("b", 1, 0), ("c", 2, 0)]


def _brute_profile(data, columns):
    out = {}
    for i, c in enumerate(columns):
        vals = [d[i] for d in data]
        per_id = defaultdict(set)
        for d in data:
            per_id[d[0]].add(d[i])
        out[c] = (len(vals), sum(v is not None for v in vals), len({v for v in vals if v is not None}),
                  sum(v is None or not v.strip() for v in vals), sum(len(v - {None}) > 1 for v in per_id.values()))
    return out


def test_stored_runs_add_up_to_the_whole(spark, tmp_path):
    rnd = random.Random(5)
    texts = ["", " ", "u", "v" * 64, "w" * 65, "w" * 64 + "x", " " * 80, None]
    data = [(rnd.choice(["1", "2", "3", None]), rnd.choice(texts), rnd.choice(["n", None])) for _ in range(90)]
    columns = ["id", "text", "other"]
    schema = "id string, text string, other string"
    whole, root = spark.createDataFrame(data, schema), str(tmp_path)
    for i in range(3):
        P.load_profile(spark.createDataFrame(data[i * 30:i * 30 + 30], schema), root, "s.t", "raw", "id", ["text", "other", "gone"], f"r{i}", NOW)
    P.load_profile(spark.createDataFrame(data[:30], schema), root, "s.t", "raw", "id", ["text", "other", "gone"], "r0", NOW)  # again
    merged = P.merged_profile(spark, root, "s.t", "raw", "id", ["text", "other", "gone"], NOW)
    once = P.load_profile(whole, root, "s.once", "raw", "id", ["text", "other", "gone"], "r", NOW)
    assert rows(merged.drop("table")) == rows(once.drop("table"))
    want = _brute_profile(data, columns)
    for r in merged.collect():
        got = (r.rows, r.non_null_col, r.distinct_col, r.missing_names, r.multiple_names)
        if r.col_name == "gone":
            assert r.column_type == "column_missing" and set(got) == {None}
        elif r.col_name == "id":
            assert r.column_type == "column_id" and got[:3] == want["id"][:3] and got[3:] == (None, None)
        else:
            assert r.column_type == "column_attr" and got == want[r.col_name]


def test_profile_recreated_empty_and_without_id(spark, tmp_path):
    df, root = spark.createDataFrame([("1", "a"), ("1", "b")], "id string, v string"), str(tmp_path)
    for run, part in (("r0", df), ("r1", df)):
        P.load_profile(part, root, "s.t", "raw", "id", ["v"], run, NOW)
    profile = lambda: {r.col_name: (r.rows, r.multiple_names) for r in P.merged_profile(spark, root, "s.t", "raw", "id", ["v"], NOW).collect()}
    assert profile() == {"id": (4, None), "v": (4, 1)}
    P.load_profile(df.limit(1), root, "s.t", "raw", "id", ["v"], "r2", NOW, recreate=True)
    assert profile() == {"id": (1, None), "v": (1, 0)}
    P.load_profile(df.where("false"), root, "s.t", "raw", "id", ["v"], "r3", NOW, recreate=True)
    assert profile() == {"id": (0, None), "v": (0, 0)}  # an empty column is there, unlike a missing one
    with pytest.raises(ValueError, match="no column"):
        P.load_profile(df, root, "s.t", "raw", "key", ["v"], "r4", NOW)


def test_profile_has_no_expand(spark):
    from tierwork.operators.quality import profile

    df = spark.createDataFrame([("1", "a")], "id string, v string")
    assert "Expand" not in profile(df, ["id", "v"])._jdf.queryExecution().executedPlan().toString()


def test_lattice_equals_each_grouping_and_scans_once(spark, tmp_path):
    rnd = random.Random(8)
    data = [(rnd.choice([1, 2, None]), rnd.choice("xyz"), rnd.randrange(9), i) for i in range(120)]
    spark.createDataFrame(data, "a int, b string, v int, i int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    groupings = [(["a"], {"lo": ("min", "v"), "n": ("count", "v")}), (["b"], {"hi": ("max", "v")}), (["a", "b"], {"s": ("sum", "v")})]
    got = R.with_lattice_of(df, groupings)
    plain = R.with_stats_of(df, [(["a"], {"lo": F.min("v"), "n": F.count("v")}), (["b"], {"hi": F.max("v")}), (["a", "b"], {"s": F.sum("v")})])
    assert rows(got) == rows(plain) and got.columns == plain.columns
    assert "parquet" not in got._jdf.queryExecution().executedPlan().toString()  # the table was read for the stored rows only
