"""Bounded name lists and the catalogue checks against plain loops."""

import datetime as dt
import random
from collections import defaultdict

import pytest

from tierwork.operators import mastering as M
from tierwork.operators import quality as Q


def test_bounded_names_lose_nothing(spark):
    rnd = random.Random(5)
    days = [None, *[dt.datetime(2024, 1, d) for d in (1, 2, 3)]]
    # key "hot" holds most rows and names, None is a key too
    data = [(rnd.choice(["hot", "hot", "hot", "b", None]), f"n{rnd.randrange(60)}" if rnd.random() < .9 else None, rnd.choice(days), i)
            for i in range(400)] + [("bare", None, None, 1000)]
    df = spark.createDataFrame(data, "key string, name string, at timestamp, id int")
    far = dt.datetime(1900, 1, 1)

    def place(row):
        return (row[2] is None, -((row[2] or far) - far).total_seconds(), row[3])

    names, best_rows = defaultdict(dict), {}
    for r in sorted(data, key=place):
        best_rows.setdefault(r[0], r)
        if r[1] is not None:
            names[r[0]].setdefault(r[1], len(names[r[0]]) + 1)
    for longest in (1, 7, 1000):
        best, beyond = M.best_record_bounded(df, ["key"], "at", "id", "name", longest)
        got = {r.key: r for r in best.collect()}
        assert set(got) == set(best_rows)
        for key, r in got.items():
            want = list(names[key])
            assert (r.id, r.n_names, r.all_names) == (best_rows[key][3], len(want), want[:longest])
        rest = {(r.key, r.name, r.position) for r in beyond.collect()}
        assert rest == {(k, n, p) for k, ns in names.items() for n, p in ns.items() if p > longest}


def test_bounded_names_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "key string, name string, at timestamp, id int")
    best, beyond = M.best_record_bounded(empty, ["key"], "at", "id", "name", 3)
    assert best.count() == beyond.count() == 0
    with pytest.raises(ValueError, match="at least 1"):
        M.best_record_bounded(empty, ["key"], "at", "id", "name", 0)


SHAPE = "entity string, kind string, run_group int, run_order int, active string"


def test_catalogue_conflicts(spark):
    rows = [("a", "core", 1), ("b", "core", 1), ("c", "core", 2), ("d", "x", 3), ("e", "y", 3), ("f", "z", 3), ("g", "x", 4), ("h", "y", 5),
            ("i", "y", None), ("j", None, 5), ("k", "f", 6), ("l", "y", 4)]
    df = spark.createDataFrame([(*r, 0, "1") for r in rows], SHAPE)
    got = {tuple(r) for r in Q.catalogue_conflicts(df, "kind", "run_group", ["x", "y"]).collect()}
    # x and y may lie in several groups and share group 4; group 3 holds z as well
    assert got == {("kind", "core", "1", 2), ("kind", "core", "2", 2), *[("group", "3", k, 3) for k in "xyz"]}
    assert Q.catalogue_conflicts(df.limit(0), "kind", "run_group", ["x"]).count() == 0


def test_catalogue_listing_is_active_filtered_and_ordered(spark):
    df = spark.createDataFrame([("a", "core", 1, 2, "1"), ("b", "core", 1, None, "1"), ("c", "core", 1, 1, "0"), ("d", "core", 2, 1, "1"),
                                ("e", None, 1, 1, "1"), ("f", "core", 1, 1, None)], SHAPE)
    got = Q.catalogue_listing(df, "active", "run_order", {"kind": "core", "run_group": 1}).orderBy("sort_key")
    assert [(r.entity, r.sort_key) for r in got.collect()] == [("b", 0), ("a", 2)]
    span = Q.group_span(df, "kind", "run_group").collect()
    assert [tuple(r) for r in span] == [("core", 1, 2, 5)]
