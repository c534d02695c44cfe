"""Vendor rule tables against plain loops."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierwork.operators import vendors as V

EXT = "order_id int, line int, note int, vendor string, level string"
OWN = "order_id int, line int, note int, vendor string, place string"
RULES = [
    (1, "own", None, "vendor = 'a'", True, None, None),
    (2, "both", "vendor = 'b'", "vendor = 'b'", False, None, "level IS NOT NULL"),
    (3, "near", "vendor = 'c'", None, False, "abs(own_note - note) <= 1", "own_place IS NULL OR own_place <> 'DD'"),
    (4, "noted", "vendor IN ('b', 'd')", None, True, None, "own_vendor IS NOT NULL"),
]


def bag(df):
    return Counter(map(tuple, df.collect()))


def brute_match(ext, own):
    """The rules above said again, pair by pair."""
    def agree(e, o):
        return e[2] is not None and e[2] == o[2]

    def linked(e, o):
        if None in (e[0], e[1]) or e[:2] != o[:2]:
            return False
        return ((o[3] == "a" and agree(e, o)) or (e[3] == "b" and o[3] == "b")
                or (e[3] == "c" and None not in (e[2], o[2]) and abs(e[2] - o[2]) <= 1) or (e[3] in ("b", "d") and agree(e, o)))

    def rule(e, o):
        ev, ov = e and e[3], o and o[3]
        if ov == "a":
            return "own"
        if "b" in (ev, ov) and e and e[4] is not None:
            return "both"
        if ev == "c" and (o is None or o[4] is None or o[4] != "DD"):
            return "near"
        if ev in ("b", "d") and ov is not None:
            return "noted"
        return None

    pairs = [(i, j) for i, e in enumerate(ext) for j, o in enumerate(own) if linked(e, o)]
    met_e, met_o = {i for i, _ in pairs}, {j for _, j in pairs}
    rows = [(ext[i], own[j]) for i, j in pairs] + [(e, None) for i, e in enumerate(ext) if i not in met_e]
    rows += [(None, o) for j, o in enumerate(own) if j not in met_o]
    none = (None,) * 5
    return Counter((rule(e, o), *(e or none), *(o or none)) for e, o in rows if rule(e, o))


@pytest.mark.parametrize("seed", [1, 2])
def test_match_equals_brute_force(spark, seed):
    rnd = random.Random(seed)

    def side(n, last):
        # a third of all rows under one order and line, some keys and notes unknown
        return [(rnd.choice([7, 1, 2, None]), rnd.choice([1, 1, 2, None]), rnd.choice([1, 2, 3, None]),
                 rnd.choice(["a", "b", "c", "d", "e", None]), rnd.choice(last)) for _ in range(n)]

    ext, own = side(70, ["x", None]), side(60, ["DD", "M", None])
    ext += ext[:5]
    got = V.match_by_rules(spark.createDataFrame(ext, EXT), spark.createDataFrame(own, OWN), ["order_id", "line"], "note",
                           spark.createDataFrame(RULES, V.MATCH_RULES))
    assert got.columns[0] == "rule" and bag(got) == brute_match(ext, own)


def test_match_of_empty_sides_and_rules(spark):
    ext = spark.createDataFrame([(1, 1, 1, "c", "x")], EXT)
    own = spark.createDataFrame([(1, 1, 1, "a", "M")], OWN)
    rules = spark.createDataFrame(RULES, V.MATCH_RULES)
    assert bag(V.match_by_rules(ext, own.limit(0), ["order_id", "line"], "note", rules)) == {("near", 1, 1, 1, "c", "x", *[None] * 5): 1}
    assert bag(V.match_by_rules(ext.limit(0), own, ["order_id", "line"], "note", rules)) == {("own", *[None] * 5, 1, 1, 1, "a", "M"): 1}
    assert V.match_by_rules(ext, own, ["order_id", "line"], "note", rules.limit(0)).count() == 0
    with pytest.raises(ValueError, match="clash"):
        V.match_by_rules(ext.withColumnRenamed("level", "own_place"), own, ["order_id", "line"], "note", rules)


REPORT = [
    (1, "it's one", "brand = 'a'", "n > 0", "d", None, {"code": "upper(name)"}),
    (2, "units", "brand IN ('b', 'c')", None, "last_day(d)", "n", {"code": "name", "serial": "concat(name, '-', unit_no)"}),
    (3, "late", "brand = 'c' OR brand = 'e'", "d >= date'2024-01-02'", None, None, {}),
]


def test_report_picks_the_first_rule_and_unfolds_units(spark):
    d = dt.date(2024, 1, 1)
    data = [("a", "x", 2, d), ("a", "y", 0, d), ("a", "z", None, d), ("b", "p", 3, d), ("b", "q", 0, d), ("b", None, None, d), ("c", "r", -1, d),
            ("e", "s", 5, d), ("e", "t", 5, dt.date(2024, 1, 2)), ("f", "u", 5, d), (None, "v", 5, d)]
    df = spark.createDataFrame(data, "brand string, name string, n int, d date")
    got = V.report_by_rules(df, spark.createDataFrame(REPORT, V.REPORT_RULES), {"code": "string", "serial": "string"}, ["n"])
    assert got.columns == ["vendor", "n", "unit_no", "report_date", "code", "serial"]
    end = dt.date(2024, 1, 31)
    assert bag(got) == Counter([
        ("it's one", 2, None, d, "X", None), *[("units", 3, i, end, "p", f"p-{i}") for i in (1, 2, 3)], ("units", 0, None, end, "q", None),
        ("units", None, None, end, None, None), ("units", -1, None, end, "r", None), ("late", 5, None, None, None, None)])


def test_report_totals_agree_with_the_report(spark):
    """Totals per row and block, merged, are those of the unfolded report; a part code that names the unit keeps units apart."""
    d = dt.date(2024, 1, 1)
    data = [("a", "x", 2, d), ("a", "z", None, d), ("b", "p", 3, d), ("b", "p", 12, d), ("b", "q", 0, d), ("b", None, 4, d), ("c", "r", -1, d),
            ("c", "r", 2001, d), ("e", "t", 5, dt.date(2024, 1, 2)), ("e", "t", 5, d), (None, "v", 5, d)]
    df = spark.createDataFrame(data, "brand string, name string, n int, d date")
    kinds = {"code": "string", "serial": "string", "worth": "decimal(9,2)", "share": "double"}
    more = {"worth": "unit_no / 4", "share": "CASE WHEN unit_no > 2 THEN n END"}
    for code in ("name", "concat(name, unit_no % 3)"):
        rules = spark.createDataFrame([REPORT[0], (*REPORT[1][:6], {**REPORT[1][6], **more, "code": code}), REPORT[2]], V.REPORT_RULES)
        by = ["vendor", "report_date", "code"]
        plain = V.report_by_rules(df, rules, kinds, ["n"]).groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.count("serial").alias("serials"), F.min("serial").alias("low"), F.max("serial").alias("high"),
            F.sum("worth").alias("worth"), F.sum("share").alias("share"), F.max("unit_no").alias("last"))
        totals = {"rows": ("count", None), "serials": ("count", "serial"), "low": ("min", "serial"), "high": ("max", "serial"),
                  "worth": ("sum", "worth"), "share": ("sum", "share"), "last": ("max", "unit_no")}
        parts = V.report_by_rules(df, rules, kinds, ["n"], totals)
        assert parts.columns == ["vendor", "n", "report_date", "code", *totals]
        merged = parts.groupBy(*by).agg(F.sum("rows").alias("rows"), F.sum("serials").alias("serials"), F.min("low").alias("low"), F.max("high").alias("high"),
                                        F.sum("worth").alias("worth"), F.sum("share").alias("share"), F.max("last").alias("last"))
        assert bag(merged) == bag(plain) and plain.count() >= 5
        assert code != "name" or parts.count() == 10  # eight rows stay, the one of 2001 units has three blocks


def test_a_new_vendor_is_a_new_row_and_many_rules_read_once(spark):
    df = spark.range(40).selectExpr("id", "concat('b', id % 20) AS brand")
    rules = [(i, f"v{i}", f"brand = 'b{i}'", None, None, "id", {"x": "id + 1" if i % 2 else "id"}) for i in range(19)]
    out = V.report_by_rules(df, spark.createDataFrame(rules, V.REPORT_RULES), {"x": "long"}, ["id"])
    assert {r.vendor for r in out.collect()} == {f"v{i}" for i in range(19)}
    more = V.report_by_rules(df, spark.createDataFrame([*rules, (19, "v19", "brand = 'b19'", None, None, None, {})], V.REPORT_RULES),
                             {"x": "long"}, ["id"])
    assert more.where("vendor = 'v19'").count() == 2
    text = more._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range (") == 1 and "Exchange" not in text and "Join" not in text
    one_big = spark.createDataFrame([(2500,)], "n int")
    rule = spark.createDataFrame([(1, "v", "true", None, None, "n", {})], V.REPORT_RULES)
    units = V.report_by_rules(one_big, rule, {}, [])
    assert [r.unit_no for r in units.orderBy("unit_no").collect()] == list(range(1, 2501))


def test_rule_tables_are_checked(spark):
    df = spark.createDataFrame([("a", 1)], "brand string, unit_no int")
    rules = spark.createDataFrame(REPORT, V.REPORT_RULES)
    with pytest.raises(ValueError, match="clash"):
        V.report_by_rules(df, rules, {"code": "string", "serial": "string"}, [])
    with pytest.raises(ValueError, match="does not have"):
        V.report_by_rules(df.drop("unit_no"), rules, {"code": "string"}, [])
    with pytest.raises(ValueError, match="not unique"):
        V.read_rules(rules.unionByName(rules))
    assert V.report_by_rules(df.drop("unit_no"), rules.limit(0), {"code": "string"}, []).count() == 0
